"""The balance ledger as a stream.

Three forms. :func:`start_ledger` runs the batch ledger on every micro-batch and spreads
hot accounts. :func:`event_time_ledger` keeps balances and early events in keyed state and decides in the order of
event time, however the source deals its rows into micro-batches; :func:`stream_ledger` decides every micro-batch at once, in the order
in which they come. Both have one account's events of a micro-batch in one task.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline.functions.account import decide
from ledgerline.operators.ledger import CARRIED, apply_ledger, closing_balances, ledger_result
from ledgerline.session import DEFAULTS, remove_folder, shared_dir, ship_package
from ledgerline.sources.generations import Log
from ledgerline.sources.logs import writer_name
from ledgerline.streaming.ingest import FLUSH, start

OUTPUT = (
    "account_id string, at timestamp, id string, kind string, type string, cents bigint, outcome string, "
    "recorded boolean, status string, reason string, balance_cents bigint, account_status string, "
    "merchant_id string, currency string, description string"
)
STATE = "balance_cents bigint, account_status string"
NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Decide one account's events of a micro-batch in (time, id) order."""
    rows = pd.concat(list(batches)).sort_values(["rank", "at", "id"])
    account = tuple(state.get) if state.exists else None
    results = []
    for row in rows.itertuples(index=False):
        cents = None if pd.isna(row.cents) else int(row.cents)
        if row.kind == "open":
            account = account or (cents, row.type)
            continue
        account, outcome, recorded, status, reason = decide(account, row.kind, row.type, cents, row.intent)
        balance, standing = account if account else (None, None)
        carried = (row.merchant_id, row.currency, row.description)
        results.append(
            (key[0], row.at, row.id, row.kind, row.type, cents, outcome, recorded, status, reason, balance, standing, *carried)
        )
    if account:
        state.update(account)
    frame = pd.DataFrame(results, columns=NAMES, dtype=object)
    yield frame.astype({"at": "datetime64[us]", "cents": "Int64", "balance_cents": "Int64"})


def stream_ledger(timeline: DataFrame) -> DataFrame:
    """Decisions for a stream of :func:`ledgerline.operators.ledger.ledger_timeline` rows.

    An account's `open` row sets its first balance; later ones are ignored. Order
    holds within a micro-batch, so the batch size limit of the source bounds what
    one account can bring at once.
    """
    ship_package(timeline.sparkSession)
    decided = timeline.groupBy("account_id").applyInPandasWithState(
        advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout
    )
    return ledger_result(decided)


HEARTBEAT = "tick"  # kind of a row that only moves event time on
EVENT = ["account_id", "at_us", "id", "rank", "kind", "type", "cents", "intent", "merchant_id", "currency", "description"]
BUCKETS = 4096  # keys of the state: accounts are dealt to them by hash
_STORE = "spark.sql.streaming.stateStore.providerClass"


def _plain(value):
    """A value of a pandas column with None for what is missing."""
    return None if value is None or value != value else value


class OrderedLedger(StatefulProcessor):
    """Holds the events of a bucket of accounts until the watermark has passed them, then decides each account's in (time, rank, id) order.

    State of a bucket: the balances and status its accounts began with, packed; those of accounts that have had decisions, by account;
    the events that are still early, packed as each batch brought them. One timer waits for the earliest of these. So a batch costs
    a call or two a bucket and not some for each event. A second event of the same account, time and id takes the place of the first,
    so a re-delivered one that comes before its time counts once.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.opening = handle.getValueState("opening", "packed binary")
        self.accounts = handle.getMapState("accounts", "account_id string", STATE)
        self.early = handle.getListState("early", "packed binary")
        self.timer = handle.getValueState("timer", "at_ms bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        known = self._opening()
        for account_id, cents, status in zip(*(initialState[c].tolist() for c in ("account_id", "cents", "status")), strict=True):
            known.setdefault(_plain(account_id), (int(cents), status))
        self.opening.update((pickle.dumps(known),))

    def _opening(self) -> dict:
        packed = self.opening.get()
        return pickle.loads(packed[0]) if packed else {}

    def _wait(self, at_us: int) -> None:
        """Let one timer wait for the earliest of the events."""
        at_ms, known = -(-at_us // 1000), self.timer.get()
        if known and known[0] <= at_ms:
            return
        if known:
            self.handle.deleteTimer(known[0])
        self.handle.registerTimer(at_ms)
        self.timer.update((at_ms,))

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for frame in rows:
            columns = zip(*(frame[c].tolist() for c in EVENT), strict=True)
            events = [tuple(map(_plain, row)) for row in columns if row[4] != HEARTBEAT]
            if events:
                self.early.appendValue((pickle.dumps(events),))
                earliest = min(event[1] for event in events)
                first = earliest if first is None else min(first, earliest)
        if first is not None:
            self._wait(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        held = {event[:3]: event for (packed,) in self.early.get() for event in pickle.loads(packed)}
        waiting = [event for event in held.values() if event[1] > passed]
        due: dict = {}
        for event in held.values():
            if event[1] <= passed:
                due.setdefault(event[0], []).append(event)
        if waiting:
            if due:
                self.early.put([(pickle.dumps(waiting),)])
            self._wait(min(event[1] for event in waiting))
        else:
            self.early.clear()
        opening = self._opening() if due else {}
        results = []
        for account_id, events in due.items():
            account = self.accounts.getValue((account_id,))
            account = tuple(account) if account else opening.get(account_id)
            # time, rank, id
            for _, at, event_id, _, kind, txn_type, cents, intent, *carried in sorted(events, key=lambda e: (e[1], e[3], e[2])):
                cents = None if cents is None else int(cents)
                if kind == "open":
                    account = account or (cents, txn_type)
                    continue
                account, *decision = decide(account, kind, txn_type, cents, intent)
                results.append((account_id, at, event_id, kind, txn_type, cents, *decision, *(account or (None, None)), *carried))
            if account:
                self.accounts.updateValue((account_id,), account)
        if results:
            frame = pd.DataFrame(results, columns=NAMES, dtype=object)
            frame["at"] = frame["at"].astype("int64").astype("datetime64[us]")
            yield frame.astype({"cents": "Int64", "balance_cents": "Int64"})

    def close(self) -> None:
        pass


def event_time_ledger(events: DataFrame, accounts: DataFrame, delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Decisions for a stream of :func:`ledgerline.operators.ledger.ledger_timeline` rows, in event-time order (output mode `append`).

    `accounts` (id, balance, status) are the balances to start from, read once with the first batch; accounts that appear later open with
    an `open` row of their own time. An event is decided when the watermark, `delay` behind the newest event, has passed it, so rows
    may come in any order within the delay and still give the batch ledger's result; rows that come later
    than that, or have no time, are left out, as a decision once made stands. A stream without new rows holds the last events back;
    a row of kind `tick` with a later time lets them go. A key of the state is one of `buckets` groups of accounts, a number that has to stay the
    same under a checkpoint: a call of Python for every account would cost far more than its decisions.
    """
    spark = events.sparkSession
    ship_package(spark)
    if "RocksDB" not in spark.conf.get(_STORE):
        spark.conf.set(_STORE, DEFAULTS[_STORE])
    bucket = F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int").alias("bucket")
    timed = events.where("at IS NOT NULL").withColumn("at_us", F.expr("unix_micros(at)")).withWatermark("at", delay)
    opening = accounts.selectExpr("id AS account_id", "CAST(round(balance * 100) AS BIGINT) AS cents", "status").where("status IS NOT NULL")
    decided = timed.select(bucket, "at", *EVENT).groupBy("bucket").transformWithStateInPandas(
        OrderedLedger(), OUTPUT, "append", "EventTime", initialState=opening.select(bucket, "*").groupBy("bucket")
    )
    return ledger_result(decided)


def wire_timeline(records: DataFrame) -> DataFrame:
    """Timeline rows from JSON messages (rank, at, id, kind, type, cents, intent, account_id, and what a transaction carries)."""
    schema = (
        "account_id string, rank int, at timestamp, id string, kind string, type string, cents bigint, intent string, "
        "merchant_id string, currency string, description string"
    )
    return records.select(F.from_json("value", schema).alias("m")).select("m.*")


BALANCES = "id string, balance decimal(18,2), status string, version bigint"
PUBLISH_EVERY = 100  # batches between generations of the balances


def balance_log(spark: SparkSession, path: str) -> Log:
    """Balances after each batch, of the accounts the batch touched; generations keep the newest of each account."""
    return Log(spark, path, T.StructType.fromDDL(BALANCES), ("id",), "version")


def current_balances(spark: SparkSession, path: str, before_batch: int) -> DataFrame:
    """Balance and status per account after the batches before `before_batch`."""
    rows = balance_log(spark, path).read().where(F.col("version") < before_batch)
    newest = rows.groupBy("id").agg(F.expr("max_by(named_struct('balance', balance, 'status', status), version) AS s"))
    return newest.select("id", "s.*")


def start_ledger(
    timeline: DataFrame,
    decided_path: str,
    balance_path: str,
    checkpoint: str,
    parts: int | None = None,
    trigger: str | None = FLUSH,
    publish_every: int = PUBLISH_EVERY,
) -> StreamingQuery:
    """The ledger batch by batch, with balances kept as an append-only log.

    Each batch starts from the balances after the batches before it, decides its
    events with :func:`apply_ledger`, which cuts a hot account into parts, and
    writes its own folders, so a batch that is run again replaces its own results.
    Every `publish_every` batches the balances become a generation with one row for each account, so a batch reads the accounts
    and a bounded number of batches, not all balances ever written. One query owns the two paths.
    """
    writer = writer_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        folder = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
        try:
            known = current_balances(spark, balance_path, batch_id)
            opened = batch.where("kind = 'open'").groupBy(F.col("account_id").alias("id")).agg(
                F.expr("min_by(named_struct('cents', cents, 'status', type), named_struct('at', at, 'id', id)) AS s")
            )
            fresh = opened.join(known, "id", "left_anti").selectExpr(
                "id", "CAST(CAST(s.cents AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS balance", "s.status AS status"
            )
            accounts = known.unionByName(fresh)
            events = batch.where("kind <> 'open'").selectExpr(
                "account_id", "at", "id", "kind", "type", "CAST(CAST(cents AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS amount", "intent", *CARRIED
            )
            # only accounts with events take part in the fold
            active = accounts.join(events.select(F.col("account_id").alias("id")).distinct(), "id", "left_semi")
            decided = apply_ledger(events, active, parts, folder)
            decided.write.mode("overwrite").parquet(f"{decided_path}/batch_id={batch_id}")
            stored = spark.read.parquet(f"{decided_path}/batch_id={batch_id}")
            changed = closing_balances(stored, active).unionByName(fresh.join(active, "id", "left_anti"))
            changed = changed.withColumn("version", F.lit(batch_id).cast("bigint"))
            changed.write.mode("overwrite").parquet(f"{balance_path}/writer={writer}/batch_id={batch_id}")
            if publish_every and (batch_id + 1) % publish_every == 0:
                # this batch may be run again, and then needs the balances before it
                balance_log(spark, balance_path).publish({writer: batch_id - 1})
        finally:
            batch.unpersist()
            remove_folder(spark, folder)

    return start(timeline.writeStream.foreachBatch(write), checkpoint, trigger)
