"""Order-dependent balance ledger over all accounts.

Whether a debit is accepted depends on the balance left by everything before it,
so each account is a fold in time order. The rows are range-partitioned by
(account, time, id): a small account lies within one part, and an account with a
large share of the rows is cut into consecutive parts of ordinary size, so no task
ever holds more than one part.

Every part decides the accounts that begin in it, all at once by cumulative sums
(:mod:`ledgerline.functions.folds`). At most one account per part, its first, may
continue from an earlier part; those rows are set aside together with a summary: what
they make of an account that opens active, or suspended, and the money this needs.
Summaries compose, so the opening state of following parts is known without reading them as
long as the money suffices, whatever commands they hold; the parts whose opening is known are then
decided side by side, and only a part that really runs short makes the next one wait.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.account import TOPUP_CURRENCY, TOPUP_DESCRIPTION
from ledgerline.functions.folds import ACTIVE, NOTHING, SUSPENDED, UNKNOWN, Statuses, Summary, decide_runs, decision_columns, read_events
from ledgerline.functions.skew import salted_join
from ledgerline.session import remove_folder, shared_dir, ship_package

ORDER = ("account_id", "rank", "at", "id")
DECIDED, PENDING, CLOSING, SUMMARY = "decided", "pending", "closing", "summary"

PART_SCHEMA = (
    "part string, segment int, account_id string, at timestamp, id string, kind string, type string, "
    "cents bigint, intent string, merchant_id string, currency string, description string, outcome string, "
    "recorded boolean, status string, reason string, balance_cents bigint, account_status string, summary array<bigint>"
)
CARRIED = ("merchant_id", "currency", "description")  # of the transaction, untouched by the decision
PASSED = ("segment", "account_id", "at", "id", "kind", "type", "cents", "intent", *CARRIED)
ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "timestamp": pa.timestamp("us", tz="UTC"),
    "array<bigint>": pa.list_(pa.int64()),
}
ARROW_SCHEMA = pa.schema([(c.split()[0], ARROW_TYPES[c.split()[1]]) for c in PART_SCHEMA.split(", ")])
RESULT = ["account_id", "at", "id", "kind", "type", "amount", "outcome", "recorded", "status", "reason", "balance_after", "account_status", *CARRIED]


def ledger_timeline(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account openings and events as one ordered stream, which saves joining them.

    `events`: account_id, at, id, kind (txn, topup, suspend, reactivate), type,
    amount, intent ('completed' or 'failed'), and if they are there merchant_id, currency and
    description. `accounts`: id, balance, status.
    """
    cents = F.round(F.col("amount") * 100).cast("bigint")
    text = F.lit(None).cast("string")
    flow = events.select(
        "account_id",
        F.lit(1).alias("rank"),
        "at",
        F.col("id").cast("string").alias("id"),
        "kind",
        "type",
        cents.alias("cents"),
        "intent",
        *[F.col(c) if c in events.columns else text.alias(c) for c in CARRIED],
    )
    opening = accounts.select(
        F.col("id").alias("account_id"),
        F.lit(0).alias("rank"),
        F.lit(None).cast("timestamp").alias("at"),
        F.lit("").alias("id"),
        F.lit("open").alias("kind"),
        F.col("status").alias("type"),
        F.round(F.col("balance") * 100).cast("bigint").alias("cents"),
        text.alias("intent"),
        *[text.alias(c) for c in CARRIED],
    )
    return opening.unionByName(flow)


def to_batch(values: dict, rows: int) -> pa.RecordBatch:
    columns = []
    for field in ARROW_SCHEMA:
        value = values.get(field.name)
        if value is None:
            columns.append(pa.nulls(rows, field.type))
        else:
            columns.append(value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(columns, schema=ARROW_SCHEMA)


def marker(part: str, segment: int, account_id: str, **values) -> pa.RecordBatch:
    row = {"part": part, "segment": segment, "account_id": account_id, **values}
    return to_batch({c: [v] for c, v in row.items()}, 1)


def closing_row(segment: int, account_id: str, balance: int, status: str | None) -> pa.RecordBatch:
    known = status is not None
    return marker(CLOSING, segment, account_id, balance_cents=balance if known else None, account_status=status)


def _passed(batch: pa.RecordBatch, part: str, more: dict) -> pa.RecordBatch:
    columns = {c: batch[c] for c in PASSED}
    return to_batch({**columns, **more, "part": pa.array([part] * batch.num_rows, pa.string())}, batch.num_rows)


def _groups(names: pa.Array) -> np.ndarray:
    """Where a new account begins."""
    codes = names.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])


def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part: decide the accounts that begin here, set the continued one aside.

    A batch ends anywhere in an account; what its last account has by then is carried into the next batch.
    """
    statuses, summary = Statuses(), Summary()
    leading = current = segment = None
    begun, money, standing = False, 0, UNKNOWN
    for batch in batches:
        if not batch.num_rows:
            continue
        opens = pc.equal(batch["kind"], "open").fill_null(False).to_numpy(zero_copy_only=False)
        segment = batch["segment"][0].as_py()
        if not begun:
            begun = True
            leading = None if opens[0] else (batch["account_id"][0].as_py(),)
        firsts = _groups(batch["account_id"])
        names = batch["account_id"].take(pa.array(firsts)).to_pylist()
        ends = np.append(firsts[1:], batch.num_rows)
        if leading and names[0] == leading[0] and current in (None, leading):
            aside, start = batch.slice(0, int(ends[0])), 1
            summary.add(read_events(aside))
            yield _passed(aside, PENDING, {})
            current = leading
        else:
            start = 0
        if start == len(names):
            continue
        # an account opens with its last opening row, or with what the batch before left it with
        balances, standings = np.zeros(len(names), dtype=np.int64), np.full(len(names), UNKNOWN)
        if (names[start],) == current:
            balances[start], standings[start] = money, standing
        at = np.flatnonzero(opens)
        own = np.searchsorted(firsts, at, side="right") - 1
        for k, cents, status in zip(own.tolist(), batch["cents"].take(pa.array(at)).to_pylist(), batch["type"].take(pa.array(at)).to_pylist()):
            balances[k], standings[k] = cents or 0, statuses.number(status)
        rows = np.flatnonzero(~opens[firsts[start] :]) + firsts[start]
        if len(rows):
            kept = batch.take(pa.array(rows))
            begin = np.searchsorted(rows, firsts[start:])
            filled = np.flatnonzero(np.diff(np.append(begin, len(rows))))
            events = read_events(kept)
            made = decide_runs(events, begin[filled], balances[start:][filled], standings[start:][filled])
            last = np.append(begin[filled][1:], len(rows)) - 1
            balances[start + filled], standings[start + filled] = made.balance[last], made.after[last]
            yield _passed(kept, DECIDED, decision_columns(events, made, statuses))
        current, money, standing = (names[-1],), int(balances[-1]), int(standings[-1])
    if leading:
        yield marker(SUMMARY, segment, leading[0], summary=[*summary.ends, *summary.nets, *summary.needs])
    if current not in (None, leading):
        yield closing_row(segment, current[0], money, statuses.names[standing])


def continued_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decide set-aside parts whose opening state is known: columns open_cents and open_status."""
    statuses = Statuses()
    current = owner = None
    money, standing = 0, UNKNOWN
    for batch in batches:
        if not batch.num_rows:
            continue
        segments = batch["segment"].to_numpy()
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(segments)) + 1])
        balances = batch["open_cents"].take(pa.array(firsts)).fill_null(0).to_numpy().copy()
        standings = np.array([statuses.number(x) for x in batch["open_status"].take(pa.array(firsts)).to_pylist()])
        if segments[0] == current:
            balances[0], standings[0] = money, standing
        elif current is not None:
            yield closing_row(current, owner, money, statuses.names[standing])
        events = read_events(batch)
        made = decide_runs(events, firsts, balances, standings)
        yield _passed(batch, DECIDED, decision_columns(events, made, statuses))
        last = np.append(firsts[1:], batch.num_rows) - 1
        owners = batch["account_id"].take(pa.array(last)).to_pylist()
        for k in range(len(last) - 1):
            yield closing_row(int(segments[last[k]]), owners[k], int(made.balance[last[k]]), statuses.names[made.after[last[k]]])
        current, owner, money, standing = int(segments[-1]), owners[-1], int(made.balance[-1]), int(made.after[-1])
    if current is not None:
        yield closing_row(current, owner, money, statuses.names[standing])


def known_openings(todo: dict[str, list], states: dict[str, tuple | None]) -> tuple[dict, dict]:
    """Opening state of every part that can be decided now, and the parts left over.

    Walks the summaries of each continued account: one with enough money leaves a part in a known way, as does one that is
    neither active nor suspended, or unknown. The first part in which it runs short is decided too, and the rest waits for it.
    """
    ready: dict[int, tuple | None] = {}
    waiting: dict[str, list] = {}
    names = {ACTIVE: "active", SUSPENDED: "suspended"}
    for account_id, parts in todo.items():
        account = states.get(account_id)
        for position, part in enumerate(parts):
            ready[part["segment"]] = account
            if account is None or account[1] not in names.values():
                continue
            k = ACTIVE if account[1] == "active" else SUSPENDED
            end, net, need = part["summary"][k], part["summary"][2 + k], part["summary"][4 + k]
            if account[0] < need and need != NOTHING:
                rest = parts[position + 1 :]
                if rest:
                    waiting[account_id] = rest
                break
            account = (account[0] + net, names[end])
    return ready, waiting


SMALL_PART, LARGE_PART = 10_000, 2_000_000


def part_count(rows: int, parallel: int) -> int:
    """Parts for a number of events: the session's parallelism, but none tiny and none over LARGE_PART."""
    return max(1, min(parallel, -(-rows // SMALL_PART)), -(-rows // LARGE_PART))


def apply_ledger(events: DataFrame, accounts: DataFrame, parts: int | None = None, folder: str | None = None) -> DataFrame:
    """Every event with its decision and the balance after it.

    Runs the parts eagerly and keeps their results under the shared folder, so an
    executor lost later costs a re-read and not the fold; what was set aside meanwhile is removed. What the driver sees is
    at most two small rows per part. An account without a status counts as unknown. `folder` names the place of the results, for a
    caller who removes it later.
    """
    spark = events.sparkSession
    ship_package(spark)
    count = parts or part_count(events.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = folder or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    timeline = (
        ledger_timeline(events, accounts)
        .repartitionByRange(count, *ORDER)
        .sortWithinPartitions(*ORDER)
        .withColumn("segment", F.spark_partition_id())
    )

    def stored(rows: DataFrame, number: int) -> DataFrame:
        path = f"{folder}/round={number}"
        rows.write.partitionBy("part").parquet(path)
        return spark.read.schema(PART_SCHEMA).parquet(path)

    def closings(rows: DataFrame) -> list:
        return rows.where(F.col("part") == CLOSING).select("segment", "account_id", "balance_cents", "account_status").collect()

    def state(row) -> tuple | None:
        return None if row["account_status"] is None else (row["balance_cents"], row["account_status"])

    first = stored(timeline.mapInArrow(first_pass, PART_SCHEMA), 0)
    summaries = first.where(F.col("part") == SUMMARY).select("segment", "account_id", "summary").orderBy("segment").collect()
    todo: dict[str, list] = {}
    for row in summaries:
        todo.setdefault(row["account_id"], []).append(row)
    states = {row["account_id"]: state(row) for row in closings(first)} if todo else {}
    pending = first.where(F.col("part") == PENDING)
    number = 0
    while todo:
        number += 1
        ready, todo = known_openings(todo, states)
        openings = spark.createDataFrame(
            [(segment, *(account or (None, None))) for segment, account in ready.items()], "_segment int, open_cents bigint, open_status string"
        )
        chosen = pending.join(openings, F.col("segment") == F.col("_segment")).drop("_segment", "part")
        dealt = chosen.repartition(max(1, min(count, len(ready))), "segment").sortWithinPartitions("segment", "at", "id")
        done = stored(dealt.mapInArrow(continued_pass, PART_SCHEMA), number)
        if todo:
            last = {}
            for row in closings(done):
                if row["segment"] >= last.get(row["account_id"], (-1,))[0]:
                    last[row["account_id"]] = (row["segment"], state(row))
            states = {a: s for a, (_, s) in last.items()}
    for k in range(number + 1):
        for part in (PENDING, CLOSING, SUMMARY):
            remove_folder(spark, f"{folder}/round={k}/part={part}")
    decided = spark.read.schema(PART_SCHEMA + ", round int").parquet(folder).where(F.col("part") == DECIDED)
    return ledger_result(decided)


def ledger_result(decided: DataFrame) -> DataFrame:
    money = "decimal(18,2)"
    return decided.withColumns(
        {
            "amount": (F.col("cents").cast("decimal(20,0)") / 100).cast(money),
            "balance_after": (F.col("balance_cents").cast("decimal(20,0)") / 100).cast(money),
        }
    ).select(*RESULT)


def recorded_transactions(decided: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """The rows the ledger adds to the transactions table.

    A refusal's reason stands in place of the description. A top-up is a deposit in the currency of its account (id, currency), without a
    merchant; any other row keeps what was submitted.
    """
    rows = decided.where("recorded").withColumn("deposit", F.expr("kind = 'topup'"))
    if accounts is not None and "currency" in accounts.columns:
        known = accounts.selectExpr("id AS account_id", "currency AS account_currency")
        rows = salted_join(rows, known, "account_id", tie="id", how="left")
    else:
        rows = rows.withColumn("account_currency", F.lit(None).cast("string"))
    return rows.selectExpr(
        "id",
        "account_id",
        "IF(deposit, NULL, merchant_id) AS merchant_id",
        "amount",
        f"coalesce(IF(deposit, account_currency, currency), '{TOPUP_CURRENCY}') AS currency",
        "IF(deposit, 'deposit', type) AS type",
        "status",
        f"IF(deposit, '{TOPUP_DESCRIPTION}', coalesce(reason, description)) AS description",
        "at AS created_at",
    )


def closing_balances(decided: DataFrame, accounts: DataFrame) -> DataFrame:
    """Balance and status of every account after all events."""
    last = decided.where(F.col("account_status").isNotNull()).groupBy(F.col("account_id").alias("id")).agg(
        F.max(F.struct("at", F.col("id").alias("event_id"), "balance_after", "account_status")).alias("last")
    )
    return accounts.join(last, "id", "left").select(
        "id",
        F.coalesce("last.balance_after", "balance").alias("balance"),
        F.coalesce("last.account_status", "status").alias("status"),
    )


def ledger_outcome_counts(decided: DataFrame) -> DataFrame:
    """Transactions per outcome and their share of all: completed, rejected, insufficient, missing."""
    names = {"C": "completed", "R": "rejected", "I": "insufficient", "M": "missing", "F": "declined"}
    outcome = F.lit(None).cast("string")
    for code, name in names.items():
        outcome = F.when(F.col("outcome") == code, name).otherwise(outcome)
    rows = decided.where(F.col("kind") == "txn")
    counts = [F.count_if(outcome == name).alias(name) for name in names.values()]
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        *counts,
        F.try_divide(F.count_if(F.col("outcome") == "C"), F.count(F.lit(1))).alias("completion_rate"),
    )
