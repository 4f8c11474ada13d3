"""Registered queries: the streaming jobs, each run over everything available.

The messages are derived from the supplied tables and put as files under the shared
folder, where the streams read them; results are read back from what they wrote.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import ledger as B
from ledgerline.operators.state import latest_state, rewrite_compacted
from ledgerline.operators.typing import promote, type_rows
from ledgerline.schemas import FRAUD_ALERTS, TRANSACTIONS, WHOLE
from ledgerline.session import shared_dir
from ledgerline.sources.changes import cdc_source, parse_flat
from ledgerline.sources.generations import version_log
from ledgerline.sources.logs import append_versions, read_log, version_log_sink
from ledgerline.streaming.detect import repaired_windows, rule_windows, stream_detect, stream_rule_windows, tumbling_minutes
from ledgerline.streaming.ingest import dedup_replays, start, stream_ingest
from ledgerline.streaming.ledger import HEARTBEAT, event_time_ledger, start_ledger, wire_timeline
from ledgerline.streaming.state import read_state_table, start_state_table
from ledgerline.streaming.views import read_volume_view, start_volume_view
from workload import adapters as A
from workload.adapters import AS_OF, RULES, out, with_views
from workload.alert_queries import CASES, RULE_VIEWS
from workload.ledger_queries import fold_sql
from workload.rule_queries import ALL_FLAGS, PAYLOADS
from workload.rule_queries import T as NOW
from workload.state_queries import TYPED


BROKEN = 1000  # of 65,536 messages: one in 97 is broken


class Run:
    """Folders of one streaming run."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def messages(self, records: DataFrame, copies: int = 1) -> DataFrame:
        """Write message values as text files and read them back as the file form of a topic."""
        for _ in range(copies):
            records.select(F.coalesce("value", F.lit("")).alias("value")).write.mode("append").text(self.path("in"))
        return cdc_source(self.spark, TRANSACTIONS, self.path("in"), fmt="json")

    def finish(self, query) -> None:
        query.awaitTermination()

    def append(self, rows: DataFrame, name: str, mode: str = "append") -> DataFrame:
        """Run a stream to its end, each batch into its own folder, and read the rows."""

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch_id").parquet(self.path(name))

        self.finish(start(rows.writeStream.outputMode(mode).foreachBatch(write), self.path(f"{name}-checkpoint"), None))
        return self.spark.read.schema(rows.schema.add("batch_id", T.LongType())).parquet(self.path(name))


def sourced(s, d):
    """Messages through the source, one row each."""
    run = Run(s)
    flat = parse_flat(run.messages(A.wire_records(s, d)), TRANSACTIONS)
    rows = flat.select("id", "account_id", "amount", "type", F.col("__op").alias("op"), F.col("__source_ts_ms").alias("ts_ms"))
    return out(run.append(rows, "rows").drop("batch_id"))


TYPED_NAMES = ["id", "account_id", "merchant_id", "amount", "currency", "type", "status", "description", "created_at", "updated_at", "cdc_op", "_source_ts_ms"]


def ingest(run: Run, records: DataFrame, checkpoint: str = "ingest-checkpoint", **kw) -> DataFrame:
    query = stream_ingest(records, TRANSACTIONS, run.path("log"), run.path("dead"), run.path(checkpoint), trigger=None, **kw)
    run.finish(query)
    return read_log(run.spark, run.path("log"), TRANSACTIONS)


def ingested(s, d):
    """Messages, one in 97 broken, to the version log; the dead letters are kept apart."""
    run = Run(s)
    log = ingest(run, run.messages(A.wire_records(s, d, broken=True)), max_corrupt=BROKEN)
    good = log.select(*TYPED_NAMES)
    dead = s.read.parquet(run.path("dead")).select(F.lit("dead").alias("id"), F.col("_corrupt_record").alias("description"))
    return out(good.unionByName(dead, allowMissingColumns=True))


def refused(s, d):
    """More broken messages than the default tolerance: the batch fails, its dead letters are kept, the log stays empty."""
    run = Run(s)
    try:
        log = ingest(run, run.messages(A.wire_records(s, d, broken=True, every=31)))
        failed = False
    except StreamingQueryException:
        log, failed = read_log(s, run.path("log"), TRANSACTIONS), True
    dead = s.read.parquet(run.path("dead")).agg(F.count(F.lit(1)).alias("dead"))
    return out(dead.crossJoin(log.agg(F.count(F.lit(1)).alias("stored"))).withColumn("failed", F.lit(failed)))


def state_from_log(s, d):
    """Changes with one commit time through the stored log, and again through its compacted form."""
    run = Run(s)
    A.tied_records(s, d).write.json(run.path("in"))
    log = ingest(run, cdc_source(s, TRANSACTIONS, run.path("in"), fmt="records"))
    rewrite_compacted(log, run.path("compacted"), 210001, TRANSACTIONS)
    both = [("log", log), ("compacted", s.read.schema(log.schema).parquet(run.path("compacted")))]
    states = [latest_state(rows).select(F.lit(name).alias("read_from"), "id", "account_id", "amount", "status", "_offset") for name, rows in both]
    return out(states[0].unionByName(states[1]))


def promoted(s, d):
    """A field that nobody declared, and that changes its kind in the middle of the topic, read as a column once it is declared."""
    run = Run(s)
    text = "regexp_replace(value, '\"promo_code\":\"promo\"', concat('\"promo_code\":', CAST(key AS BIGINT) % 7, ',\"extra\":{\"a\":[1]}'))"
    records = A.wire_records(s, d).withColumn("value", F.expr(f"IF(CAST(key AS BIGINT) % 2 = 0, {text}, value)"))
    records.write.json(run.path("in"))
    ingest(run, cdc_source(s, TRANSACTIONS, run.path("in"), fmt="records"), remainder=True)
    newer = replace(TRANSACTIONS, columns={**TRANSACTIONS.columns, "promo_code": WHOLE})
    log = promote(read_log(s, run.path("log"), newer, remainder=True), newer)
    return out(latest_state(log).select("id", "amount", "promo_code", F.try_variant_get("_rest", "$.extra.a[0]", "int").alias("extra")))


def viewed(s, d):
    """Volume per minute kept from changes that come in no order, some of them twice."""
    run = Run(s)
    rows = A.versions(s, d)
    for part in ("_partition % 3 = 0", "_partition % 3 = 1 OR _partition = 0", "cdc_op <> 'c'", "_partition % 3 = 2"):
        # one micro-batch each
        rows.where(part).write.mode("append").parquet(run.path("versions"))
        stream = s.readStream.schema(rows.schema).parquet(run.path("versions"))
        run.finish(start_volume_view(stream, run.path("view"), run.path("view-checkpoint"), trigger=None))
    return out(read_volume_view(s, run.path("view")))


def from_generations(s, d):
    """Changes in four batches with generations published between them, read back as generation and tail, and once as of the generation before."""
    run = Run(s)
    log = version_log(s, run.path("log"), TRANSACTIONS)
    rows = A.versions(s, d)
    for batch, part in enumerate(("cdc_op = 'c' AND _partition < 3", "cdc_op = 'c' AND _partition >= 3", "cdc_op = 'u'", "cdc_op = 'd'")):
        append_versions(rows.where(part), run.path("log"), "supplied", batch)
        if batch in (1, 2):
            log.publish({"supplied": batch})
    columns = ("id", "account_id", "amount", "status", "_source_ts_ms")
    now = latest_state(log.read()).select(F.lit("now").alias("read_from"), *columns)
    earlier = latest_state(log.read(log.manifest(1))).select(F.lit("earlier").alias("read_from"), *columns)
    return out(now.unionByName(earlier))


def sunk(s, d):
    """Typed messages through the version-log sink: rows per month folder."""
    run = Run(s)
    typed = type_rows(parse_flat(run.messages(A.wire_records(s, d)), TRANSACTIONS).drop("_corrupt_record"), TRANSACTIONS)
    sink = version_log_sink(run.path("log"), run.path("sink-checkpoint"))
    run.finish(start(typed.writeStream.foreachBatch(sink), run.path("sink-checkpoint"), None))
    log = read_log(s, run.path("log"), TRANSACTIONS)
    stamped = F.count_if(F.col("_ingested_at").isNotNull())
    return out(log.groupBy("yyyymm").agg(F.count(F.lit(1)).alias("rows"), stamped.alias("stamped"), F.countDistinct("writer").alias("writers")))


def replayed(s, d):
    """The same messages twice under a fresh checkpoint: the state does not change."""
    run = Run(s)
    ingest(run, run.messages(A.wire_records(s, d)), "first-checkpoint")
    log = ingest(run, cdc_source(s, TRANSACTIONS, run.path("in"), fmt="json"), "second-checkpoint")
    return out(latest_state(log).select(*TYPED_NAMES))


def deduplicated(s, d):
    """Every message delivered twice, one of each kept."""
    run = Run(s)
    versions = type_rows(parse_flat(run.messages(A.wire_records(s, d), copies=2), TRANSACTIONS).drop("_corrupt_record"), TRANSACTIONS)
    return out(run.append(dedup_replays(versions).select(*TYPED_NAMES), "rows").drop("batch_id"))


def tied_once(s, d):
    """Three changes of a row in one source transaction, each delivered twice: all three are kept, once."""
    run = Run(s)
    versions = type_rows(parse_flat(run.messages(A.tied_records(s, d), copies=2), TRANSACTIONS).drop("_corrupt_record"), TRANSACTIONS)
    return out(run.append(dedup_replays(versions).select("id", "account_id", "amount", "status", "cdc_op", "_source_ts_ms"), "rows").drop("batch_id"))


def log_stream(run: Run, s, d) -> DataFrame:
    """The version log as a stream of files."""
    log = A.cdc_log(s, d)
    log.write.mode("append").parquet(run.path("versions"))
    return s.readStream.schema(log.schema).option("maxFilesPerTrigger", 4).parquet(run.path("versions"))


def maintained(s, d):
    """Current state kept by the streaming aggregate."""
    run = Run(s)
    versions = log_stream(run, s, d).drop("yyyymm")
    run.finish(start_state_table(versions, run.path("state"), run.path("state-checkpoint"), trigger=None))
    state = read_state_table(s.read.parquet(run.path("state")))
    return out(state.select("id", "account_id", "merchant_id", "amount", "currency", "type", "status", "cdc_op", "_source_ts_ms", "_offset"))


def detected(s, d):
    """One detection pass per batch of arrivals into the alert log."""
    run = Run(s)
    A.txn(s, d).select("id", "created_at").write.parquet(run.path("arrivals"))
    arrivals = s.readStream.schema("id string, created_at timestamp").parquet(run.path("arrivals"))

    def load():
        return A.txn(s, d), A.merchants(s, d), A.accounts(s, d), read_log(s, run.path("alerts"), FRAUD_ALERTS)

    query = stream_detect(arrivals, load, run.path("alerts"), run.path("detect-checkpoint"), as_of=lambda _: AS_OF, rules=RULES, trigger=None)
    run.finish(query)
    alerts = read_log(s, run.path("alerts"), FRAUD_ALERTS)
    return out(alerts.select("rule_code", "account_id", F.col("txn_count").cast("bigint").alias("txn_count"), "total_amount", "severity", "evidence", "status", "created_at"))


def appended(s, d):
    """New cases of the rules appended batch-wise to the alert log, then counted."""
    return out(detected(s, d).groupBy("rule_code", "status").agg(F.count(F.lit(1)).alias("cases")))


def txn_stream(run: Run, s, d) -> DataFrame:
    rows = A.txn(s, d).select("id", "account_id", "amount", "currency", "type", "status", "created_at")
    rows.write.parquet(run.path("txn"))
    return s.readStream.schema(rows.schema).parquet(run.path("txn"))


PANE_S = 6 * 3600


def windows(code):
    """A rule over windows of days that slide by six hours; a last row far ahead lets the stream tell all of them."""

    def run_stream(s, d):
        run = Run(s)
        rows = A.txn(s, d).select("id", "account_id", "amount", "currency", "type", "status", "created_at")
        ahead = rows.agg(F.max("created_at").alias("last")).selectExpr(
            "'' AS id", "'' AS account_id", "CAST(0 AS DECIMAL(18,2)) AS amount", "'VND' AS currency", "'' AS type", "'' AS status",
            "explode(array(last + INTERVAL 50 DAYS, last + INTERVAL 100 DAYS)) AS created_at",
        )
        told = None
        for part in (rows, ahead):  # one micro-batch each
            part.write.mode("append").parquet(run.path("txn"))
            stream = s.readStream.schema(rows.schema).parquet(run.path("txn"))
            told = run.append(stream_rule_windows(stream, RULES, "40 days", PANE_S)[code], "windows").drop("batch_id")
        told = told.where("account_id <> ''")
        return out(told.withColumn("currencies", F.array_join("currencies", ",")) if code == "MULTI_CCY" else told)

    return run_stream


def repaired(s, d):
    """The velocity rule where a third of the rows came too late, put right by a batch pass."""
    txns = A.txn(s, d)
    is_late = "CAST(id AS BIGINT) % 3 = 0"
    told = rule_windows(txns.where(f"NOT ({is_late})"), RULES, PANE_S)["VELOCITY"]
    return out(repaired_windows(told, txns, txns.where(is_late), "VELOCITY", RULES, PANE_S))


def windows_sql(days, columns, having):
    return with_views(
        f"""SELECT * FROM (SELECT account_id, w AS window_start, w + INTERVAL {24 * days} HOUR AS window_end, {columns} FROM (
    SELECT account_id, amount, currency, status, time_bucket(INTERVAL 6 HOUR, created_at, TIMESTAMP '1970-01-01 00:00:00') - to_hours(6 * CAST(i AS INTEGER)) AS w
    FROM txn, range({4 * days}) r(i)) GROUP BY account_id, w) WHERE {having}""",
        "txn",
    )


VELOCITY_WINDOWS = windows_sql(
    1, "'VELOCITY' AS rule_code, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount", "txn_count > 5 OR total_amount > 300"
)


def minutes(s, d):
    run = Run(s)
    rows = run.append(tumbling_minutes(txn_stream(run, s, d), "40 days"), "minutes", "update")
    last = rows.groupBy("minute").agg(F.max(F.struct("batch_id", "txn_count", "total_amount")).alias("l"))
    return out(last.select("minute", "l.txn_count", "l.total_amount"))


def streamed_ledger(s, d):
    """The ledger over a stream of JSON events."""
    run = Run(s)
    timeline = B.ledger_timeline(A.ledger_events(s, d), A.ledger_accounts(s, d))
    precise = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    timeline.select(F.to_json(F.struct("*"), precise).alias("value")).write.text(run.path("in"))
    events = wire_timeline(s.readStream.format("text").load(run.path("in")))
    run.finish(start_ledger(events, run.path("decided"), run.path("balances"), run.path("ledger-checkpoint"), trigger=None))
    return out(s.read.parquet(run.path("decided")).drop("batch_id"))


def ordered_ledger(s, d):
    """The ledger by event time, over micro-batches that hold the events in no order at all."""
    run = Run(s)
    events = B.ledger_timeline(A.ledger_events(s, d), A.ledger_accounts(s, d).limit(0))
    last = events.agg(F.max("at").alias("at")).selectExpr("explode(array(at + INTERVAL 41 DAYS, at + INTERVAL 42 DAYS)) AS at", "'' AS account_id", "'' AS id")
    beats = last.selectExpr("*", f"'{HEARTBEAT}' AS kind", "1 AS rank")
    precise = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    decided = None
    for rows in [events.where(f"pmod(xxhash64(id), 3) = {k}") for k in range(3)] + [beats, beats]:  # one micro-batch each
        rows.select(F.to_json(F.struct("*"), precise).alias("value")).write.mode("append").text(run.path("in"))
        stream = wire_timeline(s.readStream.format("text").load(run.path("in")))
        decided = run.append(event_time_ledger(stream, A.ledger_accounts(s, d), "40 days"), "decided")
    return out(decided.drop("batch_id"))


TYPED_LIST = ", ".join(TYPED_NAMES)
QUERIES = {
    "cdc_source": (
        sourced,
        """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS account_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  event_type AS type, CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS op, epoch_us(ts) // 1000 AS ts_ms FROM events""",
    ),
    "stream_ingest": (
        ingested,
        with_views(
            f"SELECT {TYPED_LIST} FROM typed WHERE event_id % 97 <> 5 AND event_id % 89 <> 7 UNION ALL "
            "SELECT 'dead', NULL, NULL, NULL, NULL, NULL, NULL, '{bad', NULL, NULL, NULL, NULL FROM events WHERE event_id % 97 = 5",
            "txn",
            extra=(TYPED,),
        ),
    ),
    "state_from_log": (
        state_from_log,
        """SELECT read_from, CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS account_id,
  CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'failed' AS status, event_id // 6 * 3 + 2 AS _offset
FROM events, (VALUES ('log'), ('compacted')) v(read_from) WHERE event_id % 10 <> 9""",
    ),
    "schema_promotion": (
        promoted,
        "SELECT CAST(event_id AS VARCHAR) AS id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount, "
        "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 7 AS INTEGER) END AS promo_code, CASE WHEN event_id % 2 = 0 THEN 1 END AS extra "
        "FROM events WHERE event_id % 10 <> 9",
    ),
    "volume_view": (
        viewed,
        with_views(
            "SELECT date_trunc('minute', created_at) AS minute, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount, "
            "count(*) FILTER (WHERE status = 'failed') AS failed_count, count(*) FILTER (WHERE status = 'flagged') AS flagged_count "
            "FROM txn WHERE event_id % 10 <> 9 GROUP BY 1",
            "txn",
        ),
    ),
    "log_generations": (
        from_generations,
        with_views(
            "SELECT read_from, id, account_id, CAST(amount AS DOUBLE) AS amount, status, source_ts_ms + 1000 AS _source_ts_ms "
            "FROM txn, (VALUES ('now'), ('earlier')) v(read_from) WHERE event_id % 10 <> 9",
            "txn",
        ),
    ),
    "version_log_sink": (
        sunk,
        with_views(
            "SELECT CAST(strftime(created_at, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS rows, count(*) AS stamped, 1 AS writers FROM typed GROUP BY 1",
            "txn",
            extra=(TYPED,),
        ),
    ),
    "stream_replay": (replayed, with_views(f"SELECT {TYPED_LIST} FROM typed WHERE cdc_op <> 'd'", "txn", extra=(TYPED,))),
    "dedup_replays": (deduplicated, with_views(f"SELECT {TYPED_LIST} FROM typed", "txn", extra=(TYPED,))),
    "dedup_replays_tied": (
        tied_once,
        """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS account_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  CASE step WHEN 0 THEN 'pending' WHEN 1 THEN 'completed' ELSE 'failed' END AS status,
  CASE WHEN step = 0 THEN 'c' WHEN step = 2 AND event_id % 10 = 9 THEN 'd' ELSE 'u' END AS cdc_op, epoch_us(ts) // 1000 AS _source_ts_ms
FROM events, range(3) r(step)""",
    ),
    "stream_ingest_refused": (
        refused,
        "SELECT count(*) AS dead, CAST(0 AS BIGINT) AS stored, true AS failed FROM events WHERE event_id % 31 = 5",
    ),
    "latest_state_stream": (
        maintained,
        with_views(
            "SELECT id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, cdc_op, source_ts_ms AS _source_ts_ms, off AS _offset "
            "FROM newest WHERE cdc_op <> 'd'",
            "newest",
        ),
    ),
    "stream_detect": (
        detected,
        with_views(
            f"SELECT rule_code, account_id, txn_count, total_amount, severity, evidence, 'open' AS status, {NOW} AS created_at FROM cases",
            *RULE_VIEWS,
            extra=(*ALL_FLAGS, PAYLOADS, CASES),
        ),
    ),
    "alert_sink": (
        appended,
        with_views(
            "SELECT rule_code, 'open' AS status, count(*) AS cases FROM cases GROUP BY rule_code", *RULE_VIEWS, extra=(*ALL_FLAGS, PAYLOADS, CASES)
        ),
    ),
    "stream_rule_windows": (windows("VELOCITY"), VELOCITY_WINDOWS),
    "stream_rule_windows_currencies": (
        windows("MULTI_CCY"),
        windows_sql(
            1,
            "'MULTI_CCY' AS rule_code, count(*) AS txn_count, string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies, "
            "count(DISTINCT currency) AS used",
            "used > 2",
        ).replace("SELECT * FROM (SELECT account_id", "SELECT * EXCLUDE (used) FROM (SELECT account_id"),
    ),
    "stream_rule_windows_failures": (
        windows("FAIL_SPIKE"),
        windows_sql(
            2,
            "'FAIL_SPIKE' AS rule_code, count(*) FILTER (WHERE status = 'failed') AS failed_count, count(*) AS total_count, "
            "round_even(CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) * 100, 1) AS fail_rate_pct",
            "failed_count >= 2 AND fail_rate_pct > 30",
        ),
    ),
    "repaired_windows": (repaired, VELOCITY_WINDOWS),
    "stream_tumbling_minutes": (
        minutes,
        with_views(
            "SELECT date_trunc('minute', created_at) AS minute, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM txn GROUP BY 1", "txn"
        ),
    ),
    "stream_ledger": (streamed_ledger, fold_sql("SELECT * EXCLUDE (n) FROM decided")),
    "stream_ledger_event_time": (ordered_ledger, fold_sql("SELECT * EXCLUDE (n) FROM decided")),
}
