from __future__ import annotations

import glob
import json
import random
from datetime import datetime

import pytest
from helpers import AS_OF, same, txns, values
from pyspark.errors import StreamingQueryException

from ledgerline.operators.state import latest_state
from ledgerline.params import RuleSet, Velocity
from ledgerline.schemas import FRAUD_ALERTS, TRANSACTIONS
from ledgerline.session import shared_dir
from ledgerline.sources.changes import cdc_source
from ledgerline.sources.logs import append_versions, log_since, read_log
from ledgerline.streaming.detect import repaired_windows, rule_windows, stream_detect, stream_rule_windows
from ledgerline.streaming.ingest import start, stream_ingest
from ledgerline.streaming.state import read_state_table, start_state_table
from workload.stream_queries import QUERIES


def message(tid, ts, amount, op="c", **more):
    return json.dumps(
        {"id": tid, "account_id": "a", "amount": str(amount), "currency": "VND", "type": "purchase", "status": "completed",
         "created_at": "2024-01-15T10:00:00Z", "__op": op, "__source_ts_ms": ts, **more}
    )


class Folder:
    def __init__(self, base):
        self.base = base
        (base / "in").mkdir()
        self.n = 0

    def put(self, *lines):
        self.n += 1
        (self.base / "in" / f"{self.n}.json").write_text("\n".join(lines))

    def __getattr__(self, name):
        return str(self.base / name)


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path)


def ingest(spark, f, checkpoint="checkpoint", **kw):
    source = cdc_source(spark, TRANSACTIONS, str(f.base / "in"), fmt="json")
    stream_ingest(source, TRANSACTIONS, f.log, f.dead, getattr(f, checkpoint), trigger=None, **kw).awaitTermination()
    return read_log(spark, f.log, TRANSACTIONS)


def test_absent_log_reads_as_empty(spark, folder):
    assert read_log(spark, folder.log, TRANSACTIONS).count() == 0


def test_ingest_restart_and_replay(spark, folder):
    folder.put(message("1", 10, 5), message("2", 10, 6), "{bad")
    assert ingest(spark, folder).count() == 2
    folder.put(message("1", 20, 7, "u"), message("2", 30, 6, "d"))
    log = ingest(spark, folder)  # continues behind the first file
    assert log.count() == 4
    assert values(latest_state(log), "id", "amount")[0][0] == "1" and latest_state(log).count() == 1
    replay = ingest(spark, folder, "fresh")  # a new consumer reads everything again
    assert replay.count() == 8
    columns = ["id", "amount", "cdc_op", "_source_ts_ms"]
    assert same(latest_state(log).select(columns), latest_state(replay).select(columns))
    assert spark.read.parquet(folder.dead).count() == 2


def test_added_column_does_not_break_ingest(spark, folder):
    folder.put(message("1", 10, 5, loyalty_tier="gold"))
    assert values(ingest(spark, folder), "id") == [("1",)]


def test_too_many_broken_messages_stop_the_stream_but_are_kept(spark, folder):
    folder.put(*["{bad"] * 11, message("1", 10, 5))
    with pytest.raises(StreamingQueryException):
        ingest(spark, folder)
    assert spark.read.parquet(folder.dead).count() == 11
    assert ingest(spark, folder, max_corrupt=11).count() == 1  # the batch is repeated, not doubled
    assert spark.read.parquet(folder.dead).count() == 11


def test_a_repeated_batch_replaces_itself(spark, folder):
    rows = txns(spark, [("1", "a", 5, 5)])
    for _ in range(2):
        append_versions(rows, folder.log, "w", 3)
    append_versions(rows, folder.log, "other", 3)
    assert spark.read.parquet(folder.log).count() == 2


def test_month_pruning(spark, folder):
    early = txns(spark, [("1", "a", 5, 86_400 * 60), ("2", "a", 5, 60)])
    append_versions(early, folder.log, "w", 0)
    recent = log_since(read_log(spark, folder.log, TRANSACTIONS), AS_OF, 3600)
    assert values(recent, "id") == [("2",)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan and "202405" in plan


def test_state_table_equals_batch_state(spark, folder):
    schema = "id string, amount int, cdc_op string, _source_ts_ms bigint"
    rows = [("a", 1, "c", 1), ("b", 1, "c", 1), ("a", 3, "u", 3), ("a", 2, "u", 2), ("b", 1, "d", 5), ("c", 1, "c", 1), ("c", 1, "c", 1)]
    for i in range(0, 7, 2):  # several batches, out of order
        spark.createDataFrame(rows[i : i + 2], schema).coalesce(1).write.mode("append").parquet(folder.versions)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder.versions)
    start_state_table(stream, folder.state, folder.checkpoint, trigger=None).awaitTermination()
    state = read_state_table(spark.read.parquet(folder.state))
    assert values(state, "id", "amount") == [("a", 3), ("c", 1)]


def test_detection_stream_is_repeatable(spark, folder):
    t = txns(spark, [("1", "a", 200_000_000, 5)])
    t.write.parquet(folder.arrivals)
    merchants = spark.createDataFrame([("m1", "x", "c", "low")], "id string, name string, category string, risk_level string")
    people = spark.createDataFrame([("a",)], "id string")

    def load():
        return t, merchants, people, read_log(spark, folder.alerts, FRAUD_ALERTS)

    arrivals = spark.readStream.schema(t.schema).parquet(folder.arrivals)
    for name in ("c1", "c2"):  # the second consumer finds the cases of the first and stays quiet
        stream_detect(arrivals, load, folder.alerts, getattr(folder, name), trigger=None).awaitTermination()
    assert values(read_log(spark, folder.alerts, FRAUD_ALERTS), "rule_code") == [("LARGE_AMT",), ("VELOCITY",)]


def test_event_time_windows(spark, folder):
    rows = [(f"v{i}", "v", 1, i) for i in range(11)] + [(f"m{c}", "m", 1, 5, {"currency": c}) for c in ("VND", "USD", "EUR")]
    rows += [(f"f{i}", "f", 1, 5, {"status": "failed"}) for i in range(3)]
    t = txns(spark, rows)
    t.coalesce(1).write.parquet(folder.txn)
    for days in (-1, -2):  # later rows let go of what came before
        txns(spark, [("x", "x", 1, 86_400 * days)]).coalesce(1).write.mode("append").parquet(folder.txn)
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder.txn)
    for code, flagged in stream_rule_windows(stream).items():
        out = getattr(folder, code)

        def write(df, n, out=out):
            df.write.mode("overwrite").parquet(f"{out}/{n}")

        start(flagged.writeStream.outputMode("append").foreachBatch(write), getattr(folder, f"{code}-c"), None).awaitTermination()
        told = spark.read.parquet(f"{out}/*")
        assert {r.account_id for r in told.collect()} == {code[0].lower()}, code
        assert same(told, rule_windows(t)[code])


def brute_windows(rows, window_s, pane_s):
    """(account, start) -> rows in the window, for all windows with a row."""
    out = {}
    for account, at in rows:
        first = at // pane_s * pane_s
        for k in range(window_s // pane_s):
            out.setdefault((account, first - k * pane_s), []).append(at)
    return out


def test_windows_and_their_repair_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("aaabc"), rnd.randrange(4000)) for _ in range(400)]
    rules = RuleSet(velocity=Velocity(window_s=300, max_count=12))
    made = spark.createDataFrame([(a, t, k % 4 == 0) for k, (a, t) in enumerate(rows)], "account_id string, t int, late boolean").selectExpr(
        "account_id", "timestamp_seconds(t) AS created_at", "late", "CAST(1 AS DECIMAL(18,2)) AS amount", "'VND' AS currency", "'failed' AS status"
    )
    want = {(a, s, len(x)) for (a, s), x in brute_windows(rows, 300, 30).items() if len(x) > 12}
    shown = lambda df: {(r.account_id, int(r.window_start.timestamp()), r.txn_count) for r in df.collect()}
    assert shown(rule_windows(made, rules)["VELOCITY"]) == want and len(want) > 20
    told = rule_windows(made.where("NOT late"), rules)["VELOCITY"]
    assert shown(told) != want
    assert shown(repaired_windows(told, made, made.where("late"), "VELOCITY", rules)) == want
    with pytest.raises(ValueError, match="not made of panes"):
        rule_windows(made, rules, 7)


def test_rows_of_the_window_streams_are_written_by_all_tasks(spark, tmp_path):
    events = spark.range(0, 400, 1, 4).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 600) AS ts", "id % 3 AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    runs = set(glob.glob(f"{shared_dir(spark)}/stream-*"))
    told = QUERIES["stream_rule_windows"][0](spark, str(tmp_path)).collect()
    (run,) = set(glob.glob(f"{shared_dir(spark)}/stream-*")) - runs
    counts = sorted(spark.read.parquet(f).count() for f in glob.glob(f"{run}/txn/*.parquet"))
    assert sum(counts) == 402 and max(counts) == 100
    want = brute_windows([(str(k % 3), 1704067200 + k * 600) for k in range(400)], 86_400, 6 * 3600)
    shown = {(r.account_id, int((r.window_start - datetime(1970, 1, 1)).total_seconds()), r.txn_count) for r in told}
    assert shown == {(a, at, len(x)) for (a, at), x in want.items() if len(x) > 5}
