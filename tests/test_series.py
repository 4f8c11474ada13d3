"""Windows over history, merged quantiles, differing rows and retracting views against plain Python."""

from __future__ import annotations

import random

import pytest
from helpers import AS_OF, hot, same
from pyspark.sql import functions as F

from ledgerline.operators.dashboards import volume_per_minute
from ledgerline.operators.history import velocity_any_window, window_ends
from ledgerline.operators.reconcile import checksums, differences, differing_leaves
from ledgerline.operators.sketches import RANK_ERROR, delay_sketches, merged_quantiles
from ledgerline.operators.state import latest_state
from ledgerline.params import Velocity
from ledgerline.streaming.ingest import start
from ledgerline.streaming.views import read_volume_view, start_volume_view, volume_deltas


def timed(spark, rows):
    return spark.createDataFrame(rows, "account_id string, t long, amount string").selectExpr(
        "account_id", "timestamp_micros(t) AS created_at", "CAST(amount AS DECIMAL(18,2)) AS amount"
    )


@pytest.mark.parametrize("slice_s", [300, 450, 3600])
def test_windows_of_any_start_equal_brute_force(spark, slice_s):
    rnd = random.Random(slice_s)
    second = 1_000_000
    rows = [(rnd.choice("aab"), rnd.randrange(-2000, 4000) * second + rnd.choice([0, 0, 1, 999_999]), f"{rnd.randrange(900) / 100:.2f}") for _ in range(500)]
    rows += [("edge", 0, "1"), ("edge", 300 * second, "1"), ("edge", 600 * second + 1, "1"), ("tie", 5, "1"), ("tie", 5, "2"), (None, 5, "1"), ("none", None, "1")]
    want = {}
    for account, t, _ in rows:
        if account is not None and t is not None:
            held = [float(x) for a, u, x in rows if a == account and u is not None and t - 300 * second <= u <= t]
            want[account, t] = len(held), round(sum(held), 2)
    got = {(r["account_id"], r["at"]): (r["txn_count"], float(r["total_amount"])) for r in window_ends(timed(spark, rows), 300, slice_s).collect()}
    assert got == want and got["edge", 300 * second][0] == 2 and got["edge", 600 * second + 1][0] == 1 and got["tie", 5][0] == 2
    flagged = {r["account_id"]: tuple(r)[1:3] for r in velocity_any_window(timed(spark, rows), Velocity(300, 12, 10**9), slice_s).collect()}
    peaks = {a: (max(n for (b, _), (n, _) in want.items() if b == a), max(x for (b, _), (_, x) in want.items() if b == a)) for a, _ in want}
    assert flagged == {a: p for a, p in peaks.items() if p[0] > 12} and flagged
    with pytest.raises(ValueError, match="slice"):
        window_ends(timed(spark, rows), 300, 200)


def test_a_hot_account_is_cut_into_slices(spark):
    rows = hot(spark, 30_000).withColumn("created_at", F.expr(f"TIMESTAMP '{AS_OF}' - make_dt_interval(0, 0, 0, id)"))
    sizes = [r["count"] for r in window_ends(rows, 60, 600).where("account_id = 'hot'").groupBy("slice").count().collect()]
    assert len(sizes) > 40 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_an_hour_is_answered_from_sixty_sketches(spark):
    log = spark.range(60_000).selectExpr(
        "timestamp_micros(1714557600000000 + id % 3600 * 1000000) AS _ingested_at", "1714557600000 + id % 3600 * 1000 - CAST(pow(id % 7919, 1.5) AS BIGINT) AS _source_ts_ms"
    )
    sketches = delay_sketches(log)
    assert sketches.count() == 60
    lags = sorted(int((k % 7919) ** 1.5) for k in range(60_000))
    row = merged_quantiles(sketches, "2024-05-01 10:00:00", "2024-05-01 11:00:00").first()
    assert row["rows"] == 60_000
    for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        below, most = sum(x < row[name] for x in lags), sum(x <= row[name] for x in lags)
        assert below <= (p + RANK_ERROR) * 60_000 + 1 and most >= (p - RANK_ERROR) * 60_000 - 1
    quarters = merged_quantiles(sketches, "2024-05-01 10:00:00", "2024-05-01 10:45:00", (0.5,), by_s=900).collect()
    assert [r["rows"] for r in quarters] == [sum(k * 900 <= n % 3600 < k * 900 + 900 for n in range(60_000)) for k in range(3)]
    assert merged_quantiles(sketches, "2024-05-02 10:00:00", "2024-05-02 11:00:00").count() == 0


def test_one_changed_and_one_lost_row_are_named(spark):
    left = spark.range(1_000_000).selectExpr("CAST(id AS STRING) AS id", "id % 977 AS amount", "IF(id % 5 = 0, NULL, 'x') AS note")
    right = left.where("id <> '77777'").withColumn("amount", F.expr("IF(id = '123456', amount + 1, amount)"))
    assert sorted(map(tuple, differences(left, right).collect())) == [("123456", 1, 1), ("77777", 1, 0)]
    assert differences(left, left).isEmpty()
    assert differing_leaves(checksums(left), checksums(left)) == []


def test_differences_with_nulls_and_repeated_rows(spark):
    schema = "id string, a string, b string, _ingested_at int"
    left = spark.createDataFrame([("1", None, "x", 1), ("2", "x", None, 1), ("3", "a", "b", 1), ("3", "a", "b", 1), (None, "n", "n", 1), ("4", "q", "q", 1)], schema)
    right = spark.createDataFrame([("1", "x", None, 2), ("2", "x", None, 2), ("3", "a", "b", 2), (None, "n", "m", 2), ("4", "q", "q", 2), ("5", "", "", 2)], schema)
    got = {(r["id"], r["left_rows"], r["right_rows"]) for r in differences(left, right).collect()}
    assert got == {("1", 1, 1), ("3", 2, 1), (None, 1, 1), ("5", 0, 1)}
    assert differences(left.limit(0), right.limit(0)).isEmpty() and differences(left, right.limit(0)).count() == 5


def test_view_takes_back_what_rows_no_longer_say(spark, tmp_path):
    rnd = random.Random(6)
    minutes = [f"2024-05-01 11:{m:02d}:30" for m in range(9)]
    rows = []
    for k in range(240):
        rows.append((f"t{rnd.randrange(30)}", f"{rnd.randrange(9999) / 100:.2f}", rnd.choice(["failed", "flagged", "completed"]), rnd.choice(minutes), rnd.choice("cuuud"), k // 5, k))
    schema = "id string, amount string, status string, at string, cdc_op string, _source_ts_ms long, _offset long"
    versions = spark.createDataFrame(rows, schema).selectExpr("id", "CAST(amount AS DECIMAL(18,2)) AS amount", "status", "CAST(at AS TIMESTAMP) AS created_at", "cdc_op", "_source_ts_ms", "_offset")
    names = [str(tmp_path / n) for n in ("in", "view", "checkpoint")]
    order = list(range(6))
    rnd.shuffle(order)

    def put(k):
        versions.where(f"_offset % 6 = {k}").coalesce(1).write.mode("append").parquet(names[0])

    def run():
        stream = spark.readStream.schema(versions.schema).option("maxFilesPerTrigger", 1).parquet(names[0])
        start_volume_view(stream, names[1], names[2], trigger=None).awaitTermination()
        return read_volume_view(spark, names[1])

    for k in order[:3]:
        put(k)
    early = run()
    assert same(early, volume_per_minute(latest_state(versions.where(f"_offset % 6 IN ({', '.join(map(str, order[:3]))})")), AS_OF, 7200))
    for k in [*order[3:], order[0], order[4]]:  # the rest, and two batches once more
        put(k)
    assert same(run(), volume_per_minute(latest_state(versions), AS_OF, 7200))


def test_the_state_of_a_view_has_a_key_a_bucket_and_not_a_row(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "CAST(id % 1000 AS STRING) AS id", "CAST(1 AS DECIMAL(18,2)) AS amount", "'failed' AS status",
        "timestamp_seconds(id % 1000 * 60) AS created_at", "IF(id >= 2000 AND id % 4 = 0, 'd', 'u') AS cdc_op", "id AS _source_ts_ms", "id AS _offset",
    )
    rows.write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    deltas = volume_deltas(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), buckets=16)
    query = start(deltas.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.parquet(f"{out}/{n}")), str(tmp_path / "c"), None)
    query.awaitTermination()
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 16
    told = spark.read.parquet(f"{out}/*")
    assert told.agg(F.sum("txn_count"), F.sum("cents"), F.sum("failed_count")).first() == (750, 75_000, 750)
    assert told.select("minute_us").distinct().count() == 750
