from __future__ import annotations

from helpers import same, values
from pyspark.sql import functions as F

from ledgerline.operators import state as S

LOG = "id string, amount int, cdc_op string, _source_ts_ms bigint, _offset bigint, created_at timestamp, yyyymm int"


def log(spark, rows):
    raw = spark.createDataFrame(rows, "id string, amount int, cdc_op string, _source_ts_ms bigint, _offset bigint, created string")
    return raw.selectExpr(
        "id", "amount", "cdc_op", "_source_ts_ms", "_offset", "CAST(created AS TIMESTAMP) AS created_at",
        "CAST(date_format(CAST(created AS TIMESTAMP), 'yyyyMM') AS INT) AS yyyymm",
    )


ROWS = [
    ("a", 1, "c", 100, 0, "2024-01-05"),
    ("a", 3, "u", 300, 2, "2024-01-05"),
    ("a", 2, "u", 200, 1, "2024-01-05"),  # arrives late
    ("b", 5, "c", 100, 3, "2024-01-06"),
    ("b", None, "d", 400, 9, "2024-02-01"),  # delete marker with its key only
    ("c", 7, "r", 50, 4, "2024-02-02"),
    ("c", 7, "r", 50, 4, "2024-02-02"),  # delivered twice
    ("d", 1, "c", 100, 5, "2024-02-03"),
    ("d", 2, "u", 100, 6, "2024-02-03"),  # same version, later offset
]


def test_latest_state(spark):
    assert values(S.latest_state(log(spark, ROWS)), "id", "amount") == [("a", 3), ("c", 7), ("d", 2)]
    assert values(S.latest_state(log(spark, ROWS), keep_deleted=True), "id", "cdc_op") == [("a", "u"), ("b", "d"), ("c", "r"), ("d", "u")]
    assert values(S.deleted_rows(log(spark, ROWS)), "id") == [("b",)]


def test_insert_and_three_updates_give_one_row(spark):
    rows = [("t", 100 * i, "c" if i == 1 else "u", i, i, "2024-01-01") for i in range(1, 5)]
    assert values(S.latest_state(log(spark, rows)), "id", "amount") == [("t", 400)]


def test_state_does_not_depend_on_arrival(spark):
    once = log(spark, ROWS)
    shuffled = once.union(once).orderBy(F.rand(7)).repartition(5)
    assert same(S.latest_state(once), S.latest_state(shuffled))


def test_order_of_a_positioned_log_reads_no_content(spark, tmp_path):
    log(spark, [("x", 1, "u", 1, 0, "2024-01-01")]).write.parquet(str(tmp_path / "log"))
    plan = S.latest_state(spark.read.parquet(str(tmp_path / "log"))).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,cdc_op:string,_source_ts_ms:bigint,_offset:bigint>" in plan


def test_ties_without_offset_are_stable(spark):
    rows = log(spark, [("x", i, "u", 1, 0, "2024-01-01") for i in range(20)]).drop("_offset")
    first = S.latest_state(rows).first().amount
    assert all(S.latest_state(rows.repartition(n)).first().amount == first for n in (1, 3, 8))


def test_counts(spark):
    df = log(spark, ROWS)
    assert S.raw_vs_final_counts(df, tie=("_offset",)).first() == (9, 3)
    assert S.multi_version_ids(df).first() == (4, 4)
    # equal versions without an offset: the counts follow the same choice as the state
    tied = log(spark, [(k, i, op, 1, 0, "2024-01-01") for k in "pqrstuvw" for i, op in enumerate("cdudu")]).drop("_offset")
    assert S.raw_vs_final_counts(tied).first() == (40, S.latest_state(tied).count())
    assert S.raw_vs_final_counts(df.limit(0), tie=("_offset",)).first() == (0, 0)


def test_compaction_keeps_the_state(spark):
    df = log(spark, ROWS)
    small = S.compact_log(df, 202402)
    assert small.where("yyyymm = 202401").count() == 2
    assert small.where("yyyymm = 202402").count() == df.where("yyyymm = 202402").count()
    assert same(S.latest_state(df), S.latest_state(small))


def test_compacted_generation_on_disk(spark, tmp_path):
    df = log(spark, ROWS)

    class Table:
        key = ("id",)

    S.rewrite_compacted(df, str(tmp_path / "gen2"), 202403, Table)
    back = spark.read.parquet(str(tmp_path / "gen2"))
    assert same(S.latest_state(df).drop("yyyymm"), S.latest_state(back).drop("yyyymm"))


def test_partial_dedup_happens_before_the_exchange(spark):
    plan = S.latest_state(log(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_reconcile(spark):
    df = log(spark, ROWS)
    state = S.latest_state(df)
    got = S.reconcile_counts({"t": df.select("id").distinct(), "gone": df}, {"t": state})
    assert values(got, "table_name", "source_rows", "state_rows", "matches") == [("gone", 9, 0, False), ("t", 4, 3, False)]
    assert S.reconcile_counts({"t": state}, {"t": state}).first().matches
