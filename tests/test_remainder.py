"""Undeclared fields kept and promoted; pages and newest rows from the stored log."""

from __future__ import annotations

import json
from dataclasses import replace

from helpers import txns, values
from pyspark.sql import functions as F

from ledgerline.operators.lookups import live_from_log, since_from_log, transactions_since
from ledgerline.operators.state import latest_state
from ledgerline.operators.typing import promote, type_rows
from ledgerline.schemas import AMOUNT, STAMP, TEXT, TRANSACTIONS, WHOLE
from ledgerline.sources.changes import parse_flat, split_corrupt
from ledgerline.sources.logs import append_versions, read_log


def message(tid, **more):
    return json.dumps({"id": tid, "account_id": "a", "amount": "5", "created_at": "2024-01-15T10:00:00Z", "__op": "c", "__source_ts_ms": 10, **more})


def test_undeclared_fields_are_readable_for_old_rows_after_promotion(spark, tmp_path):
    path = str(tmp_path / "log")

    def store(batch, *lines, table=TRANSACTIONS):
        good, _ = split_corrupt(parse_flat(spark.createDataFrame([(x,) for x in lines], "value string"), table, remainder=True))
        append_versions(type_rows(good, table), path, "w", batch)

    store(0, message("1"), message("2", tier="gold", points="12", fee="1.50", seen="2024-01-16T00:00:00Z"), message("3", tier={"deep": [1]}, points=7), "{bad", "[1]", '"x"')
    newer = replace(TRANSACTIONS, columns={**TRANSACTIONS.columns, "tier": TEXT, "points": WHOLE, "fee": AMOUNT, "seen": STAMP})
    store(1, message("4", tier="iron", points="x", other=True), message("5", tier=None), table=newer)
    log = read_log(spark, path, newer, remainder=True)
    got = {r["id"]: (r["tier"], r["points"], str(r["fee"]), r["seen"] and str(r["seen"])[:10], r["rest"]) for r in promote(latest_state(log), newer).withColumn("rest", F.to_json("_rest")).collect()}
    assert got["1"] == (None, None, "None", None, None)
    assert got["2"][:4] == ("gold", 12, "1.50", "2024-01-16")
    assert got["3"][1] == 7 and json.loads(got["3"][4]) == {"tier": {"deep": [1]}, "points": 7}
    assert got["4"][:2] == ("iron", None) and json.loads(got["4"][4]) == {"other": True}
    assert got["5"][0] is None and len(got) == 5
    assert read_log(spark, path, TRANSACTIONS).count() == 5  # readers of the old declaration go on


def versions(spark):
    rows = [(str(i), "a", 10 + i, 86_400 * i) for i in range(40)]
    first = txns(spark, rows).withColumns({"cdc_op": F.lit("c"), "_source_ts_ms": F.unix_millis("created_at"), "_offset": F.col("id").cast("long")})
    later = first.where("CAST(id AS INT) % 4 = 0").withColumns({"amount": F.lit(1).cast("decimal(18,2)"), "_source_ts_ms": F.col("_source_ts_ms") + 10**9, "cdc_op": F.lit("u")})
    gone = first.where("CAST(id AS INT) % 4 = 1").withColumns({"_source_ts_ms": F.col("_source_ts_ms") + 10**9, "cdc_op": F.lit("d")})
    return first.unionByName(later).unionByName(gone)


def test_pages_and_newest_rows_from_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    append_versions(versions(spark), path, "w", 0)
    log = read_log(spark, path, TRANSACTIONS)
    state = latest_state(log)
    at = state.agg(F.expr("percentile_approx(_source_ts_ms, 0.5)")).first()[0]
    for cursor in (None, str(at), f"{at}:20"):
        assert since_from_log(log, cursor, 7).collect() == transactions_since(state, cursor, 7).collect()
    plan = since_from_log(log, str(at))._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(_source_ts_ms,{at})" in plan
    people = spark.createDataFrame([("a", "Ann")], "id string, full_name string")
    shops = spark.createDataFrame([("m1", "Shop", "c", "low")], "id string, name string, category string, risk_level string")
    newest = [r["id"] for r in state.orderBy(F.desc("_source_ts_ms"), "id").limit(5).collect()]
    until = state.agg(F.max("_source_ts_ms")).first()[0] + 5
    assert [r[0] for r in values(live_from_log(log, people, shops, until, 5), "id")] == sorted(newest)
    assert live_from_log(log, people, shops, until, 500).count() == state.count()
