from __future__ import annotations

import json

import pytest
from helpers import AS_OF, merchants, txns, values
from pyspark.sql import functions as F

from ledgerline.operators import alerts as N
from ledgerline.operators import rules as R
from ledgerline.plans.detection import alert_tick, run_alert_tick
from ledgerline.schemas import FRAUD_ALERTS
from ledgerline.sources.logs import alert_sink, read_log

PAYLOAD = (
    "rule_code string, account_id string, txn_count bigint, total_amount decimal(38,2), severity string, "
    "evidence string, position double, txn_id string"
)


def accounts(spark, *ids):
    return spark.createDataFrame([(i, f"Name {i}") for i in ids], "id string, full_name string")


def cases(spark, rows):
    """Cases of (id, account, rule, severity, seconds before AS_OF)."""
    raw = spark.createDataFrame(rows, "id string, account_id string, rule_code string, severity string, age int")
    return raw.selectExpr(
        "id", "account_id", "rule_code", "severity", "1 AS txn_count", "CAST(10 AS DECIMAL(18,2)) AS total_amount", "'{}' AS evidence",
        "'open' AS status", f"TIMESTAMP '{AS_OF}' - make_dt_interval(0, 0, 0, age) AS created_at", "CAST(NULL AS TIMESTAMP) AS resolved_at",
    )


def test_severity_boundaries(spark):
    t = txns(spark, [(1, "a", "500000000.00", 5), (2, "b", "500000000.01", 5)])
    got = N.alert_payload("LARGE_AMT", R.rule_large_amount(t, AS_OF))
    assert values(got, "account_id", "severity") == [("a", "high"), ("b", "critical")]
    z = spark.createDataFrame([(5.0,), (5.01,), (-6.0,)], "z_score double").selectExpr("z_score", f"{N.classify_severity('ZSCORE')} AS s")
    assert [r.s for r in z.collect()] == ["high", "critical", "critical"]


def test_aggregation_keeps_first_evidence_and_counts_matches(spark):
    rows = [
        ("LARGE_AMT", "a", 1, "5", "high", '{"n":1}', -5.0, "t1"),
        ("LARGE_AMT", "a", 1, "9", "critical", '{"n":2}', -9.0, "t2"),
        ("LARGE_AMT", "b", 1, "7", "high", '{"n":3}', -7.0, "t3"),
        ("LARGE_AMT", None, 1, "7", "high", "{}", 0.0, "t4"),
        ("LARGE_AMT", "", 1, "7", "high", "{}", 0.0, "t5"),
    ]
    raw = spark.createDataFrame(rows, PAYLOAD.replace("decimal(38,2)", "string"))
    got = {r.account_id: r for r in N.aggregate_alerts(raw.withColumn("total_amount", F.col("total_amount").cast("decimal(38,2)"))).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].txn_count, float(got["a"].total_amount), got["a"].severity) == (2, 14.0, "critical")
    assert json.loads(got["a"].evidence) == {"n": 2, "matches": 2}
    assert json.loads(got["b"].evidence) == {"n": 3}


def test_dedup_windows_per_rule(spark):
    alerts = cases(spark, [("1", "a", "VELOCITY", "high", 299), ("2", "b", "VELOCITY", "high", 300), ("3", "c", "LARGE_AMT", "high", 3599), ("4", "a", "NEW_RULE", "high", 3599)])
    wanted = [("a", "VELOCITY"), ("b", "VELOCITY"), ("c", "LARGE_AMT"), ("c", "ZSCORE"), ("a", "NEW_RULE")]
    candidates = spark.createDataFrame(wanted, "account_id string, rule_code string")
    assert values(N.dedup_alerts(candidates, alerts, AS_OF), "account_id", "rule_code") == [("b", "VELOCITY"), ("c", "ZSCORE")]
    assert N.dedup_alerts(candidates, alerts, AS_OF, override_s=1).count() == 5
    assert values(N.dedup_alerts(candidates, alerts, AS_OF, override_s=4000), "rule_code") == [("ZSCORE",)]


def test_tick_outcomes_and_repeat(spark, tmp_path):
    rows = [("1", "known", 200_000_000, 5), ("2", "orphan", 200_000_000, 5)]
    t = txns(spark, rows)
    path = str(tmp_path / "alerts")

    def report():
        log = read_log(spark, path, FRAUD_ALERTS)
        return run_alert_tick(
            t, merchants(spark), accounts(spark, "known"), log, AS_OF, lambda c, code: alert_sink(c, path, code, 0)
        )

    first = {r["rule_code"]: r for r in report()}
    assert first["LARGE_AMT"] == {"rule_code": "LARGE_AMT", "new": 1, "dedup": 0, "skipped": 1}
    assert first["FAIL_SPIKE"]["new"] == 0
    stored = read_log(spark, path, FRAUD_ALERTS)
    assert values(stored, "account_id", "rule_code", "status") == [("known", "LARGE_AMT", "open"), ("known", "VELOCITY", "open")]
    again = N.outcome_summary(alert_tick(t, merchants(spark), accounts(spark, "known"), stored, AS_OF))
    assert values(again, "rule_code", "new", "dedup", "skipped") == [("LARGE_AMT", 0, 1, 1), ("VELOCITY", 0, 1, 1)]


def test_failing_rule_does_not_stop_the_others(spark):
    t = txns(spark, [("1", "a", 200_000_000, 5)])
    broken = merchants(spark).withColumn("id", F.expr("IF(name > '', CAST(raise_error(concat('unavailable: ', name)) AS STRING), id)"))
    seen = []
    log = cases(spark, [("0", "z", "ZSCORE", "high", 1)])
    report = {
        r["rule_code"]: r
        for r in run_alert_tick(t, broken, accounts(spark, "a"), log, AS_OF, lambda c, code: seen.append((code, c.count())))
    }
    assert "error" in report["HIGH_RISK"]
    assert report["LARGE_AMT"]["new"] == 1 and ("LARGE_AMT", 1) in seen


def test_case_ids_repeat_for_a_repeated_pass(spark):
    t = txns(spark, [("1", "a", 200_000_000, 5)])
    none = cases(spark, [("0", "z", "ZSCORE", "high", 1)])
    ids = [values(N.new_cases(alert_tick(t, merchants(spark), accounts(spark, "a"), none, AS_OF), AS_OF), "id") for _ in range(2)]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_list_groups_and_buckets(spark):
    alerts = cases(spark, [("1", "a", "ZSCORE", "high", 50), ("2", "a", "ZSCORE", "critical", 40), ("3", "b", "VELOCITY", "high", 10), ("4", "a", "VELOCITY", "medium", 60)])
    with pytest.raises(ValueError, match="limit"):
        N.alert_list(alerts, accounts(spark, "a"), limit=0)
    assert values(N.alert_list(alerts, accounts(spark, "a"), limit=1), "id", "account_name") == [("3", None)]
    listed = N.alert_list(alerts, accounts(spark, "a"), limit=None)
    newest = N.alert_groups(listed, firings=1).collect()
    assert [(g.account_id, g.total_firings, [f.id for f in g.firings]) for g in newest] == [("b", 1, ["3"]), ("a", 3, ["2"])]
    groups = N.alert_groups(listed).collect()
    assert [(g.account_id, g.total_firings, [f.id for f in g.firings]) for g in groups] == [("b", 1, ["3"]), ("a", 3, ["2", "1", "4"])]
    buckets = [tuple(r) for r in N.alert_rule_buckets(listed).collect()]
    assert buckets == [("a", "ZSCORE", "critical", 2), ("a", "VELOCITY", "medium", 1), ("b", "VELOCITY", "high", 1)]
    assert values(N.alert_account_totals(listed), "account_id", "max_severity", "open_count") == [("a", "critical", 3), ("b", "high", 1)]
    with pytest.raises(ValueError, match="invalid rule"):
        N.alert_list(alerts, accounts(spark, "a"), rule="R9")
    with pytest.raises(ValueError, match="invalid severity"):
        N.alert_list(alerts, accounts(spark, "a"), severity="huge")


def test_evidence_text(spark):
    rows = [
        ("VELOCITY", '{"window_seconds":9,"txn_types":["purchase","transfer"]}', "window 9s · types [purchase, transfer]"),
        ("VELOCITY", '{"window_seconds":9,"txn_types":[{"value":"purchase","n":2}]}', "window 9s · types [purchase, purchase]"),
        ("ZSCORE", '{"z_score":-4.5,"avg_amount":1234567.891,"std_amount":0,"txn_count_30d":31}', "z=-4.5 · avg 1,234,567.89 · std 0 · n=31"),
        ("LARGE_AMT", '{"txn_id":"0123456789","currency":"VND","type":"transfer"}', "txn 01234567… · VND · transfer"),
        ("HIGH_RISK", "{}", "merchant ? · risk ? · "),
        ("MULTI_CCY", '{"currencies":["EUR","USD"],"currency_count":2}', "2 currencies: [EUR, USD]"),
        ("FAIL_SPIKE", '{"failed_count":3,"total_count":4,"fail_rate_pct":75.0}', "3/4 failed · rate 75%"),
        ("OTHER", "{}", "{}"),
        ("ZSCORE", "x" * 130, "x" * 120 + "…"),
        ("ZSCORE", "", None),
    ]
    df = spark.createDataFrame([(i, r, e) for i, (r, e, _) in enumerate(rows)], "i int, rule_code string, evidence string")
    got = {r.i: r.evidence_text for r in N.alert_evidence_text(df).collect()}
    assert got == {i: text for i, (_, _, text) in enumerate(rows)}


def test_case_status(spark):
    alerts = cases(spark, [("1", "a", "ZSCORE", "high", 50), ("2", "a", "ZSCORE", "high", 50), ("3", "a", "ZSCORE", "high", 50)])
    moves = spark.createDataFrame(
        [("1", "closed_fraud", "2024-05-02"), ("1", "open", "2024-05-03"), ("2", "closed_clean", "2024-05-02"), ("2", "lost", "2024-05-09")],
        "alert_id string, status string, day string",
    ).selectExpr("alert_id", "status", "CAST(day AS TIMESTAMP) AS at")
    got = N.case_status(alerts, moves).select("id", "status", F.col("resolved_at").cast("string").alias("r"))
    assert values(got.na.fill("-"), "id", "status", "r") == [("1", "open", "-"), ("2", "closed_clean", "2024-05-02 00:00:00"), ("3", "open", "-")]
