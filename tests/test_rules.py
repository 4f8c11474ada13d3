from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import AS_OF, hot, merchants, txns, values

from ledgerline.functions.skew import heavy_keys, salted_join
from ledgerline.functions.values import counts_text, spelled_out
from ledgerline.operators import rule_views as V
from ledgerline.operators import rules as R
from ledgerline.operators.state import latest_state
from ledgerline.params import FailSpike, MultiCurrency, RuleSet, Velocity, ZScore


def test_velocity_count_boundary(spark):
    rows = [(f"x{i}", "ten", 1, i) for i in range(10)] + [(f"y{i}", "eleven", 1, i) for i in range(11)]
    assert values(R.rule_velocity(txns(spark, rows), AS_OF), "account_id", "txn_count") == [("eleven", 11)]


def test_velocity_amount_boundary(spark):
    rows = [(1, "at", "50000000.00", 5), (2, "over", "50000000.01", 5)]
    assert values(R.rule_velocity(txns(spark, rows), AS_OF), "account_id") == [("over",)]


def test_velocity_window_and_upper_bound(spark):
    rows = [(1, "edge", 60_000_000, 300), (2, "old", 60_000_000, 300.001), (3, "future", 60_000_000, -1)]
    t = txns(spark, rows)
    assert values(R.rule_velocity(t, AS_OF), "account_id") == [("edge",)]
    assert values(R.rule_velocity(t, AS_OF, upper_bound=False), "account_id") == [("edge",), ("future",)]


def test_velocity_counted_lists_stand_for_every_transaction(spark):
    kinds = ["purchase"] * 8 + ["transfer"] * 4
    rows = [(i, "a", 1, i, {"type": k, "status": "failed" if i < 2 else "completed"}) for i, k in enumerate(kinds)]
    flagged = R.rule_velocity(txns(spark, rows), AS_OF)
    row = flagged.select(
        counts_text(flagged.txn_types).alias("t"), counts_text(flagged.txn_statuses).alias("s"), spelled_out(flagged.txn_types).alias("l")
    ).first()
    assert (row.t, row.s) == ("purchase=8,transfer=4", "completed=10,failed=2")
    assert row.l == sorted(kinds)


def zscore_case(n, outlier):
    return [(f"b{i}", "a", 100 + i % 3, 86_400 * 5 + i) for i in range(n)] + [("out", "a", outlier, 10)]


def test_zscore_flags_outlier_only(spark):
    got = R.rule_zscore(txns(spark, zscore_case(20, 5000)), AS_OF).collect()
    assert [r.id for r in got] == ["out"]
    assert got[0].txn_count_30d == 21 and got[0].z_score == pytest.approx(4.47, abs=0.01)


def test_zscore_needs_history_and_spread(spark):
    flat = [(f"f{i}", "flat", 100, 100 + i) for i in range(30)]
    few = [(f"s{i}", "few", 10, 86_400 + i) for i in range(3)] + [("s", "few", 10_000, 5)]
    assert R.rule_zscore(txns(spark, flat + few), AS_OF).count() == 0
    params = ZScore(min_history=4, max_abs_z=1.7)
    assert values(R.rule_zscore(txns(spark, flat + few), AS_OF, params), "id") == [("s",)]


def test_zscore_at_most_ten_rows_never_fires(spark):
    assert R.rule_zscore(txns(spark, zscore_case(9, 10_000_000)), AS_OF).count() == 0


def test_large_amount_boundary(spark):
    rows = [(1, "a", "100000000.00", 5), (2, "a", "100000000.01", 5), (3, "a", "200000000", 3601)]
    assert values(R.rule_large_amount(txns(spark, rows), AS_OF), "id", "amount") == [("2", Decimal("100000000.01"))]


def test_high_risk_join(spark):
    rows = [(1, "a", 5, 5, {"merchant_id": "m9"}), (2, "a", 5, 5), (3, "a", 5, 5, {"merchant_id": None}), (4, "a", 5, 5, {"merchant_id": "?"})]
    assert values(R.rule_high_risk(txns(spark, rows), merchants(spark), AS_OF), "id", "merchant_name") == [("1", "Night Casino")]


def test_deleted_merchant_still_taints(spark):
    log = merchants(spark).selectExpr("*", "IF(id = 'm9', 'd', 'c') AS cdc_op", "1L AS _source_ts_ms")
    t = txns(spark, [(1, "a", 5, 5, {"merchant_id": "m9"})])
    assert R.rule_high_risk(t, latest_state(log), AS_OF).count() == 0
    assert R.rule_high_risk(t, latest_state(log, keep_deleted=True), AS_OF).count() == 1


def test_multi_currency_boundary(spark):
    rows = [(f"{a}{c}", a, 1, 9, {"currency": c}) for a, n in (("two", 2), ("three", 3)) for c in ("VND", "USD", "EUR")[:n]]
    got = R.rule_multi_currency(txns(spark, rows), AS_OF).collect()
    assert [(r.account_id, r.currencies, r.currency_count) for r in got] == [("three", ["EUR", "USD", "VND"], 3)]


def test_fail_spike_rounds_before_comparing(spark):
    def account(name, failed, ok):
        return [(f"{name}{i}", name, 1, 9, {"status": "failed" if i < failed else "completed"}) for i in range(failed + ok)]

    # half exactly; 50.04 % reads as 50.0; 50.06 % reads as 50.1
    rows = account("half", 3, 3) + account("under", 1001, 1000) + account("over", 801, 799) + account("two", 2, 0)
    got = values(R.rule_fail_spike(txns(spark, rows), AS_OF), "account_id", "fail_rate_pct")
    assert got == [("over", 50.1)]
    feed = V.feed_branches(txns(spark, rows), merchants(spark), AS_OF)["FAIL_SPIKE"]
    assert values(feed, "subject") == [("over",), ("under",)]  # the feed compares the unrounded rate


SCENARIOS = {
    "VELOCITY": [(f"v{i}", "v", 1_000_000 + i, i) for i in range(25)],
    "ZSCORE": [(f"z{i}", "z", 100_000 + 5000 * i, 86_400 * 10 + i) for i in range(20)] + [("z", "z", 300_000_000, 5, {"type": "transfer"})],
    "LARGE_AMT": [("l", "l", 150_000_000, 5, {"type": "transfer"})],
    "HIGH_RISK": [("h", "h", 5_000_000, 5, {"merchant_id": "m9"})],
    "MULTI_CCY": [(f"m{c}", "m", 1_000_000, 5, {"currency": c}) for c in ("VND", "USD", "EUR", "JPY")],
    "FAIL_SPIKE": [(f"f{i}", "f", 500_000, 5, {"status": "failed" if i < 5 else "completed"}) for i in range(7)],
}


def test_scenarios_flag_their_victims(spark):
    t = txns(spark, [row for rows in SCENARIOS.values() for row in rows])
    flags = R.all_rule_flags(t, merchants(spark), AS_OF)
    pairs = set(values(R.rule_flagged_accounts(flags), "rule_code", "account_id"))
    for code, rows in SCENARIOS.items():
        assert (code, rows[0][1]) in pairs
    # all rules together agree with each on its own
    for code, rows in flags.items():
        alone = R.rule_flags(code, t, merchants(spark), AS_OF)
        assert values(rows, "account_id") == values(alone, "account_id")


def test_rules_agree_when_one_account_holds_a_third(spark):
    t = hot(spark, 6000)
    rules = RuleSet(velocity=Velocity(window_s=600, max_count=100), multi_currency=MultiCurrency(), fail_spike=FailSpike())
    got = R.rule_velocity(t, AS_OF, rules.velocity).collect()
    assert got[0].account_id == "hot" and got[0].txn_count == 2000
    assert sum(c.n for c in got[0].txn_types) == 2000


def test_salted_join_equals_plain_join(spark):
    facts = hot(spark, 5000).select("id", "account_id")
    lookup = facts.select("account_id").distinct().selectExpr("account_id", "upper(account_id) AS name").where("account_id <> 'a5'")
    assert values(heavy_keys(facts, "account_id", min_rows=1000), "account_id") == [("hot",)]
    for how in ("inner", "left"):
        salted = salted_join(facts, lookup, "account_id", "id", how, min_rows=1000)
        plain = facts.join(lookup, "account_id", how)
        assert values(salted.na.fill("-"), "id", "account_id", "name") == values(plain.na.fill("-"), "id", "account_id", "name")
    hot_rows = salted_join(facts, lookup, "account_id", "id", min_rows=1000).where("account_id = 'hot'")
    assert hot_rows.count() == facts.where("account_id = 'hot'").count()


def test_salted_join_spreads_rows_without_a_key(spark):
    facts = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, NULL, CAST(id % 50 AS STRING)) AS account_id")
    lookup = spark.range(50).selectExpr("CAST(id AS STRING) AS account_id", "id AS n")
    joined = salted_join(facts, lookup, "account_id", "id", "left")
    assert joined.count() == 30_000 and joined.where("n IS NULL").count() == 10_000
    counted = facts.groupBy("account_id").count().withColumnRenamed("count", "_n").where("account_id IS NOT NULL")
    assert values(salted_join(facts, lookup, "account_id", "id", counts=counted, min_rows=100), "id") == values(
        facts.join(lookup, "account_id"), "id"
    )


def test_history_counts_and_clamp(spark):
    rows = [(1, "a", 60_000_000, 30), (2, "a", 150_000_000, 30, {"merchant_id": "m9", "status": "failed"}), (3, "a", 1, 90 * 60)]
    h = V.rule_history(txns(spark, rows), merchants(spark), AS_OF, minutes=30)
    assert values(h, "rule_id", "flags") == [("R1", 2), ("R2", 2), ("R3", 1), ("R4", 1), ("R5", 2), ("R6", 1)]
    far = V.rule_history(txns(spark, [(1, "a", 1, 7 * 3600)]), merchants(spark), AS_OF, minutes=10_000)
    assert far.count() == 0  # the span is limited to six hours


def test_view_counts_include_empty_rules(spark):
    views = V.rule_views(txns(spark, SCENARIOS["LARGE_AMT"]), merchants(spark), AS_OF)
    assert dict(values(V.rule_view_counts(views), "rule_id", "flagged")) == {"R1": 1, "R2": 0, "R3": 1, "R4": 0, "R5": 0, "R6": 0}


def test_feed_text_and_limit(spark):
    t = txns(spark, [(f"l{i}", f"a{i}", 150_500_000, i / 10) for i in range(60)])
    feed = V.alert_feed(t, merchants(spark), AS_OF).collect()
    assert len(feed) == 50
    assert {r.message for r in feed if r.rule == "LARGE_AMT"} == {"Single txn 150.5M VND"}
    assert {r.message for r in feed if r.rule == "VELOCITY"} == {"1 txns, 150.5M VND in 5 min"}
