"""The fused pass: equal to the single rules, planned over one scan, and replaced by single rules where one cannot run."""

from __future__ import annotations

import re

from helpers import AS_OF, hot, merchants, txns, values
from pyspark.sql import functions as F

from ledgerline.operators.alerts import rules_all
from ledgerline.operators.fused import fused_payloads, recent_state, tick_facts
from ledgerline.operators.rules import all_rule_flags
from ledgerline.params import FailSpike, HighRisk, LargeAmount, MultiCurrency, RuleSet, Velocity, ZScore
from ledgerline.schemas import FRAUD_ALERTS, TRANSACTIONS
from ledgerline.sources.logs import append_versions, read_log
from ledgerline.streaming.detect import stream_detect

COLUMNS = ("rule_code", "account_id", "txn_count", "total_amount", "severity", "evidence", "position", "txn_id")


def rows_of(payloads):
    return sorted(map(repr, payloads.select(*COLUMNS).collect()))


def mixed(spark):
    rows = [(f"v{i}", "v", 1 + i, i, {"type": "transfer" if i % 3 else "refund", "status": "pending"}) for i in range(14)]
    rows += [(f"m{c}", "m", 1, 599, {"currency": c}) for c in ("VND", "USD", "EUR", None)]
    rows += [(f"f{i}", "f", 1, 1799, {"status": "failed"}) for i in range(3)] + [("f9", "f", 1, 1801)]
    rows += [(f"z{i}", "z", 10 + i % 2, 86_400 * 20 + i) for i in range(30)] + [("zz", "z", 900, 5), ("zy", "z", 901, 700)]
    rows += [("l1", "l", 100_000_001, 3600), ("l2", "l", 600_000_000, 3601), ("l3", "l", 600_000_000, -5), ("l4", None, 600_000_000, 9)]
    rows += [("h1", "h", 5, 3599, {"merchant_id": "m9"}), ("h2", "h", 7, 10, {"merchant_id": "m9"}), ("h3", "h", 5, 10, {"merchant_id": None})]
    return txns(spark, rows)


def test_fused_pass_equals_the_single_rules(spark):
    wide = RuleSet(
        Velocity(86_400 * 40, 5, 100), ZScore(86_400, 86_400 * 9, 2, 1.0), LargeAmount(86_400 * 50, 900), HighRisk(20), MultiCurrency(60, 1), FailSpike(7200, 2, 20.0)
    )
    for rules in (RuleSet(), wide):
        for upper in (True, False):
            t = mixed(spark)
            want = rules_all(all_rule_flags(t, merchants(spark), AS_OF, rules, upper), rules)
            got = fused_payloads(t, merchants(spark), AS_OF, rules, upper)
            assert rows_of(got) == rows_of(want) and not want.isEmpty()
    t = hot(spark, 20_000)
    rules = RuleSet(zscore=ZScore(max_abs_z=1.0))
    assert rows_of(fused_payloads(t, merchants(spark), AS_OF, rules)) == rows_of(rules_all(all_rule_flags(t, merchants(spark), AS_OF, rules), rules))
    assert fused_payloads(t.limit(0), merchants(spark), AS_OF).isEmpty()


def test_one_scan_and_one_choice_of_versions(spark, tmp_path):
    rows = mixed(spark).withColumns({"cdc_op": F.lit("c"), "_source_ts_ms": F.unix_millis("created_at"), "_offset": F.lit(1).cast("long")})
    append_versions(rows, str(tmp_path / "log"), "w", 0)
    facts = tick_facts(recent_state(read_log(spark, str(tmp_path / "log"), TRANSACTIONS), AS_OF), AS_OF)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and len(re.findall(r"\bWindow \[", plan)) == 1
    assert "PartitionFilters: [isnotnull(yyyymm" in plan
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan)[1]
    assert "description" not in scanned and "ip_address" not in scanned


def test_detection_stream_goes_on_without_a_rule_that_fails(spark, tmp_path):
    t = txns(spark, [("1", "a", 200_000_000, 5), ("2", "b", 1, 5, {"merchant_id": "m9"})])
    t.write.parquet(str(tmp_path / "arrivals"))
    broken = merchants(spark).withColumn("id", F.expr("IF(name > '', CAST(raise_error(concat('unavailable: ', name)) AS STRING), id)"))
    people = spark.createDataFrame([("a",), ("b",)], "id string")
    log = str(tmp_path / "alerts")
    seen = []

    def run(risky, checkpoint):
        arrivals = spark.readStream.schema(t.schema).parquet(str(tmp_path / "arrivals"))
        load = lambda: (t, risky, people, read_log(spark, log, FRAUD_ALERTS))
        query = stream_detect(arrivals, load, log, str(tmp_path / checkpoint), trigger=None, on_error=lambda *x: seen.append(x[:2]))
        query.awaitTermination()

    run(broken, "c1")
    assert seen == [(0, "HIGH_RISK")]
    assert values(read_log(spark, log, FRAUD_ALERTS), "rule_code", "account_id") == [("LARGE_AMT", "a"), ("VELOCITY", "a")]
    run(merchants(spark), "c2")  # once it can run again its cases follow
    assert values(read_log(spark, log, FRAUD_ALERTS), "rule_code", "account_id") == [("HIGH_RISK", "b"), ("LARGE_AMT", "a"), ("VELOCITY", "a")]
    assert len(seen) == 1
