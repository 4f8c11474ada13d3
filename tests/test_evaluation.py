"""The labelled set: 60 accounts, 355 transactions, every rule expected to be perfect."""

from __future__ import annotations

from helpers import AS_OF, merchants, txns

from ledgerline.operators import evaluation as V
from ledgerline.operators.rules import all_rule_flags, rule_flagged_accounts
from ledgerline.schemas import RULE_CODES

DAY = 86_400


def labelled_set():
    labels, rows = [], []

    def victim(label, i):
        account = f"{label}-{i}"
        labels.append((account, label))
        return account

    def add(account, n, amount, age=30.0, **more):
        rows.append((f"{account}/{n}", account, amount, age, more))

    for i in range(5):
        a = victim("VELOCITY", i)
        for n in range(15):
            add(a, n, 1_000_000 + 100_000 * n)
        a = victim("ZSCORE", i)
        for n in range(20):
            add(a, n, 105_000 + 1_500 * n, DAY * (5 + n) + 3600.0 * n)
        add(a, 20, 350_000_000, type="transfer")
        a = victim("LARGE_AMT", i)
        add(a, 0, 250_000_000, type="transfer")
        a = victim("HIGH_RISK", i)
        for n in range(4):
            add(a, n, 4_000_000 + n, merchant_id="m9", type="transfer")
        a = victim("MULTI_CCY", i)
        for n, c in enumerate(("VND", "USD", "EUR", "JPY", "THB")):
            add(a, n, 2_000_000, currency=c)
        a = victim("FAIL_SPIKE", i)
        for n in range(7):
            add(a, n, 100_000, status="failed" if n < 6 else "completed")
    for i in range(30):
        labels.append((f"clean-{i}", None))
        for n in range(3):
            add(f"clean-{i}", n, 60_000 * (n + 1))
    return labels, rows


def test_labelled_evaluation(spark):
    labels, rows = labelled_set()
    assert (len(labels), len(rows)) == (60, 355)
    people = spark.createDataFrame(labels, "account_id string, label string")
    flagged = rule_flagged_accounts(all_rule_flags(txns(spark, rows), merchants(spark), AS_OF), people)
    scores = V.rule_scores(V.rule_confusion(people, flagged))
    got = {r.rule_code: (r.tp, r.fp, r.fn, r.tn, r.f1) for r in scores.collect()}
    assert got == {
        "VELOCITY": (15, 0, 0, 45, 1.0),
        "ZSCORE": (5, 0, 0, 55, 1.0),
        "LARGE_AMT": (10, 0, 0, 50, 1.0),
        "HIGH_RISK": (5, 0, 0, 55, 1.0),
        "MULTI_CCY": (5, 0, 0, 55, 1.0),
        "FAIL_SPIKE": (5, 0, 0, 55, 1.0),
    }
    assert V.rule_macro_f1(scores).first() == (1.0, 6)
    assert V.rules_firing(flagged, RULE_CODES).where("fires").count() == 6


def test_undefined_scores(spark):
    people = spark.createDataFrame([("a", "ZSCORE"), ("b", None)], "account_id string, label string")
    flagged = spark.createDataFrame([("VELOCITY", "b")], "rule_code string, account_id string")
    scores = {r.rule_code: r for r in V.rule_scores(V.rule_confusion(people, flagged)).collect()}
    assert scores["ZSCORE"].precision is None and scores["ZSCORE"].recall == 0.0 and scores["ZSCORE"].f1 is None
    assert scores["VELOCITY"].precision == 0.0 and scores["VELOCITY"].f1 is None
    assert scores["HIGH_RISK"].recall is None
    firing = V.rules_firing(flagged, RULE_CODES)
    assert firing.where("fires").count() == 1 and firing.count() == 6
