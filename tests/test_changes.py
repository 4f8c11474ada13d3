from __future__ import annotations

import json
from decimal import Decimal

from helpers import values
from pyspark.sql import functions as F

from ledgerline.operators import typing as Y
from ledgerline.schemas import ACCOUNTS, FRAUD_ALERTS, TRANSACTIONS
from ledgerline.sources import changes as C

WIRE = {
    "id": "t1", "account_id": "a1", "merchant_id": "m1", "amount": "99.00", "currency": "VND", "type": "purchase",
    "status": "completed", "description": "x", "metadata": "{}", "ip_address": None, "device_id": None,
    "created_at": "2026-04-21T12:41:43.983702Z", "updated_at": "2026-04-21T12:41:43.983702Z", "__deleted": "false",
    "__op": "c", "__table": "transactions", "__source_ts_ms": 1776775303983,
}


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def wire(**changes):
    return json.dumps({**WIRE, **changes})


def typed(spark, *texts, **kw):
    good, _ = C.split_corrupt(C.parse_flat(messages(spark, *texts), TRANSACTIONS))
    return Y.type_transactions(good, **kw)


def test_typing(spark):
    row = typed(spark, wire()).select("*", F.col("created_at").cast("string").alias("t")).first()
    assert row.amount == Decimal("99.00") and row.t == "2026-04-21 12:41:43.983702"
    assert row.cdc_op == "c" and row._source_ts_ms == 1776775303983
    assert "metadata" not in row.asDict()


def test_times_fall_back_to_the_commit_time(spark):
    rows = typed(spark, wire(created_at=""), wire(created_at=None), wire(created_at="1776775303983"))
    assert {str(r[0]) for r in rows.select(F.col("created_at").cast("string")).collect()} == {"2026-04-21 12:41:43.983"}
    forms = typed(spark, wire(created_at="1706659200"), wire(created_at="2024/01/31 00:00:00"))
    assert {str(r[0]) for r in forms.select(F.col("created_at").cast("string")).collect()} == {"2024-01-31 00:00:00"}
    lost = Y.check_domains(typed(spark, wire(created_at="soon")), TRANSACTIONS).first()
    assert lost["created_at"] is None and "created_at_null" in lost["violations"]
    cut = typed(spark, wire(), truncate_seconds=True).select(F.col("created_at").cast("string")).first()[0]
    assert cut == "2026-04-21 12:41:43"


def test_unreadable_amounts_become_null(spark):
    assert values(typed(spark, wire(amount=None, __op="d"), wire(amount="lots")), "amount") == [(None,), (None,)]


def test_unknown_fields_and_broken_messages(spark):
    records = messages(spark, wire(promo_code="X"), "{bad", None, "")
    good, dead = C.split_corrupt(C.parse_flat(records, TRANSACTIONS))
    assert good.count() == 1 and "promo_code" not in good.columns
    assert {r[0] for r in dead.collect()} == {"{bad", C.EMPTY}
    assert C.drop_unknown_fields(records, TRANSACTIONS).columns == good.columns


def test_messages_are_parsed_once(spark):
    good, _ = C.split_corrupt(C.parse_flat(messages(spark, wire()), TRANSACTIONS))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_envelopes(spark):
    before, after = {"id": "t1", "amount": "1.00"}, {"id": "t1", "amount": "2.00"}
    source = {"table": "transactions", "ts_ms": 5}
    bodies = [
        {"before": None, "after": before, "source": source, "op": "c"},
        {"before": before, "after": after, "source": source, "op": "u"},
        {"before": after, "after": None, "source": source, "op": "d"},
    ]
    texts = [json.dumps({"payload": b}) for b in bodies] + [json.dumps(bodies[2]), None, "{bad"]
    flat = C.unwrap_envelope(messages(spark, *texts), TRANSACTIONS)
    good, dead = C.split_corrupt(flat)
    assert values(good, "__op", "amount", "__deleted", "__source_ts_ms") == [
        ("c", "1.00", "false", 5), ("d", "2.00", "true", 5), ("d", "2.00", "true", 5), ("u", "2.00", "false", 5),
    ]
    assert dead.count() == 1


def test_snapshot_then_changes(spark):
    base = spark.createDataFrame([("a", 1)], "id string, v int")
    log = spark.createDataFrame([("a", 2, "u", 9, 4)], "id string, v int, cdc_op string, _source_ts_ms bigint, _offset bigint")
    assert values(C.snapshot_as_log(base, log, 5), "v", "cdc_op", "_source_ts_ms") == [(1, "r", 5), (2, "u", 9)]


def test_checks(spark):
    rows = typed(spark, wire(), wire(id="t2", type="theft", status="lost"), wire(id="t3", currency=None, amount="?"))
    got = dict(Y.check_domains(rows, TRANSACTIONS).select("id", "violations").collect())
    assert got == {"t1": [], "t2": ["type_domain", "status_domain"], "t3": ["amount_null", "currency_null"]}
    good, bad = Y.split_checked(rows, TRANSACTIONS)
    assert (good.count(), bad.count()) == (1, 2)


def test_defaults_email_and_parents(spark):
    accounts = spark.createDataFrame([("1", "a@x", None, None), ("2", "a@x", None, "closed")], "id string, email string, balance decimal(18,2), status string")
    filled = Y.apply_defaults(accounts, ACCOUNTS)
    assert values(filled, "id", "balance", "status") == [("1", Decimal("0.00"), "active"), ("2", Decimal("0.00"), "closed")]
    assert values(Y.check_unique_email(accounts), "email", "uses") == [("a@x", 2)]
    children = spark.createDataFrame([("1",), ("7",), ("7",), (None,)], "account_id string")
    named = children.selectExpr("uuid() AS id", "account_id")
    assert values(Y.orphan_rows(named, accounts, "account_id"), "account_id") == [("7",), ("7",)]
    assert values(Y.check_foreign_keys(children, accounts, "account_id"), "account_id", "rows") == [("7", 2)]


def test_alert_typing(spark):
    flat = spark.createDataFrame(
        [("1", "5", "2024-01-01T00:00:00Z"), ("2", "x", "")], "id string, txn_count string, resolved_at string"
    ).selectExpr(
        "*", "'a' AS account_id", "'ZSCORE' AS rule_code", "'high' AS severity", "'1.5' AS total_amount", "'{}' AS evidence",
        "'open' AS status", "'' AS notes", "'' AS created_at", "'c' AS __op", "1000L AS __source_ts_ms",
    )
    rows = {r.id: r for r in Y.type_rows(flat, FRAUD_ALERTS).collect()}
    assert rows["1"].txn_count == 5 and rows["2"].txn_count is None
    assert rows["1"].resolved_at is not None and rows["2"].resolved_at is None


def test_update_time(spark):
    log = spark.createDataFrame([("u", 1000), ("c", 1000)], "cdc_op string, _source_ts_ms bigint").selectExpr("*", "TIMESTAMP '2000-01-01' AS updated_at")
    got = Y.touch_updated_at(log).select("cdc_op", F.col("updated_at").cast("string").alias("t"))
    assert values(got, "cdc_op", "t") == [("c", "2000-01-01 00:00:00"), ("u", "1970-01-01 00:00:01")]
