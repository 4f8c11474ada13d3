"""Registered queries: alert workflow and rule evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import alerts as N
from ledgerline.operators import evaluation as V
from ledgerline.operators.fused import flagged_accounts
from ledgerline.plans.detection import alert_tick, alert_tick_from_log
from ledgerline.schemas import RULE_CODES
from workload import adapters as A
from workload.adapters import AS_OF, LIVE, RULES, out, with_views
from workload.rule_queries import ALL_FLAGS, FLAGGED, PAYLOADS, T, flags, payloads

RULE_VIEWS = ("txn", "merchants")
RANK = "CASE {0} WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"
NAME = "CASE {0} WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END"

CASES = f"""cases AS (
  SELECT rule_code, account_id, CAST(sum(txn_count) AS BIGINT) AS txn_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
    {NAME.format('max(' + RANK.format('severity') + ')')} AS severity,
    CASE WHEN count(*) > 1 THEN regexp_replace(arg_min(evidence, {{'p': position, 'i': txn_id}}), '\\}}$', '') || ',"matches":' || count(*) || '}}'
         ELSE min(evidence) END AS evidence
  FROM payloads GROUP BY rule_code, account_id)"""
WINDOW_S = (
    "CASE rule_code WHEN 'VELOCITY' THEN 300 WHEN 'ZSCORE' THEN 600 WHEN 'LARGE_AMT' THEN 3600 WHEN 'HIGH_RISK' THEN 3600 "
    "WHEN 'MULTI_CCY' THEN 600 WHEN 'FAIL_SPIKE' THEN 1800 ELSE 3600 END"
)
DEDUP_S = 3 * 86400
YOUNG = f"""young AS (
  SELECT DISTINCT account_id, rule_code FROM alerts WHERE created_at > {T} - to_seconds({DEDUP_S}))"""
YOUNG_PER_RULE = f"""young AS (
  SELECT DISTINCT account_id, rule_code FROM alerts WHERE created_at > {T} - to_seconds({WINDOW_S}))"""
OUTCOMES = """SELECT rule_code, count(*) FILTER (WHERE NOT dup AND known) AS new, count(*) FILTER (WHERE dup) AS dedup,
  count(*) FILTER (WHERE NOT dup AND NOT known) AS skipped FROM (
    SELECT c.rule_code, EXISTS (SELECT 1 FROM young y WHERE y.account_id = c.account_id AND y.rule_code = c.rule_code) AS dup,
      c.account_id IN (SELECT id FROM accounts WHERE status = 'active') AS known FROM cases c) GROUP BY rule_code"""
LISTED = """listed AS (
  SELECT l.id, l.account_id, a.full_name AS account_name, rule_code, severity, txn_count, CAST(total_amount AS DOUBLE) AS total_amount,
    evidence, l.status, l.created_at
  FROM (SELECT * FROM alerts) l LEFT JOIN accounts a ON a.id = l.account_id)"""


def cases(s, d):
    return N.aggregate_alerts(payloads(s, d))


def active(s, d):
    return A.accounts(s, d).where(F.col("status") == "active")


def listed(s, d):
    return N.alert_list(A.alerts(s, d), A.accounts(s, d), limit=None)


def tick(s, d):
    decided = alert_tick(
        A.txn(s, d), A.merchants(s, d), active(s, d), A.alerts(s, d), AS_OF, RULES, override_s=DEDUP_S
    )
    return out(N.outcome_summary(decided))


def tick_from_log(s, d):
    decided = alert_tick_from_log(
        A.stored_log(s, d), A.merchants(s, d), active(s, d), A.alerts(s, d), AS_OF, RULES, override_s=DEDUP_S
    )
    return out(N.outcome_summary(decided))


def severity(s, d):
    """Severity of every flagged row, counted per rule."""
    return out(payloads(s, d).groupBy("rule_code", "severity").agg(F.count(F.lit(1)).alias("n")))


def groups(s, d):
    g = N.alert_groups(listed(s, d))
    return out(
        g.select(
            "account_id",
            "account_name",
            "last_seen",
            "total_firings",
            F.array_join(F.transform("firings", lambda f: f["id"]), ",").alias("firing_ids"),
        )
    )


def buckets(s, d):
    per_rule = N.alert_rule_buckets(listed(s, d))
    totals = N.alert_account_totals(listed(s, d))
    return out(per_rule.join(totals, "account_id"))


def transitions(s, d):
    """Status events of the cases: two per case, some with an unknown status."""
    a = A.alerts(s, d)
    k = F.col("id").cast("bigint")
    first = a.select(F.col("id").alias("alert_id"), F.lit("open").alias("status"), F.col("created_at").alias("at"))
    second = a.where(k % 3 != 0).select(
        F.col("id").alias("alert_id"),
        F.when(k % 3 == 1, "closed_fraud").when(k % 5 == 0, "lost").otherwise("closed_clean").alias("status"),
        (F.col("created_at") + F.expr("INTERVAL 1 HOUR")).alias("at"),
    )
    return first.unionByName(second)


def confusion(s, d):
    return V.rule_confusion(A.labelled(s, d), flagged_accounts(payloads(s, d)))


CONFUSION = """labelled AS (SELECT CAST(c_custkey AS VARCHAR) AS account_id, CASE c_custkey % 12 WHEN 0 THEN 'VELOCITY' WHEN 1 THEN 'LARGE_AMT'
    WHEN 2 THEN 'MULTI_CCY' WHEN 3 THEN 'ZSCORE' WHEN 4 THEN 'HIGH_RISK' WHEN 5 THEN 'FAIL_SPIKE' END AS label FROM customer),
mapping(rule_code, label) AS (VALUES ('VELOCITY','VELOCITY'),('VELOCITY','LARGE_AMT'),('VELOCITY','ZSCORE'),('ZSCORE','ZSCORE'),
    ('LARGE_AMT','LARGE_AMT'),('LARGE_AMT','ZSCORE'),('HIGH_RISK','HIGH_RISK'),('MULTI_CCY','MULTI_CCY'),('FAIL_SPIKE','FAIL_SPIKE')),
judged AS (SELECT r.rule_code, l.account_id,
    EXISTS (SELECT 1 FROM mapping m WHERE m.rule_code = r.rule_code AND m.label = l.label) AS positive,
    EXISTS (SELECT 1 FROM flagged f WHERE f.rule_code = r.rule_code AND f.account_id = l.account_id) AS hit
  FROM labelled l, (SELECT DISTINCT rule_code FROM mapping) r),
confusion AS (SELECT rule_code, count(*) FILTER (WHERE hit AND positive) AS tp, count(*) FILTER (WHERE hit AND NOT positive) AS fp,
    count(*) FILTER (WHERE NOT hit AND positive) AS fn, count(*) FILTER (WHERE NOT hit AND NOT positive) AS tn FROM judged GROUP BY rule_code),
scores AS (SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM (
    SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM confusion))"""

EVIDENCE_TEXT = """SELECT id, CASE o_orderkey % 6
  WHEN 0 THEN 'window ' || (o_orderkey % 300) || 's · types [purchase, purchase, transfer]'
  WHEN 1 THEN 'txn ' || CASE WHEN length('txn-000' || o_orderkey) > 8 THEN substr('txn-000' || o_orderkey, 1, 8) || '…' ELSE 'txn-000' || o_orderkey END || ' · VND · transfer'
  WHEN 2 THEN (o_orderkey % 3 + 3) || ' currencies: [EUR, USD, VND]'
  WHEN 3 THEN 'z=' || (o_orderkey % 9 + 3) || '.25 · avg ' || regexp_replace(format('{:,}', o_orderkey), '^$', '0') || '.5 · std 12 · n=31'
  WHEN 4 THEN 'merchant Supplier ' || o_orderkey || ' · risk high · '
  ELSE 'unreadable evidence of case ' || o_orderkey END AS evidence_text FROM alerts"""

QUERIES = {
    "classify_severity": (
        severity,
        with_views("SELECT rule_code, severity, count(*) AS n FROM payloads GROUP BY 1, 2", *RULE_VIEWS, extra=(*ALL_FLAGS, PAYLOADS)),
    ),
    "alert_payload": (
        lambda s, d: out(N.alert_payload("ZSCORE", flags(s, d)["ZSCORE"], RULES).drop("position")),
        with_views(
            "SELECT rule_code, account_id, CAST(txn_count AS BIGINT) AS txn_count, CAST(total_amount AS DOUBLE) AS total_amount, severity, evidence, txn_id "
            "FROM payloads WHERE rule_code = 'ZSCORE'",
            *RULE_VIEWS,
            extra=(*ALL_FLAGS, PAYLOADS),
        ),
    ),
    "aggregate_alerts": (
        lambda s, d: out(cases(s, d)),
        with_views("SELECT * FROM cases", *RULE_VIEWS, extra=(*ALL_FLAGS, PAYLOADS, CASES)),
    ),
    "dedup_alerts": (
        lambda s, d: out(N.dedup_alerts(cases(s, d), A.alerts(s, d), AS_OF)),
        with_views(
            "SELECT c.* FROM cases c ANTI JOIN young y ON y.account_id = c.account_id AND y.rule_code = c.rule_code",
            *RULE_VIEWS,
            "alerts",
            extra=(*ALL_FLAGS, PAYLOADS, CASES, YOUNG_PER_RULE),
        ),
    ),
    "dedup_alerts_override": (
        lambda s, d: out(N.dedup_alerts(cases(s, d), A.alerts(s, d), AS_OF, override_s=DEDUP_S)),
        with_views(
            "SELECT c.* FROM cases c ANTI JOIN young y ON y.account_id = c.account_id AND y.rule_code = c.rule_code",
            *RULE_VIEWS,
            "alerts",
            extra=(*ALL_FLAGS, PAYLOADS, CASES, YOUNG),
        ),
    ),
    "skip_orphan_alerts": (
        lambda s, d: out(N.skip_orphan_alerts(cases(s, d), active(s, d))[1]),
        with_views(
            "SELECT * FROM cases WHERE account_id NOT IN (SELECT id FROM accounts WHERE status = 'active')",
            *RULE_VIEWS,
            "accounts",
            extra=(*ALL_FLAGS, PAYLOADS, CASES),
        ),
    ),
    "alert_tick": (
        tick,
        with_views(OUTCOMES, *RULE_VIEWS, "alerts", "accounts", extra=(*ALL_FLAGS, PAYLOADS, CASES, YOUNG)),
    ),
    "alert_tick_from_log": (
        tick_from_log,
        with_views(OUTCOMES, "merchants", "alerts", "accounts", extra=(LIVE, *ALL_FLAGS, PAYLOADS, CASES, YOUNG)),
    ),
    "alert_list": (
        lambda s, d: out(N.alert_list(A.alerts(s, d), A.accounts(s, d), rule="ZSCORE", severity="critical")),
        with_views(
            "SELECT l.id, l.account_id, a.full_name AS account_name, rule_code, severity, txn_count, CAST(total_amount AS DOUBLE) AS total_amount, "
            "evidence, l.status, l.created_at FROM (SELECT * FROM alerts WHERE rule_code = 'ZSCORE' AND severity = 'critical' "
            "ORDER BY created_at DESC, id LIMIT 500) l LEFT JOIN accounts a ON a.id = l.account_id",
            "alerts",
            "accounts",
        ),
    ),
    "alert_groups": (
        groups,
        with_views(
            "SELECT account_id, max(account_name) AS account_name, max(created_at) AS last_seen, count(*) AS total_firings, "
            "string_agg(id, ',' ORDER BY created_at DESC, id DESC) AS firing_ids FROM listed GROUP BY account_id",
            "alerts",
            "accounts",
            extra=(LISTED,),
        ),
    ),
    "alert_rule_buckets": (
        buckets,
        with_views(
            f"SELECT b.*, total_amount, max_severity, open_count FROM (SELECT account_id, rule_code, {NAME.format('max(' + RANK.format('severity') + ')')} AS severity, "
            f"count(*) AS firings FROM listed GROUP BY 1, 2) b JOIN (SELECT account_id, CAST(sum(CAST(total_amount AS DECIMAL(38,2))) AS DOUBLE) AS total_amount, "
            f"{NAME.format('max(' + RANK.format('severity') + ')')} AS max_severity, count(*) FILTER (WHERE status = 'open') AS open_count FROM listed GROUP BY 1) t "
            "ON t.account_id = b.account_id",
            "alerts",
            "accounts",
            extra=(LISTED,),
        ),
    ),
    "alert_evidence_text": (
        lambda s, d: out(N.alert_evidence_text(A.alerts(s, d)).select("id", "evidence_text")),
        with_views(EVIDENCE_TEXT, "alerts"),
    ),
    "alert_counts": (
        lambda s, d: out(N.alert_counts(A.alerts(s, d), AS_OF, 7 * 86400, by_severity=True)),
        with_views(
            f"SELECT rule_code, severity, count(*) AS alerts, min(created_at) AS first_at, max(created_at) AS last_at FROM alerts "
            f"WHERE created_at >= {T} - INTERVAL 7 DAY AND created_at <= {T} GROUP BY 1, 2",
            "alerts",
        ),
    ),
    "open_alerts_24h": (
        lambda s, d: out(N.open_alerts_24h(A.alerts(s, d), AS_OF)),
        with_views(
            f"SELECT account_id, count(*) AS open_alerts_24h FROM alerts WHERE status = 'open' AND created_at >= {T} - INTERVAL 24 HOUR AND created_at <= {T} GROUP BY 1",
            "alerts",
        ),
    ),
    "case_status": (
        lambda s, d: out(N.case_status(A.alerts(s, d), transitions(s, d)).select("id", "status", "resolved_at")),
        with_views(
            "SELECT id, CASE WHEN o_orderkey % 3 = 1 THEN 'closed_fraud' WHEN o_orderkey % 3 = 2 AND o_orderkey % 5 <> 0 THEN 'closed_clean' ELSE 'open' END AS status, "
            "CASE WHEN o_orderkey % 3 = 1 OR (o_orderkey % 3 = 2 AND o_orderkey % 5 <> 0) THEN created_at + INTERVAL 1 HOUR END AS resolved_at FROM alerts",
            "alerts",
        ),
    ),
    "rule_confusion": (
        lambda s, d: out(confusion(s, d)),
        with_views("SELECT * FROM confusion", *RULE_VIEWS, extra=(*ALL_FLAGS, FLAGGED, CONFUSION)),
    ),
    "rule_scores": (
        lambda s, d: out(V.rule_scores(confusion(s, d))),
        with_views("SELECT * FROM scores", *RULE_VIEWS, extra=(*ALL_FLAGS, FLAGGED, CONFUSION)),
    ),
    "rule_macro_f1": (
        lambda s, d: out(V.rule_macro_f1(V.rule_scores(confusion(s, d))).withColumn("macro_f1", F.bround("macro_f1", 9))),
        with_views(
            "SELECT round_even(avg(f1), 9) AS macro_f1, count(f1) AS rules_scored FROM scores", *RULE_VIEWS, extra=(*ALL_FLAGS, FLAGGED, CONFUSION)
        ),
    ),
    "rules_firing": (
        lambda s, d: out(V.rules_firing(flagged_accounts(payloads(s, d)), RULE_CODES)),
        with_views(
            "SELECT r.rule_code, count(f.account_id) AS flagged, count(f.account_id) > 0 AS fires FROM "
            "(VALUES ('VELOCITY'),('LARGE_AMT'),('MULTI_CCY'),('ZSCORE'),('HIGH_RISK'),('FAIL_SPIKE')) r(rule_code) "
            "LEFT JOIN flagged f ON f.rule_code = r.rule_code GROUP BY r.rule_code",
            *RULE_VIEWS,
            extra=(*ALL_FLAGS, FLAGGED),
        ),
    ),
}
