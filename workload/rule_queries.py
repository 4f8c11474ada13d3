"""Registered queries: the rules, their views, history and feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.values import counts_text
from ledgerline.operators import dashboards as D
from ledgerline.operators import rule_views as V
from ledgerline.operators import rules as R
from ledgerline.operators.fused import flagged_accounts, fused_payloads, recent_state
from workload import adapters as A
from workload.adapters import AS_OF, FEED_RULES, LIVE, RULES, out, with_views

T = f"TIMESTAMP '{AS_OF}'"

ACCOUNT_FLAGS = (
    f"""velocity AS (
  SELECT account_id, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
         min(created_at) AS window_start, max(created_at) AS window_end,
         CAST(floor(epoch(max(created_at))) AS BIGINT) - CAST(floor(epoch(min(created_at))) AS BIGINT) AS window_seconds
  FROM txn WHERE created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T}
  GROUP BY account_id HAVING count(*) > 5 OR sum(amount) > 300)""",
    f"""velocity_types AS (
  SELECT account_id, string_agg(type || '=' || n, ',' ORDER BY type) AS txn_types,
         string_agg('{{"value":"' || type || '","n":' || n || '}}', ',' ORDER BY type) AS types_json
  FROM (SELECT account_id, type, count(*) AS n FROM txn
        WHERE created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T} GROUP BY account_id, type) GROUP BY account_id)""",
    f"""velocity_statuses AS (
  SELECT account_id, string_agg(status || '=' || n, ',' ORDER BY status) AS txn_statuses,
         string_agg('{{"value":"' || status || '","n":' || n || '}}', ',' ORDER BY status) AS statuses_json
  FROM (SELECT account_id, status, count(*) AS n FROM txn
        WHERE created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T} GROUP BY account_id, status) GROUP BY account_id)""",
    f"""multi AS (
  SELECT account_id, string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies,
         count(DISTINCT currency) AS currency_count, count(*) AS txn_count,
         min(created_at) AS first_txn, max(created_at) AS last_txn
  FROM txn WHERE created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T}
  GROUP BY account_id HAVING count(DISTINCT currency) > 2)""",
    f"""failing AS (
  SELECT * FROM (
    SELECT account_id, count(*) FILTER (WHERE status = 'failed') AS failed_count, count(*) AS total_count,
           round_even(CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) * 100, 1) AS fail_rate_pct
    FROM txn WHERE created_at >= {T} - INTERVAL 2 DAY AND created_at <= {T} GROUP BY account_id)
  WHERE failed_count >= 2 AND fail_rate_pct > 30)""",
)
Z_FLAGS = (
    f"""baseline AS (
  SELECT account_id, avg(CAST(amount AS DOUBLE)) AS avg_amount, stddev_pop(CAST(amount AS DOUBLE)) AS std_amount,
         count(*) AS txn_count_30d
  FROM txn WHERE created_at >= {T} - INTERVAL 30 DAY AND created_at <= {T}
  GROUP BY account_id HAVING count(*) >= 5)""",
    f"""outliers AS (
  SELECT t.id, t.account_id, t.amount, t.type, t.merchant_id, t.created_at, b.avg_amount, b.std_amount, b.txn_count_30d,
         (CAST(t.amount AS DOUBLE) - b.avg_amount) / nullif(b.std_amount, 0) AS z,
         round_even((CAST(t.amount AS DOUBLE) - b.avg_amount) / nullif(b.std_amount, 0), 2) AS z_score
  FROM txn t JOIN baseline b ON t.account_id = b.account_id
  WHERE t.created_at >= {T} - INTERVAL 10 DAY AND t.created_at <= {T}
    AND abs((CAST(t.amount AS DOUBLE) - b.avg_amount) / nullif(b.std_amount, 0)) > 3)""",
)
TXN_FLAGS = (
    f"""large AS (
  SELECT id, account_id, merchant_id, amount, currency, type, status, created_at FROM txn
  WHERE amount > 200 AND created_at >= {T} - INTERVAL 30 DAY AND created_at <= {T})""",
    f"""risky AS (
  SELECT t.id, t.account_id, t.amount, t.type, t.created_at, m.name AS merchant_name, m.risk_level
  FROM txn t JOIN merchants m ON t.merchant_id = m.id
  WHERE m.risk_level = 'high' AND t.created_at >= {T} - INTERVAL 7 DAY AND t.created_at <= {T})""",
)
ALL_FLAGS = (*ACCOUNT_FLAGS, *Z_FLAGS, *TXN_FLAGS)


def stamp(col: str) -> str:
    """Millisecond text of a timestamp, cut (not rounded) after the third digit."""
    return f"substr(strftime({col}, '%Y-%m-%d %H:%M:%S.%f'), 1, 23)"


PAYLOADS = f"""payloads AS (
  SELECT 'VELOCITY' AS rule_code, v.account_id, v.txn_count, CAST(v.total_amount AS DECIMAL(38,2)) AS total_amount,
         'high' AS severity,
         '{{"window_seconds":' || window_seconds || ',"window_start":"' || {stamp('window_start')} || '","window_end":"'
           || {stamp('window_end')} || '","txn_types":[' || types_json || '],"txn_statuses":[' || statuses_json || ']}}' AS evidence,
         0.0::DOUBLE AS position, '' AS txn_id
  FROM velocity v JOIN velocity_types t ON t.account_id = v.account_id JOIN velocity_statuses s ON s.account_id = v.account_id
  UNION ALL
  SELECT 'ZSCORE', account_id, 1, CAST(amount AS DECIMAL(38,2)), CASE WHEN abs(z_score) > 4 THEN 'critical' ELSE 'high' END,
         '{{"txn_id":"' || id || '","z_score":' || CAST(z_score AS DECIMAL(38,2)) || ',"type":"' || type || '","merchant_id":"' || merchant_id
           || '","avg_amount":' || CAST(avg_amount AS DECIMAL(38,6)) || ',"std_amount":' || CAST(std_amount AS DECIMAL(38,6))
           || ',"txn_count_30d":' || txn_count_30d || '}}',
         -abs(z_score), id FROM outliers
  UNION ALL
  SELECT 'LARGE_AMT', account_id, 1, CAST(amount AS DECIMAL(38,2)), CASE WHEN amount > 300 THEN 'critical' ELSE 'high' END,
         '{{"txn_id":"' || id || '","currency":"' || currency || '","type":"' || type || '","merchant_id":"' || merchant_id
           || '","status":"' || status || '"}}',
         -CAST(amount AS DOUBLE), id FROM large
  UNION ALL
  SELECT 'HIGH_RISK', account_id, 1, CAST(amount AS DECIMAL(38,2)), 'medium',
         '{{"txn_id":"' || id || '","merchant_name":"' || merchant_name || '","risk_level":"' || risk_level || '","type":"' || type || '"}}',
         -CAST(epoch_us(created_at) AS DOUBLE), id FROM risky
  UNION ALL
  SELECT 'MULTI_CCY', account_id, txn_count, CAST(0 AS DECIMAL(38,2)), 'medium',
         '{{"currencies":["' || replace(currencies, ',', '","') || '"],"currency_count":' || currency_count || ',"first_txn":"'
           || {stamp('first_txn')} || '","last_txn":"' || {stamp('last_txn')} || '"}}',
         0.0, '' FROM multi
  UNION ALL
  SELECT 'FAIL_SPIKE', account_id, failed_count, CAST(0 AS DECIMAL(38,2)), 'high',
         '{{"failed_count":' || failed_count || ',"total_count":' || total_count || ',"fail_rate_pct":'
           || CAST(fail_rate_pct AS DECIMAL(38,1)) || '}}',
         0.0, '' FROM failing)"""

ALL_PAYLOADS = (
    "SELECT rule_code, account_id, CAST(txn_count AS BIGINT) AS txn_count, CAST(total_amount AS DOUBLE) AS total_amount, "
    "severity, evidence, txn_id FROM payloads"
)

FLAGGED = """flagged AS (
  SELECT DISTINCT rule_code, account_id FROM (
    SELECT 'VELOCITY' AS rule_code, account_id FROM velocity UNION ALL SELECT 'ZSCORE', account_id FROM outliers
    UNION ALL SELECT 'LARGE_AMT', account_id FROM large UNION ALL SELECT 'HIGH_RISK', account_id FROM risky
    UNION ALL SELECT 'MULTI_CCY', account_id FROM multi UNION ALL SELECT 'FAIL_SPIKE', account_id FROM failing))"""


def flags(s, d, rules=RULES):
    return R.all_rule_flags(A.txn(s, d), A.merchants(s, d), AS_OF, rules)


def payloads(s, d):
    """Payload rows of all rules, from one pass over the transactions."""
    return fused_payloads(A.txn(s, d), A.merchants(s, d), AS_OF, RULES)


def payloads_from_log(s, d):
    """The same over the stored log."""
    return fused_payloads(recent_state(A.stored_log(s, d), AS_OF, RULES), A.merchants(s, d), AS_OF, RULES)


def velocity_rows(s, d):
    rows = R.rule_velocity(A.txn(s, d), AS_OF, RULES.velocity)
    return out(rows.withColumns({c: counts_text(F.col(c)) for c in ("txn_types", "txn_statuses")}))


def rounded(df, *names):
    """Derived doubles to six digits, because the two engines add in another order."""
    return df.withColumns({n: F.bround(n, 6) for n in names})


def zscore_rows(s, d):
    return out(rounded(R.rule_zscore(A.txn(s, d), AS_OF, RULES.zscore), "avg_amount", "std_amount"))


def multi_rows(s, d):
    rows = R.rule_multi_currency(A.txn(s, d), AS_OF, RULES.multi_currency)
    return out(rows.withColumn("currencies", F.array_join("currencies", ",")))


def view(rid):
    def run(s, d):
        rows = V.rule_view(rid, A.txn(s, d), A.merchants(s, d), AS_OF, RULES)
        return out(rounded(rows, "avg_amount", "std_amount") if rid == "R2" else rows)

    return run


def view_counts(s, d):
    return out(V.rule_view_counts(V.rule_views(A.txn(s, d), A.merchants(s, d), AS_OF, RULES)))


def history(s, d):
    return out(
        V.rule_history(
            A.txn(s, d),
            A.merchants(s, d),
            AS_OF,
            minutes=30 * 24 * 60,
            large=RULES.large_amount,
            zscore_proxy=100,
            clamp=False,
        )
    )


def feed_branch(code):
    def run(s, d):
        return out(V.feed_branches(A.txn(s, d), A.merchants(s, d), AS_OF, FEED_RULES)[code])

    return run


def number_text(expr: str, digits: int) -> str:
    text = f"CAST(CAST(round_even({expr}, {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"
    return f"regexp_replace({text}, '\\.?0+$', '')" if digits else text


FEED = {
    "VELOCITY": f"""SELECT 'VELOCITY' AS rule, 'high' AS severity, account_id AS subject, epoch_us(max(created_at)) // 1000 AS detected_at_ms,
  count(*) || ' txns, ' || {number_text('CAST(sum(amount) AS DOUBLE) / 1e6', 1)} || 'M VND in 5 min' AS message
FROM txn WHERE created_at >= {T} - INTERVAL 2 DAY AND created_at <= {T}
GROUP BY account_id HAVING count(*) > 8 OR sum(amount) > 450""",
    "LARGE_AMT": f"""SELECT 'LARGE_AMT' AS rule, 'high' AS severity, account_id AS subject, epoch_us(created_at) // 1000 AS detected_at_ms,
  'Single txn ' || {number_text('CAST(amount AS DOUBLE) / 1e6', 1)} || 'M ' || currency AS message
FROM txn WHERE amount > 150 AND created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T}""",
    "MULTI_CCY": f"""SELECT 'MULTI_CCY' AS rule, 'medium' AS severity, account_id AS subject, epoch_us(max(created_at)) // 1000 AS detected_at_ms,
  count(DISTINCT currency) || ' currencies in 10 min: ' || string_agg(DISTINCT currency, ',' ORDER BY currency) AS message
FROM txn WHERE created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T}
GROUP BY account_id HAVING count(DISTINCT currency) > 2""",
    "ZSCORE": f"""SELECT 'ZSCORE' AS rule, 'medium' AS severity, t.account_id AS subject, epoch_us(t.created_at) // 1000 AS detected_at_ms,
  'z=' || {number_text('(CAST(t.amount AS DOUBLE) - b.avg_amount) / nullif(b.std_amount, 0)', 1)} || ' vs 30d avg '
  || {number_text('b.avg_amount / 1e3', 0)} || 'k' AS message
FROM txn t JOIN (
  SELECT account_id, avg(CAST(amount AS DOUBLE)) AS avg_amount, stddev_pop(CAST(amount AS DOUBLE)) AS std_amount FROM txn
  WHERE created_at >= {T} - INTERVAL 30 DAY AND created_at <= {T} GROUP BY account_id HAVING count(*) >= 5) b
  ON t.account_id = b.account_id
WHERE t.created_at >= {T} - INTERVAL 1 DAY AND t.created_at <= {T}
  AND abs((CAST(t.amount AS DOUBLE) - b.avg_amount) / nullif(b.std_amount, 0)) > 3""",
    "HIGH_RISK": f"""SELECT 'HIGH_RISK' AS rule, 'high' AS severity, t.account_id AS subject, epoch_us(max(t.created_at)) // 1000 AS detected_at_ms,
  count(*) || ' txns to high-risk merchant: ' || min(m.name) AS message
FROM txn t JOIN merchants m ON t.merchant_id = m.id
WHERE m.risk_level = 'high' AND t.created_at >= {T} - INTERVAL 1 DAY AND t.created_at <= {T} GROUP BY t.account_id""",
    "FAIL_SPIKE": f"""SELECT 'FAIL_SPIKE' AS rule, 'high' AS severity, account_id AS subject, epoch_us(max(created_at)) // 1000 AS detected_at_ms,
  count(*) FILTER (WHERE status = 'failed') || '/' || count(*) || ' failed ('
  || {number_text("CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) * 100", 0)} || '% fail rate, 30 min)' AS message
FROM txn WHERE created_at >= {T} - INTERVAL 2 DAY AND created_at <= {T} GROUP BY account_id
HAVING count(*) FILTER (WHERE status = 'failed') >= 3 AND CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) > 0.5""",
}

HISTORY = f"""
SELECT rule_id, bucket, flags FROM (
  SELECT 'R1' AS rule_id, date_trunc('minute', created_at) AS bucket, count(*) AS flags FROM recent GROUP BY 2
  UNION ALL SELECT 'R5', date_trunc('minute', created_at), count(*) FROM recent GROUP BY 2
  UNION ALL SELECT 'R2', date_trunc('minute', created_at), count(*) FROM recent WHERE amount > 100 GROUP BY 2
  UNION ALL SELECT 'R3', date_trunc('minute', created_at), count(*) FROM recent WHERE amount > 200 GROUP BY 2
  UNION ALL SELECT 'R4', date_trunc('minute', t.created_at), count(*) FROM recent t JOIN merchants m ON t.merchant_id = m.id
    WHERE m.risk_level = 'high' GROUP BY 2
  UNION ALL SELECT 'R6', date_trunc('minute', created_at), count(*) FILTER (WHERE status = 'failed') FROM recent GROUP BY 2)"""

QUERIES = {
    "rule_velocity": (
        velocity_rows,
        with_views(
            "SELECT v.*, t.txn_types, s.txn_statuses FROM velocity v JOIN velocity_types t ON t.account_id = v.account_id "
            "JOIN velocity_statuses s ON s.account_id = v.account_id",
            "txn",
            extra=ACCOUNT_FLAGS[:3],
        ),
    ),
    "rule_zscore": (
        zscore_rows,
        with_views(
            "SELECT id, account_id, CAST(amount AS DOUBLE) AS amount, type, merchant_id, created_at, "
            "round_even(avg_amount, 6) AS avg_amount, round_even(std_amount, 6) AS std_amount, txn_count_30d, z_score FROM outliers",
            "txn",
            extra=Z_FLAGS,
        ),
    ),
    "rule_large_amount": (
        lambda s, d: out(R.rule_large_amount(A.txn(s, d), AS_OF, RULES.large_amount)),
        with_views(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM large", "txn", extra=TXN_FLAGS[:1]
        ),
    ),
    "rule_high_risk": (
        lambda s, d: out(R.rule_high_risk(A.txn(s, d), A.merchants(s, d), AS_OF, RULES.high_risk)),
        with_views(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM risky", "txn", "merchants", extra=TXN_FLAGS[1:]
        ),
    ),
    "rule_multi_currency": (multi_rows, with_views("SELECT * FROM multi", "txn", extra=ACCOUNT_FLAGS[3:4])),
    "rule_fail_spike": (
        lambda s, d: out(R.rule_fail_spike(A.txn(s, d), AS_OF, RULES.fail_spike)),
        with_views("SELECT * FROM failing", "txn", extra=ACCOUNT_FLAGS[4:]),
    ),
    "rules_all": (
        lambda s, d: out(payloads(s, d).drop("position")),
        with_views(ALL_PAYLOADS, "txn", "merchants", extra=(*ALL_FLAGS, PAYLOADS)),
    ),
    "rules_all_from_log": (
        lambda s, d: out(payloads_from_log(s, d).drop("position")),
        with_views(ALL_PAYLOADS, "merchants", extra=(LIVE, *ALL_FLAGS, PAYLOADS)),
    ),
    "rule_flagged_accounts": (
        lambda s, d: out(flagged_accounts(payloads(s, d), A.accounts(s, d).select(F.col("id").alias("account_id")))),
        with_views(
            "SELECT rule_code, account_id FROM flagged WHERE account_id IN (SELECT id FROM accounts)",
            "txn",
            "merchants",
            "accounts",
            extra=(*ALL_FLAGS, FLAGGED),
        ),
    ),
    "rule_view_r1": (
        view("R1"),
        with_views(
            f"SELECT account_id, txn_count, total_amount, {stamp('window_start')} AS window_start, {stamp('window_end')} AS window_end FROM velocity",
            "txn",
            extra=ACCOUNT_FLAGS[:1],
        ),
    ),
    "rule_view_r2": (
        view("R2"),
        with_views(
            f"SELECT id AS txn_id, account_id, CAST(amount AS DOUBLE) AS amount, type, {stamp('created_at')} AS created_at, "
            "round_even(avg_amount, 6) AS avg_amount, round_even(std_amount, 6) AS std_amount, z_score FROM outliers",
            "txn",
            extra=Z_FLAGS,
        ),
    ),
    "rule_view_r3": (
        view("R3"),
        with_views(
            f"SELECT id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, {stamp('created_at')} AS ts FROM large",
            "txn",
            extra=TXN_FLAGS[:1],
        ),
    ),
    "rule_view_r4": (
        view("R4"),
        with_views(
            f"SELECT id, account_id, CAST(amount AS DOUBLE) AS amount, type, {stamp('created_at')} AS created_at, merchant_name, risk_level FROM risky",
            "txn",
            "merchants",
            extra=TXN_FLAGS[1:],
        ),
    ),
    "rule_view_r5": (
        view("R5"),
        with_views(
            f"SELECT account_id, currencies, currency_count, txn_count, {stamp('first_txn')} AS first_txn, {stamp('last_txn')} AS last_txn FROM multi",
            "txn",
            extra=ACCOUNT_FLAGS[3:4],
        ),
    ),
    "rule_view_r6": (view("R6"), with_views("SELECT * FROM failing", "txn", extra=ACCOUNT_FLAGS[4:])),
    "rule_views": (
        view_counts,
        with_views(
            "SELECT 'R1' AS rule_id, count(*) AS flagged FROM velocity UNION ALL SELECT 'R2', count(*) FROM outliers "
            "UNION ALL SELECT 'R3', count(*) FROM large UNION ALL SELECT 'R4', count(*) FROM risky "
            "UNION ALL SELECT 'R5', count(*) FROM multi UNION ALL SELECT 'R6', count(*) FROM failing",
            "txn",
            "merchants",
            extra=ALL_FLAGS,
        ),
    ),
    "rule_history": (
        history,
        with_views(
            HISTORY,
            "txn",
            "merchants",
            extra=(f"recent AS (SELECT * FROM txn WHERE created_at >= {T} - INTERVAL 30 DAY AND created_at <= {T})",),
        ),
    ),
    "alert_feed": (
        lambda s, d: out(V.alert_feed(A.txn(s, d), A.merchants(s, d), AS_OF, FEED_RULES)),
        with_views(
            "SELECT * FROM ("
            + " UNION ALL ".join(f"({q})" for q in FEED.values())
            + ") ORDER BY detected_at_ms DESC, rule, subject, message LIMIT 50",
            "txn",
            "merchants",
        ),
    ),
    **{f"alert_feed_{code.lower()}": (feed_branch(code), with_views(q, "txn", "merchants")) for code, q in FEED.items()},
    "panel_velocity": (
        lambda s, d: out(D.panel_velocity(A.txn(s, d), AS_OF, RULES.velocity)),
        with_views(
            "SELECT account_id, txn_count, total_amount, window_start, window_end FROM velocity", "txn", extra=ACCOUNT_FLAGS[:1]
        ),
    ),
}
