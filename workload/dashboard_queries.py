"""Registered queries: dashboards, pipeline health, entity views, topics, benchmark summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import dashboards as D
from ledgerline.operators import lookups as L
from ledgerline.operators import topics as K
from ledgerline.operators.history import velocity_any_window
from ledgerline.operators.reconcile import differences
from ledgerline.operators.sketches import RANK_ERROR, delay_sketches, merged_quantiles
from workload import adapters as A
from workload.adapters import AS_OF, DAY, LIVE, RULES, out, with_views
from workload.rule_queries import T, rounded, stamp

MONTH = 30 * DAY
LIVE_MS = 1_709_000_000_000  # after all rows
HEALTH_AT = "2024-01-30 12:00:00"  # a moment with recent rows
H = f"TIMESTAMP '{HEALTH_AT}'"
LAG = "(epoch_us(ingested_at) // 1000 - epoch_us(created_at) // 1000)"
RECENT = f"created_at >= {T} - INTERVAL 30 DAY AND created_at <= {T}"
INGESTED = f"ingested_at >= {T} - INTERVAL 30 DAY AND ingested_at <= {T}"


def at(fn, *args, **kw):
    return lambda s, d: out(fn(A.txn(s, d), *args, **kw))


def topic(s, d):
    """Three topics over the tables; offsets run from 0 in every partition."""

    def keyed(table, key, name, parts):
        k = F.col(key)
        return A.read(s, d, table).select(
            F.lit(f"public.{name}").alias("topic"),
            (k % parts).cast("int").alias("partition"),
            F.floor(k / parts).cast("bigint").alias("offset"),
        )

    return (
        keyed("events", "event_id", "transactions", 6)
        .unionByName(keyed("customer", "c_custkey", "accounts", 3))
        .unionByName(keyed("supplier", "s_suppkey", "merchants", 3))
    )


TOPIC = """topic AS (
  SELECT 'public.transactions' AS topic, CAST(event_id % 6 AS INTEGER) AS partition, event_id // 6 AS "offset" FROM events
  UNION ALL SELECT 'public.accounts', CAST(c_custkey % 3 AS INTEGER), c_custkey // 3 FROM customer
  UNION ALL SELECT 'public.merchants', CAST(s_suppkey % 3 AS INTEGER), s_suppkey // 3 FROM supplier)"""


def committed(s, d):
    """What consumers have read: the events up to three quarters, -1 and nothing elsewhere."""
    t = topic(s, d)
    progress = t.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    known = progress.where("topic <> 'public.merchants'")
    return known.select(
        "topic",
        "partition",
        F.expr("CASE WHEN topic = 'public.transactions' THEN last * 3 div 4 WHEN partition = 1 THEN -1 ELSE last END").alias("offset"),
    )


def lag(s, d):
    return K.consumer_lag(K.log_ends(topic(s, d)), committed(s, d))


LAG_SQL = """ends AS (SELECT topic, partition, max("offset") AS last, max("offset") + 1 AS log_end FROM topic GROUP BY topic, partition),
done AS (SELECT topic, partition, CASE WHEN topic = 'public.transactions' THEN last * 3 // 4 WHEN partition = 1 THEN -1 ELSE last END AS committed
  FROM ends WHERE topic <> 'public.merchants'),
lagging AS (SELECT e.topic, e.partition, CASE WHEN coalesce(committed, -1) < 0 THEN 0 ELSE committed END AS current, log_end,
  log_end - CASE WHEN coalesce(committed, -1) < 0 THEN 0 ELSE committed END AS lag,
  CASE WHEN committed IS NULL THEN 'no committed offsets' END AS hint
  FROM ends e LEFT JOIN done d ON e.topic = d.topic AND e.partition = d.partition)"""


def tail(s, d):
    rows = K.topic_tail(A.wire_records(s, d, broken=True), 200)
    return out(
        rows.select(
            "partition",
            "offset",
            "timestamp",
            "key",
            F.col("value_json").isNotNull().alias("is_json"),
            F.get_json_object("value_json", "$.amount").alias("amount"),
            F.when(F.col("value_json").isNull(), F.col("value")).alias("raw"),
        )
    )


def samples(s, d):
    return A.txn(s, d).select(
        F.col("id").cast("bigint").alias("sample_no"), (F.unix_millis("_ingested_at") - F.col("_source_ts_ms")).alias("e2e_latency_ms")
    )


def health(s, d):
    return out(D.health_summary(A.txn(s, d), HEALTH_AT, window_s=DAY, rate_s=3600))


def top(s, d, **kw):
    return out(D.top_merchants(A.txn(s, d), A.merchants(s, d), AS_OF, window_s=MONTH, **kw))


def any_window(s, d):
    return out(velocity_any_window(A.txn(s, d), RULES.velocity, 2 * DAY))


def merged(s, d):
    """Quantiles of each day from the sketches of its minutes, and whether their ranks among the day's delays are as exact as stated."""
    log = A.txn(s, d)
    sketches = delay_sketches(log)
    points = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    days = merged_quantiles(sketches, "2024-01-01 00:00:00", "2024-02-01 00:00:00", tuple(points.values()), by_s=DAY)
    lags = D.pipeline_lag(log).select(F.date_trunc("day", "_ingested_at").alias("day"), D.LAG)
    ranked = lags.join(days, lags["day"] == days["time"]).groupBy("time", "rows")
    below = [F.count_if(F.col(D.LAG) < F.col(p)).alias(f"less_{p}") for p in points] + [F.count_if(F.col(D.LAG) <= F.col(p)).alias(f"most_{p}") for p in points]
    near = [f"(less_{p} <= ({q} + {RANK_ERROR}) * rows + 1 AND most_{p} >= ({q} - {RANK_ERROR}) * rows - 1) AS {p}_near" for p, q in points.items()]
    return out(ranked.agg(*below).selectExpr("time", "rows", *near))


def damaged(s, d):
    """The state of transactions against a copy in which some rows are lost, changed or repeated: the keys that differ."""
    rows = A.txn(s, d).select("id", "account_id", "merchant_id", "amount", "currency", "type", "status", "created_at")
    number = F.col("id").cast("bigint")
    copy = rows.where(number % 997 != 3)
    copy = copy.withColumn("amount", F.when(number % 991 == 5, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")))
    copy = copy.withColumn("merchant_id", F.when(number % 983 == 7, F.lit(None)).otherwise(F.col("merchant_id")))
    return out(differences(rows, copy.unionByName(copy.where(number % 977 == 11))))


QUERIES = {
    "velocity_any_window": (
        any_window,
        with_views(
            """SELECT account_id, max(n) AS peak_count, CAST(max(total) AS DOUBLE) AS peak_amount, min(created_at) FILTER (WHERE n > 5 OR total > 300) AS first_over,
  count(DISTINCT created_at) FILTER (WHERE n > 5 OR total > 300) AS times_over
FROM (SELECT account_id, created_at, count(*) OVER w AS n, sum(amount) OVER w AS total FROM txn
      WINDOW w AS (PARTITION BY account_id ORDER BY created_at RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))
GROUP BY account_id HAVING times_over > 0""",
            "txn",
        ),
    ),
    "merged_quantiles": (
        merged,
        with_views(
            "SELECT date_trunc('day', ingested_at) AS time, count(*) AS rows, true AS p50_ms_near, true AS p95_ms_near, true AS p99_ms_near FROM txn "
            "WHERE ingested_at >= TIMESTAMP '2024-01-01 00:00:00' AND ingested_at < TIMESTAMP '2024-02-01 00:00:00' GROUP BY 1",
            "txn",
        ),
    ),
    "reconcile_differences": (
        damaged,
        with_views(
            """SELECT id, 1 AS left_rows, CASE WHEN event_id % 997 = 3 THEN 0 WHEN event_id % 977 = 11 THEN 2 ELSE 1 END AS right_rows FROM txn
WHERE event_id % 997 = 3 OR (event_id % 991 = 5 AND amount <> 0) OR event_id % 983 = 7 OR event_id % 977 = 11""",
            "txn",
        ),
    ),
    "volume_per_minute": (
        at(D.volume_per_minute, AS_OF, MONTH),
        with_views(
            f"SELECT date_trunc('minute', created_at) AS minute, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount, "
            f"count(*) FILTER (WHERE status = 'failed') AS failed_count, count(*) FILTER (WHERE status = 'flagged') AS flagged_count "
            f"FROM txn WHERE {RECENT} GROUP BY 1",
            "txn",
        ),
    ),
    "txn_per_minute": (
        at(D.txn_per_minute, start="2024-01-05 06:00:00", end="2024-01-25 18:00:00"),
        with_views(
            "SELECT date_trunc('minute', created_at) AS time, count(*) AS txn_count FROM txn "
            "WHERE created_at BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-25 18:00:00' GROUP BY 1",
            "txn",
        ),
    ),
    "amount_per_minute": (
        at(D.amount_per_minute, AS_OF, MONTH),
        with_views(
            f"SELECT date_trunc('minute', created_at) AS time, CAST(sum(amount) AS DOUBLE) AS total_amount FROM txn WHERE {RECENT} GROUP BY 1",
            "txn",
        ),
    ),
    "type_breakdown": (
        at(D.type_breakdown, AS_OF, MONTH),
        with_views(
            f"SELECT type, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount, "
            f"CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount FROM txn WHERE {RECENT} GROUP BY type",
            "txn",
        ),
    ),
    "status_mix": (
        at(D.status_mix, AS_OF, MONTH),
        with_views(f"SELECT status, count(*) AS c FROM txn WHERE {RECENT} GROUP BY status", "txn"),
    ),
    "top_merchants": (
        top,
        with_views(
            f"SELECT name, category, risk_level, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount "
            f"FROM txn t JOIN merchants m ON t.merchant_id = m.id WHERE {RECENT} "
            f"GROUP BY name, category, risk_level ORDER BY total_amount DESC, name, category, risk_level LIMIT 20",
            "txn",
            "merchants",
        ),
    ),
    "top_merchants_by_category": (
        lambda s, d: top(s, d, limit=10, by_risk=False),
        with_views(
            f"SELECT name, category, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount "
            f"FROM txn t JOIN merchants m ON t.merchant_id = m.id WHERE {RECENT} "
            f"GROUP BY name, category ORDER BY total_amount DESC, name, category LIMIT 10",
            "txn",
            "merchants",
        ),
    ),
    "ingestion_lag": (
        at(D.ingestion_lag, AS_OF, MONTH),
        with_views(
            f"SELECT date_trunc('minute', ingested_at) AS ingested_minute, count(*) AS rows_ingested, "
            f"CAST(sum({LAG}) AS DOUBLE) / count(*) AS avg_lag_ms, max({LAG}) AS max_lag_ms FROM txn WHERE {INGESTED} GROUP BY 1",
            "txn",
        ),
    ),
    "latency_quantiles": (
        lambda s, d: out(rounded(D.latency_quantiles(A.txn(s, d), "2024-01-01 00:00:00", AS_OF), "p50_ms", "p95_ms", "p99_ms")),
        with_views(
            "SELECT date_trunc('minute', ingested_at) AS time, round_even(quantile_cont(lag, 0.5), 6) AS p50_ms, "
            "round_even(quantile_cont(lag, 0.95), 6) AS p95_ms, round_even(quantile_cont(lag, 0.99), 6) AS p99_ms "
            "FROM (SELECT ingested_at, CAST(epoch_us(ingested_at) // 1000 - source_ts_ms AS DOUBLE) AS lag FROM txn "
            f"WHERE ingested_at BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND {T}) GROUP BY 1",
            "txn",
        ),
    ),
    "lag_histogram": (
        at(D.lag_histogram, AS_OF, MONTH),
        with_views(
            f"SELECT epoch_us(ingested_at) // 1000 - source_ts_ms AS pipeline_lag_ms, count(*) AS rows FROM txn WHERE {INGESTED} "
            "GROUP BY 1 ORDER BY 1 DESC LIMIT 10",
            "txn",
        ),
    ),
    "txn_latency": (
        at(D.txn_latency),
        with_views(
            "SELECT id, source_ts_ms, epoch_us(ingested_at) // 1000 AS ingested_ms, epoch_us(ingested_at) // 1000 - source_ts_ms AS e2e_latency_ms FROM txn",
            "txn",
        ),
    ),
    "health_summary": (
        health,
        with_views(
            f"SELECT round_even(CAST(sum({LAG}) AS DOUBLE) / count(*), 0) AS avg_latency_ms, round_even(quantile_cont(CAST({LAG} AS DOUBLE), 0.95), 0) AS p95_latency_ms, "
            f"round_even(count(*) FILTER (WHERE ingested_at > {H} - INTERVAL 1 HOUR) / 3600.0::DOUBLE, 1) AS tps_now, "
            f"(SELECT count(*) FROM txn WHERE CAST(created_at AS DATE) = CAST({H} AS DATE)) AS total_today, count(*) AS sample_rows "
            f"FROM txn WHERE ingested_at > {H} - INTERVAL 1 DAY AND ingested_at <= {H}",
            "txn",
        ),
    ),
    "tps_series": (
        lambda s, d: out(D.tps_series(A.txn(s, d), HEALTH_AT, 7200)),
        with_views(
            f"SELECT t, sum(tps) AS tps FROM (SELECT CAST(floor(epoch(ingested_at)) AS BIGINT) AS t, count(*) AS tps FROM txn "
            f"WHERE ingested_at > {H} - INTERVAL 2 HOUR AND ingested_at <= {H} GROUP BY 1 "
            f"UNION ALL SELECT CAST(epoch({H}) AS BIGINT) - 7200 + i, 0 FROM range(7200) r(i)) GROUP BY t",
            "txn",
        ),
    ),
    "events_last_minute": (
        lambda s, d: out(D.events_last_minute(A.txn(s, d), HEALTH_AT, 6 * 3600)),
        with_views(
            f"SELECT count(*) AS events_last_minute FROM txn WHERE ingested_at > {H} - INTERVAL 6 HOUR AND ingested_at <= {H}", "txn"
        ),
    ),
    "latency_summary": (
        lambda s, d: out(rounded(D.latency_summary(samples(s, d), warmup=3, target_ms=4000), "avg_ms", "stddev_ms", "p95_ms", "p99_ms")),
        with_views(
            "SELECT count(*) AS samples, min(v) AS min_ms, round_even(CAST(sum(v) AS DOUBLE) / count(*), 6) AS avg_ms, "
            "quantile_cont(CAST(v AS DOUBLE), 0.5) AS median_ms, round_even(stddev_samp(v), 6) AS stddev_ms, "
            "round_even(quantile_cont(CAST(v AS DOUBLE), 0.95), 6) AS p95_ms, round_even(quantile_cont(CAST(v AS DOUBLE), 0.99), 6) AS p99_ms, "
            "max(v) AS max_ms, CAST(count(*) FILTER (WHERE v <= 4000) AS DOUBLE) / count(*) AS within_target "
            "FROM (SELECT event_id, epoch_us(ingested_at) // 1000 - source_ts_ms AS v FROM txn) WHERE event_id >= 3 AND v > 0",
            "txn",
        ),
    ),
    "throughput_summary": (
        lambda s, d: out(rounded(D.throughput_summary(A.batch_timings(s, d), 500), "burst_tps", "sustained_tps", "batch_ms_avg")),
        """WITH b AS (
  SELECT event_id // 100 AS batch, count(*) AS rows FROM events GROUP BY 1),
t AS (SELECT batch * 100 + rows AS inserted_after, rows, batch * 100 AS started_ms, batch * 100 + 40 + (batch * 37) % 61 AS ended_ms FROM b),
m AS (SELECT ended_ms - started_ms AS ms, row_number() OVER (ORDER BY ended_ms - started_ms) - 1 AS i, count(*) OVER () AS n FROM t WHERE inserted_after > 500)
SELECT (SELECT sum(rows) FROM t) AS total_rows, (SELECT sum(rows) FROM t) - 500 AS measured_rows,
  round_even((SELECT sum(rows) * 1000.0::DOUBLE / (max(ended_ms) - min(started_ms)) FROM t), 6) AS burst_tps,
  round_even((SELECT (sum(rows) - 500) * 1000.0::DOUBLE / (max(ended_ms) - min(ended_ms) FILTER (WHERE inserted_after >= 500)) FROM t), 6) AS sustained_tps,
  count(*) AS batches_measured, min(ms) AS batch_ms_min, round_even(CAST(sum(ms) AS DOUBLE) / count(*), 6) AS batch_ms_avg,
  CAST(max(ms) FILTER (WHERE i = n * 95 // 100) AS DOUBLE) AS batch_ms_p95, max(ms) AS batch_ms_max FROM m""",
    ),
    "live_transactions": (
        lambda s, d: out(L.live_transactions(A.txn(s, d), A.accounts(s, d), A.merchants(s, d))),
        with_views(
            f"SELECT t.id, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.type, t.status, {stamp('t.created_at')} AS created_at, "
            f"t.source_ts_ms, {stamp('t.ingested_at')} AS ingested_at, a.full_name AS account_name, m.name AS merchant_name, "
            "m.category AS merchant_category, m.risk_level AS merchant_risk FROM txn t LEFT JOIN accounts a ON t.account_id = a.id "
            "LEFT JOIN merchants m ON t.merchant_id = m.id ORDER BY t.source_ts_ms DESC, t.id LIMIT 20",
            "txn",
            "accounts",
            "merchants",
        ),
    ),
    "transactions_since": (
        lambda s, d: out(L.transactions_since(A.txn(s, d), "1704499200000", highlight_above=100)),
        with_views(
            "SELECT id, account_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, source_ts_ms, "
            "CASE WHEN amount > 100 THEN 1 ELSE 0 END AS is_fraud FROM txn WHERE source_ts_ms > 1704499200000 "
            "ORDER BY source_ts_ms, id LIMIT 100",
            "txn",
        ),
    ),
    "transactions_since_from_log": (
        lambda s, d: out(L.since_from_log(A.stored_log(s, d), "1704499200000", highlight_above=100)),
        with_views(
            "SELECT id, account_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, source_ts_ms + 1000 AS source_ts_ms, "
            "CASE WHEN amount > 100 THEN 1 ELSE 0 END AS is_fraud FROM txn WHERE source_ts_ms + 1000 > 1704499200000 "
            "ORDER BY source_ts_ms, id LIMIT 100",
            extra=(LIVE,),
        ),
    ),
    "live_transactions_from_log": (
        lambda s, d: out(L.live_from_log(A.stored_log(s, d), A.accounts(s, d), A.merchants(s, d), LIVE_MS).drop("ingested_at")),
        with_views(
            f"SELECT t.id, CAST(t.amount AS DOUBLE) AS amount, t.currency, t.type, t.status, {stamp('t.created_at')} AS created_at, "
            "t.source_ts_ms + 1000 AS source_ts_ms, a.full_name AS account_name, m.name AS merchant_name, "
            "m.category AS merchant_category, m.risk_level AS merchant_risk FROM txn t LEFT JOIN accounts a ON t.account_id = a.id "
            f"LEFT JOIN merchants m ON t.merchant_id = m.id WHERE t.source_ts_ms + 1000 <= {LIVE_MS} "
            "ORDER BY t.source_ts_ms DESC, t.id LIMIT 20",
            "accounts",
            "merchants",
            extra=(LIVE,),
        ),
    ),
    "transaction_by_id": (
        lambda s, d: out(L.transaction_by_id(A.txn(s, d), "77", validate=False)),
        with_views(
            f"SELECT id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, description, "
            f"{stamp('created_at')} AS created_at, source_ts_ms, {stamp('ingested_at')} AS ingested_at, "
            "epoch_us(ingested_at) // 1000 AS ingested_at_ms, 'c' AS cdc_op FROM txn WHERE id = '77'",
            "txn",
        ),
    ),
    "active_accounts": (
        lambda s, d: out(L.active_accounts(A.accounts(s, d))),
        with_views("SELECT id, full_name, email, status FROM accounts WHERE status = 'active'", "accounts"),
    ),
    "account_search": (
        lambda s, d: out(L.account_search(A.accounts(s, d), A.alerts(s, d), AS_OF, q="R#00000000", limit=200)),
        with_views(
            "SELECT a.id, full_name, email, CAST(balance AS DOUBLE) AS balance, a.status, coalesce(n, 0) AS open_alerts_24h "
            "FROM accounts a LEFT JOIN (SELECT account_id, count(*) AS n FROM alerts WHERE status = 'open' "
            f"AND created_at >= {T} - INTERVAL 24 HOUR AND created_at <= {T} GROUP BY account_id) o ON o.account_id = a.id "
            "WHERE contains(lower(full_name), 'r#00000000') OR contains(lower(email), 'r#00000000') ORDER BY full_name, a.id LIMIT 200",
            "accounts",
            "alerts",
        ),
    ),
    "account_by_id": (
        lambda s, d: out(L.account_by_id(A.accounts(s, d), "42", validate=False)),
        with_views(
            "SELECT id, full_name, email, CAST(NULL AS VARCHAR) AS phone, CAST(balance AS DOUBLE) AS balance, currency, status, created_at, "
            "created_at AS updated_at FROM accounts WHERE id = '42'",
            "accounts",
        ),
    ),
    "account_transactions": (
        lambda s, d: out(L.account_transactions(A.txn(s, d), A.merchants(s, d))),
        with_views(
            "SELECT account_id, t.id, type, status, CAST(amount AS DOUBLE) AS amount, currency, description, m.name AS merchant_name, created_at "
            "FROM (SELECT * FROM txn QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY created_at DESC, id) <= 20) t "
            "LEFT JOIN merchants m ON t.merchant_id = m.id",
            "txn",
            "merchants",
        ),
    ),
    "account_alerts": (
        lambda s, d: out(L.account_alerts(A.alerts(s, d))),
        with_views(
            "SELECT account_id, id, rule_code, severity, txn_count, CAST(total_amount AS DOUBLE) AS total_amount, status, evidence, created_at "
            "FROM alerts QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY created_at DESC, id) <= 20",
            "alerts",
        ),
    ),
    "merchant_list": (
        lambda s, d: out(L.merchant_list(A.merchants(s, d))),
        with_views("SELECT id, name, category, risk_level FROM merchants", "merchants"),
    ),
    "topic_tail": (
        tail,
        """WITH rec AS (
  SELECT event_id, CAST(event_id % 6 AS INTEGER) AS partition, event_id // 6 AS "offset", ts, CAST(event_id AS VARCHAR) AS key,
    CASE WHEN event_id % 97 = 5 THEN '{bad' END AS raw, event_id % 97 <> 5 AND event_id % 89 <> 7 AS is_json,
    CASE WHEN event_id % 97 <> 5 AND event_id % 89 <> 7 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount FROM events),
tails AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY partition ORDER BY "offset" DESC) <= 200)
SELECT partition, "offset", ts AS timestamp, key, is_json, amount, raw FROM tails ORDER BY ts DESC, "offset" DESC, partition LIMIT 200""",
    ),
    "topic_stats": (
        lambda s, d: out(K.topic_stats(topic(s, d))),
        with_views(
            'SELECT topic, count(*) AS partition_count, sum(n) AS message_count FROM (SELECT topic, partition, max("offset") - min("offset") + 1 AS n '
            "FROM topic GROUP BY topic, partition) GROUP BY topic",
            extra=(TOPIC,),
        ),
    ),
    "consumer_lag": (
        lambda s, d: out(lag(s, d)),
        with_views("SELECT * FROM lagging", extra=(TOPIC, LAG_SQL)),
    ),
    "consumer_total_lag": (
        lambda s, d: out(K.total_lag(lag(s, d))),
        with_views("SELECT topic, sum(lag) AS total_lag FROM lagging GROUP BY topic", extra=(TOPIC, LAG_SQL)),
    ),
}
