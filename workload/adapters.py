"""Views of the supplied tables as transactions, accounts, merchants, alerts and messages.

`DUCK` holds the same definitions as SQL for the checks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.params import FailSpike, HighRisk, LargeAmount, MultiCurrency, RuleSet, Velocity, ZScore
from ledgerline.schemas import TRANSACTIONS
from ledgerline.session import shared_dir
from ledgerline.sources.logs import append_versions, read_log

AS_OF = "2024-01-31 00:00:00"
DAY = 86_400

# Thresholds scaled to the sparser supplied events (about 66 per account in 30 days).
RULES = RuleSet(
    velocity=Velocity(window_s=DAY, max_count=5, max_total=300),
    zscore=ZScore(window_s=10 * DAY, critical_abs_z=4.0),
    large_amount=LargeAmount(window_s=30 * DAY, max_amount=200, critical_amount=300),
    high_risk=HighRisk(window_s=7 * DAY),
    multi_currency=MultiCurrency(window_s=DAY),
    fail_spike=FailSpike(window_s=2 * DAY, min_failed=2, max_rate_pct=30.0),
)
FEED_RULES = RuleSet(
    velocity=Velocity(window_s=2 * DAY, max_count=8, max_total=450),
    zscore=ZScore(window_s=DAY),
    large_amount=LargeAmount(window_s=DAY, max_amount=150),
    high_risk=HighRisk(window_s=DAY),
    multi_currency=MultiCurrency(window_s=DAY),
    fail_spike=FailSpike(window_s=2 * DAY, min_failed=3, max_rate_pct=50.0),
)

# Instants in the files are UTC without a zone marker. Declaring the column as a plain
# timestamp reads them as they are, so filters on it reach the parquet scan. Declared
# schemas also save the look into the files that inferring them would take.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string"
    ),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def out(df: DataFrame) -> DataFrame:
    """Result form for comparison: zone-free timestamps, amounts as doubles."""

    def shown(field: T.StructField) -> str:
        if isinstance(field.dataType, T.TimestampType):
            return f"CAST(`{field.name}` AS TIMESTAMP_NTZ) AS `{field.name}`"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST(`{field.name}` AS DOUBLE) AS `{field.name}`"
        return f"`{field.name}`"

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


CURRENCY = "CASE event_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' ELSE 'VND' END"
STATUS = (
    "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'flagged' WHEN 'view' THEN 'pending' "
    "ELSE 'completed' END"
)
MERCHANT = "regexp_extract(props, '\"k\": ([0-9]+)', 1)"
OPERATION = "CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END"


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction in its current state."""
    return read(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS id",
        "CAST(user_id AS STRING) AS account_id",
        f"{MERCHANT} AS merchant_id",
        "CAST(value AS DECIMAL(18,2)) AS amount",
        f"{CURRENCY} AS currency",
        "event_type AS type",
        f"{STATUS} AS status",
        "props AS description",
        "CAST(NULL AS STRING) AS ip_address",
        "CAST(NULL AS STRING) AS device_id",
        "ts AS created_at",
        "ts AS updated_at",
        "'c' AS cdc_op",
        "unix_millis(ts) AS _source_ts_ms",
        "timestamp_micros(unix_micros(ts) + (event_id % 5000) * 1000) AS _ingested_at",
    )


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as versions of (account, type) rows: updates, deletes, offsets."""
    return txn(spark, sf_dir).selectExpr(
        "concat_ws('-', account_id, type) AS id",
        "* EXCEPT (id, cdc_op)",
        "CAST(id AS BIGINT) AS _offset",
        "CASE WHEN CAST(id AS BIGINT) % 10 = 9 THEN 'd' WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'u' ELSE 'c' END AS cdc_op",
        "CAST(date_format(created_at, 'yyyyMM') AS INT) AS yyyymm",
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every event's transaction, the first with another amount and status; every tenth is deleted by a third."""
    steps = "IF(event_id % 10 = 9, array(0, 1, 2), array(0, 1))"
    rows = txn(spark, sf_dir).selectExpr("*", "CAST(id AS BIGINT) AS event_id").selectExpr("*", f"explode({steps}) AS step")
    changed = {
        "amount": "IF(step = 0, CAST(amount * 9 AS DECIMAL(18,2)), amount)",
        "status": "IF(step = 0, 'failed', status)",
        "cdc_op": "element_at(array('c', 'u', 'd'), step + 1)",
        "_source_ts_ms": "_source_ts_ms + step * 1000",
    }
    names = [f"{changed.get(c, c)} AS {c}" for c in TRANSACTIONS.columns]
    names += [f"{changed[c]} AS {c}" for c in ("cdc_op", "_source_ts_ms")]
    return rows.selectExpr(*names, "CAST(event_id % 6 AS INT) AS _partition", "event_id div 6 * 3 + step AS _offset")


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions as a stored log, written by two batches of which the second holds the deletes."""
    path = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    rows = versions(spark, sf_dir)
    append_versions(rows.where("cdc_op <> 'd'"), path, "supplied", 0)
    append_versions(rows.where("cdc_op = 'd'"), path, "supplied", 1)
    return read_log(spark, path, TRANSACTIONS)


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id",
        "s_name AS name",
        "CAST(s_nationkey AS STRING) AS category",
        "CASE WHEN s_acctbal < 1000 THEN 'high' WHEN s_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_level",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; every tenth is suspended and some share an e-mail address."""
    return read(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS id",
        "c_name AS full_name",
        "concat('c', CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END, '@example.com') AS email",
        "CAST(NULL AS STRING) AS phone",
        "CAST(c_acctbal AS DECIMAL(18,2)) AS balance",
        "'VND' AS currency",
        "CASE WHEN c_custkey % 10 = 0 THEN 'suspended' ELSE 'active' END AS status",
        "c_mktsegment AS category",
        "timestamp_seconds(1672531200 + c_custkey * 60) AS created_at",
        "timestamp_seconds(1672531200 + c_custkey * 60) AS updated_at",
    )


EVIDENCE = """CASE o_orderkey % 6
  WHEN 0 THEN concat('{"window_seconds":', o_orderkey % 300, ',"txn_types":[{"value":"purchase","n":2},{"value":"transfer","n":1}]}')
  WHEN 1 THEN concat('{"txn_id":"txn-000', o_orderkey, '","currency":"VND","type":"transfer"}')
  WHEN 2 THEN concat('{"currencies":["EUR","USD","VND"],"currency_count":', o_orderkey % 3 + 3, '}')
  WHEN 3 THEN concat('{"z_score":', o_orderkey % 9 + 3, '.25,"avg_amount":', o_orderkey, '.5,"std_amount":12,"txn_count_30d":31}')
  WHEN 4 THEN concat('{"merchant_name":"Supplier ', o_orderkey, '","risk_level":"high"}')
  ELSE concat('unreadable evidence of case ', o_orderkey) END"""


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as earlier cases, spread over the 30 days before AS_OF."""
    return read(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "CAST(o_custkey AS STRING) AS account_id",
        "CASE o_orderkey % 6 WHEN 0 THEN 'VELOCITY' WHEN 1 THEN 'LARGE_AMT' WHEN 2 THEN 'MULTI_CCY' "
        "WHEN 3 THEN 'ZSCORE' WHEN 4 THEN 'HIGH_RISK' ELSE 'FAIL_SPIKE' END AS rule_code",
        "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high' "
        "WHEN '3' THEN 'medium' ELSE 'low' END AS severity",
        "CAST(o_orderkey % 20 + 1 AS INT) AS txn_count",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount",
        f"{EVIDENCE} AS evidence",
        "CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed_fraud' ELSE 'closed_clean' END AS status",
        "CAST(NULL AS STRING) AS notes",
        "timestamp_seconds(1706659200 - (o_orderkey * 7919) % 2592000) AS created_at",
        "CAST(NULL AS TIMESTAMP) AS resolved_at",
    )


ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def wire_records(spark: SparkSession, sf_dir: str, broken: bool = False, every: int = 97) -> DataFrame:
    """Events as topic records with flat JSON change messages of the transactions table.

    Some creation times are empty or epoch milliseconds, every message has a field
    nobody declared, and with `broken` one in `every` is not JSON and some have no value.
    """
    created = f"CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 5 = 0 THEN CAST(unix_millis(ts) AS STRING) ELSE {ISO} END"
    message = f"""to_json(named_struct('id', CAST(event_id AS STRING), 'account_id', CAST(user_id AS STRING),
      'merchant_id', {MERCHANT}, 'amount', CAST(CAST(value AS DECIMAL(18,2)) AS STRING), 'currency', {CURRENCY},
      'type', event_type, 'status', {STATUS}, 'description', props, 'promo_code', 'promo', 'created_at', {created},
      'updated_at', {ISO}, '__deleted', 'false', '__op', {OPERATION}, '__table', 'transactions',
      '__source_ts_ms', unix_millis(ts)))"""
    if broken:
        message = f"CASE WHEN event_id % {every} = 5 THEN '{{bad' WHEN event_id % 89 = 7 THEN NULL ELSE {message} END"
    return read(spark, sf_dir, "events").selectExpr(
        "'public.transactions' AS topic",
        "CAST(event_id % 6 AS INT) AS partition",
        "event_id div 6 AS offset",
        "ts AS timestamp",
        "CAST(event_id AS STRING) AS key",
        f"{message} AS value",
    )


def tied_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three changes of every event's row in one source transaction: only their offsets tell them apart.

    The last one fails the transaction, or deletes every tenth row.
    """
    message = f"""to_json(named_struct('id', CAST(event_id AS STRING), 'account_id', CAST(user_id AS STRING), 'amount',
      CAST(CAST(value AS DECIMAL(18,2)) AS STRING), 'currency', {CURRENCY}, 'type', event_type,
      'status', element_at(array('pending', 'completed', 'failed'), step + 1), 'created_at', {ISO}, 'updated_at', {ISO},
      '__op', CASE WHEN step = 0 THEN 'c' WHEN step = 2 AND event_id % 10 = 9 THEN 'd' ELSE 'u' END, '__source_ts_ms', unix_millis(ts)))"""
    steps = read(spark, sf_dir, "events").selectExpr("*", "explode(array(0, 1, 2)) AS step")
    return steps.selectExpr(
        "'public.transactions' AS topic",
        "CAST(event_id % 6 AS INT) AS partition",
        "event_id div 6 * 3 + step AS offset",
        "ts AS timestamp",
        "CAST(event_id AS STRING) AS key",
        f"{message} AS value",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change envelopes; deletes carry the row in `before`, some are wrapped in `payload`."""
    e = read(spark, sf_dir, "events")
    k = F.col("event_id")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    row = F.struct(
        k.cast("string").alias("id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
        F.col("event_type").alias("type"),
        iso.alias("created_at"),
    )
    op = F.expr("CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END")
    body = F.struct(
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.struct(F.lit("transactions").alias("table"), F.unix_millis("ts").alias("ts_ms")).alias("source"),
        op.alias("op"),
    )
    value = F.when(k % 2 == 0, F.to_json(F.struct(body.alias("payload")))).otherwise(F.to_json(body))
    return e.select((k % 6).alias("partition"), F.floor(k / 6).alias("offset"), F.when(k % 89 != 7, value).alias("value"))


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ledger input: purchases, refunds, failed intents, top-ups, status commands."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("account_id"),
        F.col("ts").alias("at"),
        F.col("event_id").cast("string").alias("id"),
        F.expr(
            "CASE WHEN event_id % 23 = 0 THEN 'suspend' WHEN event_id % 23 = 1 THEN 'reactivate' "
            "WHEN event_id % 11 = 0 THEN 'topup' ELSE 'txn' END"
        ).alias("kind"),
        F.expr("CASE event_type WHEN 'signup' THEN 'refund' WHEN 'view' THEN 'transfer' ELSE 'purchase' END").alias("type"),
        (F.col("value") * 3).cast("decimal(18,2)").alias("amount"),
        F.expr("CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END").alias("intent"),
        F.expr(MERCHANT).alias("merchant_id"),
        F.expr(CURRENCY).alias("currency"),
        F.col("props").alias("description"),
    )


def ledger_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with an opening balance; every 15th customer is unknown to the ledger."""
    a = accounts(spark, sf_dir).where(F.col("id").cast("bigint") % 15 != 14)
    quarter = F.expr("CAST(abs(balance) * 100 AS BIGINT) div 4").cast("decimal(18,0)") / 100
    currency = F.expr("IF(CAST(id AS BIGINT) % 3 = 0, 'USD', 'VND')")
    return a.select("id", quarter.cast("decimal(18,2)").alias("balance"), "status", currency.alias("currency"))


def as_uuid(expr: str) -> str:
    return f"concat('00000000-0000-4000-8000-', lpad({expr}, 12, '0'))"


def intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as submitted intents, with every kind of mistake among them."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("at"),
        F.lit(None).cast("string").alias("description"),
        F.expr(
            "CASE WHEN event_id % 11 = 0 THEN concat('acct-', CAST(user_id AS STRING)) "
            "ELSE concat('00000000-0000-4000-8000-', lpad(CAST(user_id AS STRING), 12, '0')) END"
        ).alias("account_id"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 13 = 1 THEN '-5' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END").alias("amount"),
        F.expr("CASE WHEN event_id % 17 = 0 THEN 'GBP' WHEN event_id % 17 = 1 THEN NULL ELSE 'USD' END").alias("currency"),
        F.expr("CASE event_type WHEN 'error' THEN 'theft' WHEN 'view' THEN NULL ELSE 'purchase' END").alias("type"),
        F.expr(
            "CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 3 = 0 THEN '' WHEN event_id % 19 = 1 THEN 'm-1' "
            "ELSE '00000000-0000-4000-8000-000000000007' END"
        ).alias("merchant_id"),
        F.expr(
            "CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 3 = 0 THEN concat('Supplier#', lpad(CAST(user_id % 130 AS STRING), 9, '0')) END"
        ).alias("merchant"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a label group, half of them clean."""
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.expr(
            "CASE c_custkey % 12 WHEN 0 THEN 'VELOCITY' WHEN 1 THEN 'LARGE_AMT' WHEN 2 THEN 'MULTI_CCY' "
            "WHEN 3 THEN 'ZSCORE' WHEN 4 THEN 'HIGH_RISK' WHEN 5 THEN 'FAIL_SPIKE' END"
        ).alias("label"),
    )


def batch_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert batches of 100 events with their timings."""
    e = read(spark, sf_dir, "events")
    b = F.floor(F.col("event_id") / 100)
    per_batch = e.groupBy(b.alias("batch")).agg(F.count(F.lit(1)).alias("rows"))
    start = F.col("batch") * 100
    return per_batch.select(
        (F.col("batch") * 100 + F.col("rows")).alias("inserted_after"),
        "rows",
        start.alias("started_ms"),
        (start + 40 + (F.col("batch") * 37) % 61).alias("ended_ms"),
    )


DUCK = {
    "txn": """txn AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS account_id,
         regexp_extract(props, '"k": ([0-9]+)', 1) AS merchant_id,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE event_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' ELSE 'VND' END AS currency,
         event_type AS type,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'flagged'
              WHEN 'view' THEN 'pending' ELSE 'completed' END AS status,
         props AS description, ts AS created_at, ts AS updated_at, epoch_us(ts) // 1000 AS source_ts_ms,
         ts + to_milliseconds(event_id % 5000) AS ingested_at, event_id, user_id
  FROM events)""",
    "log": """log AS (
  SELECT account_id || '-' || type AS id, account_id, merchant_id, amount, currency, type, status, description,
         created_at, source_ts_ms, ingested_at, event_id AS off,
         CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS cdc_op
  FROM txn)""",
    "newest": """newest AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_ts_ms DESC, off DESC) = 1)""",
    "merchants": """merchants AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS category,
         CASE WHEN s_acctbal < 1000 THEN 'high' WHEN s_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_level
  FROM supplier)""",
    "accounts": """accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS full_name,
         'c' || CAST(CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) || '@example.com' AS email,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'VND' AS currency,
         CASE WHEN c_custkey % 10 = 0 THEN 'suspended' ELSE 'active' END AS status, c_mktsegment AS category,
         TIMESTAMP '2023-01-01 00:00:00' + to_minutes(c_custkey) AS created_at, c_custkey
  FROM customer)""",
    "alerts": """alerts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS account_id,
         CASE o_orderkey % 6 WHEN 0 THEN 'VELOCITY' WHEN 1 THEN 'LARGE_AMT' WHEN 2 THEN 'MULTI_CCY'
              WHEN 3 THEN 'ZSCORE' WHEN 4 THEN 'HIGH_RISK' ELSE 'FAIL_SPIKE' END AS rule_code,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high'
              WHEN '3' THEN 'medium' ELSE 'low' END AS severity,
         CAST(o_orderkey % 20 + 1 AS INTEGER) AS txn_count, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed_fraud' ELSE 'closed_clean' END AS status,
         TIMESTAMP '2024-01-31 00:00:00' - to_seconds((o_orderkey * 7919) % 2592000) AS created_at,
         CASE o_orderkey % 6
           WHEN 0 THEN '{"window_seconds":' || (o_orderkey % 300) || ',"txn_types":[{"value":"purchase","n":2},{"value":"transfer","n":1}]}'
           WHEN 1 THEN '{"txn_id":"txn-000' || o_orderkey || '","currency":"VND","type":"transfer"}'
           WHEN 2 THEN '{"currencies":["EUR","USD","VND"],"currency_count":' || (o_orderkey % 3 + 3) || '}'
           WHEN 3 THEN '{"z_score":' || (o_orderkey % 9 + 3) || '.25,"avg_amount":' || o_orderkey || '.5,"std_amount":12,"txn_count_30d":31}'
           WHEN 4 THEN '{"merchant_name":"Supplier ' || o_orderkey || '","risk_level":"high"}'
           ELSE 'unreadable evidence of case ' || o_orderkey END AS evidence,
         o_orderkey, o_totalprice
  FROM orders)""",
}
# the same views over the transactions that the stored log leaves: all but every tenth
LIVE = DUCK["txn"].replace("txn AS (", "every AS (", 1) + ",\ntxn AS (SELECT * FROM every WHERE event_id % 10 <> 9)"
NEEDS = {"log": ("txn",), "newest": ("log",)}


def with_views(body: str, *views: str, extra: tuple[str, ...] = (), recursive: bool = False) -> str:
    """SQL text with the named adapter views in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    parts = [DUCK[v] for v in ordered] + list(extra)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body
