"""Registered queries: messages, typing, checks, versions, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import rules as R
from ledgerline.operators import state as S
from ledgerline.operators import typing as Y
from ledgerline.schemas import MERCHANTS, TRANSACTIONS
from ledgerline.schemas import FRAUD_ALERTS as ALERTS
from ledgerline.sources import changes as C
from workload import adapters as A
from workload.adapters import AS_OF, RULES, out, with_views
from workload.rule_queries import T

STATE_COLUMNS = ("id", "account_id", "merchant_id", "amount", "currency", "type", "status", "cdc_op", "_source_ts_ms", "_offset")
STATE_SQL = (
    "id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, cdc_op, "
    "source_ts_ms AS _source_ts_ms, off AS _offset"
)

# What typing makes of the messages: empty times fall back to the commit time,
# digits are epoch milliseconds.
TYPED = """typed AS (
  SELECT id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, currency, type, status, description,
    CASE WHEN event_id % 4 = 0 OR event_id % 5 = 0 THEN make_timestamp(source_ts_ms * 1000) ELSE created_at END AS created_at,
    created_at AS updated_at,
    CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS cdc_op,
    source_ts_ms AS _source_ts_ms, event_id // 6 AS _offset, event_id
  FROM txn)"""
TYPED_COLUMNS = (
    "id",
    "account_id",
    "merchant_id",
    "amount",
    "currency",
    "type",
    "status",
    "description",
    "created_at",
    "updated_at",
    "cdc_op",
    "_source_ts_ms",
    "_offset",
)


def typed(s, d):
    good, _ = C.split_corrupt(C.parse_flat(A.wire_records(s, d), TRANSACTIONS))
    return Y.type_transactions(good)


def split(s, d):
    good, dead = C.split_corrupt(C.parse_flat(A.wire_records(s, d, broken=True), TRANSACTIONS))
    readable = good.agg(F.lit("readable").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("string").alias("sample"))
    broken = dead.agg(F.lit("dead").alias("kind"), F.count(F.lit(1)).alias("n"), F.max(C.CORRUPT).alias("sample"))
    return out(readable.unionByName(broken))


def unwrapped(s, d):
    flat = C.unwrap_envelope(A.envelopes(s, d), TRANSACTIONS)
    return out(
        flat.select(
            "id",
            "account_id",
            "amount",
            "type",
            "created_at",
            F.col("__deleted").alias("deleted"),
            F.col("__op").alias("op"),
            F.col("__table").alias("tab"),
            F.col("__source_ts_ms").alias("ts_ms"),
            F.col("_offset").alias("off"),
        )
    )


def typed_accounts(s, d):
    """Customers through the message form: amounts and times as text, no creation time on some."""
    a = A.accounts(s, d)
    k = F.col("id").cast("bigint")
    flat = a.select(
        "id",
        "full_name",
        "email",
        "phone",
        F.when(k % 31 == 0, "").otherwise(F.col("balance").cast("string")).alias("balance"),
        "currency",
        "status",
        F.when(k % 4 == 0, "").otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"),
        F.lit("r").alias("__op"),
        F.lit(1700000000123).alias("__source_ts_ms"),
    )
    return out(Y.type_accounts(flat))


def typed_merchants(s, d):
    m = A.merchants(s, d)
    flat = m.select(
        "id",
        "name",
        "category",
        F.lit("5411").alias("mcc_code"),
        "risk_level",
        F.lit("VN").alias("country"),
        F.lit("2024-01-01T05:00:00+07:00").alias("created_at"),
        F.lit("1700000000123").alias("updated_at"),
        F.lit("c").alias("__op"),
        F.lit(1700000000999).alias("__source_ts_ms"),
    )
    return out(Y.type_merchants(flat))


def typed_alerts(s, d):
    a = A.alerts(s, d)
    k = F.col("id").cast("bigint")
    text = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    flat = a.select(
        "id",
        "account_id",
        "rule_code",
        "severity",
        F.when(k % 37 == 0, "many").otherwise(F.col("txn_count").cast("string")).alias("txn_count"),
        F.col("total_amount").cast("string").alias("total_amount"),
        "evidence",
        "status",
        "notes",
        text.alias("created_at"),
        F.when(k % 2 == 0, "").otherwise(text).alias("resolved_at"),
        F.lit("c").alias("__op"),
        F.lit(1700000000999).alias("__source_ts_ms"),
    )
    return out(Y.type_alerts(flat).drop("evidence"))


def domains(s, d):
    rows = A.txn(s, d).withColumn("currency", F.when(F.col("id").cast("bigint") % 21 == 0, F.lit(None)).otherwise(F.col("currency")))
    checked = Y.check_domains(rows, TRANSACTIONS)
    return out(checked.select("id", F.array_join("violations", ",").alias("violations")))


def defaults(s, d):
    """Alerts with gaps, filled from the table defaults."""
    k = F.col("id").cast("bigint")
    gaps = A.alerts(s, d).withColumns(
        {
            c: F.when(k % n == 0, F.lit(None)).otherwise(F.col(c))
            for c, n in {"txn_count": 3, "total_amount": 5, "evidence": 7, "status": 11}.items()
        }
    )
    return out(Y.apply_defaults(gaps, ALERTS).select("id", "txn_count", "total_amount", "evidence", "status"))


def touched(s, d):
    log = A.cdc_log(s, d).withColumn("updated_at", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    return out(Y.touch_updated_at(log).select("_offset", "cdc_op", "updated_at"))


def snapshot(s, d):
    """Accounts and a change log of accounts (every seventh changes its status later)."""
    base = A.accounts(s, d).select("id", "full_name", "balance", "status")
    changes = (
        base.where(F.col("id").cast("bigint") % 7 == 0)
        .withColumns({"status": F.lit("closed"), "cdc_op": F.lit("u"), "_source_ts_ms": F.lit(1700000005000)})
    )
    return C.snapshot_as_log(base, changes, 1700000000000)


def reconciled(s, d):
    """Source rows against the state rebuilt from the log, for three tables."""
    a, m = A.accounts(s, d), A.merchants(s, d)
    log = A.cdc_log(s, d)
    states = {"accounts": S.latest_state(snapshot(s, d)), "merchants": m, "transactions": S.latest_state(log)}
    sources = {"accounts": a, "merchants": m, "transactions": log.select("id").distinct()}
    return out(S.reconcile_counts(sources, states))


def arrived(s, d):
    accounts = A.accounts(s, d).where(F.col("status") == "active").select(F.col("id").alias("account_id"))
    since = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return out(S.arrived_count(A.txn(s, d), F.col("description").like('%"k": 1%'), accounts, since))


def compacted(s, d):
    """State rebuilt from the compacted log: equal to the state of the whole log."""
    return out(S.latest_state(S.compact_log(A.cdc_log(s, d), 202402)).select(*STATE_COLUMNS))


def flagship(s, d):
    """Messages, typing, current state, velocity rule in one plan."""
    state = S.latest_state(typed(s, d))
    rows = R.rule_velocity(state, AS_OF, RULES.velocity)
    return out(rows.select("account_id", "txn_count", "total_amount", "window_start", "window_end"))


QUERIES = {
    "messages_to_velocity": (
        flagship,
        with_views(
            "SELECT account_id, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total_amount, min(created_at) AS window_start, max(created_at) AS window_end "
            f"FROM typed WHERE cdc_op <> 'd' AND created_at >= {T} - INTERVAL 1 DAY AND created_at <= {T} "
            "GROUP BY account_id HAVING count(*) > 5 OR sum(amount) > 300",
            "txn",
            extra=(TYPED.replace("CAST(amount AS DOUBLE) AS amount", "amount"),),
        ),
    ),
    "split_corrupt": (
        split,
        "SELECT 'readable' AS kind, count(*) AS n, NULL AS sample FROM events WHERE event_id % 97 <> 5 AND event_id % 89 <> 7 "
        "UNION ALL SELECT 'dead', count(*), '{bad' FROM events WHERE event_id % 97 = 5",
    ),
    "drop_unknown_fields": (
        lambda s, d: out(
            C.drop_unknown_fields(A.wire_records(s, d), TRANSACTIONS).select("id", "amount", "currency", "created_at", F.col("__op").alias("op"))
        ),
        """SELECT CAST(event_id AS VARCHAR) AS id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  CASE event_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' ELSE 'VND' END AS currency,
  CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 5 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS created_at,
  CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS op FROM events""",
    ),
    "unwrap_envelope": (
        unwrapped,
        """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS account_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  event_type AS type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS created_at,
  CASE WHEN event_id % 10 = 9 THEN 'true' ELSE 'false' END AS deleted,
  CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 3 = 0 THEN 'u' ELSE 'c' END AS op,
  'transactions' AS tab, epoch_us(ts) // 1000 AS ts_ms, event_id // 6 AS off FROM events WHERE event_id % 89 <> 7""",
    ),
    "snapshot_as_log": (
        lambda s, d: out(snapshot(s, d)),
        with_views(
            "SELECT id, full_name, CAST(balance AS DOUBLE) AS balance, status, 'r' AS cdc_op, 1700000000000 AS _source_ts_ms FROM accounts "
            "UNION ALL SELECT id, full_name, CAST(balance AS DOUBLE), 'closed', 'u', 1700000005000 FROM accounts WHERE c_custkey % 7 = 0",
            "accounts",
        ),
    ),
    "type_transactions": (
        lambda s, d: out(typed(s, d).select(*TYPED_COLUMNS)),
        with_views("SELECT * EXCLUDE (event_id) FROM typed", "txn", extra=(TYPED,)),
    ),
    "type_accounts": (
        typed_accounts,
        with_views(
            "SELECT id, full_name, email, CAST(NULL AS VARCHAR) AS phone, CASE WHEN c_custkey % 31 <> 0 THEN CAST(balance AS DOUBLE) END AS balance, "
            "currency, status, CASE WHEN c_custkey % 4 = 0 THEN make_timestamp(1700000000123000) ELSE created_at END AS created_at, "
            "make_timestamp(1700000000123000) AS updated_at, 'r' AS cdc_op, 1700000000123 AS _source_ts_ms FROM accounts",
            "accounts",
        ),
    ),
    "type_merchants": (
        typed_merchants,
        with_views(
            "SELECT id, name, category, '5411' AS mcc_code, risk_level, 'VN' AS country, TIMESTAMP '2023-12-31 22:00:00' AS created_at, "
            "make_timestamp(1700000000123000) AS updated_at, 'c' AS cdc_op, 1700000000999 AS _source_ts_ms FROM merchants",
            "merchants",
        ),
    ),
    "type_alerts": (
        typed_alerts,
        with_views(
            "SELECT id, account_id, rule_code, severity, CASE WHEN o_orderkey % 37 <> 0 THEN txn_count END AS txn_count, "
            "CAST(total_amount AS DOUBLE) AS total_amount, status, CAST(NULL AS VARCHAR) AS notes, created_at, "
            "CASE WHEN o_orderkey % 2 = 1 THEN created_at END AS resolved_at, 'c' AS cdc_op, 1700000000999 AS _source_ts_ms FROM alerts",
            "alerts",
        ),
    ),
    "check_domains": (
        domains,
        with_views(
            "SELECT id, concat_ws(',', CASE WHEN event_id % 21 = 0 THEN 'currency_null' END, "
            "CASE WHEN type NOT IN ('purchase','transfer','withdrawal','refund','deposit') THEN 'type_domain' END, "
            "CASE WHEN status NOT IN ('pending','completed','failed','flagged') THEN 'status_domain' END) AS violations FROM txn",
            "txn",
        ),
    ),
    "check_domains_merchants": (
        lambda s, d: out(
            Y.check_domains(A.merchants(s, d), MERCHANTS).select("id", F.size("violations").alias("broken"))
        ),
        with_views("SELECT id, 0 AS broken FROM merchants", "merchants"),
    ),
    "check_unique_email": (
        lambda s, d: out(Y.check_unique_email(A.accounts(s, d))),
        with_views("SELECT email, count(*) AS uses FROM accounts GROUP BY email HAVING count(*) > 1", "accounts"),
    ),
    "check_foreign_keys": (
        lambda s, d: out(
            Y.check_foreign_keys(A.txn(s, d), A.merchants(s, d), "merchant_id")
            .select(F.lit("merchant_id").alias("col"), F.col("merchant_id").alias("missing"), "rows")
            .unionByName(
                Y.check_foreign_keys(A.alerts(s, d), A.accounts(s, d).where(F.col("status") == "active"), "account_id").select(
                    F.lit("account_id").alias("col"), F.col("account_id").alias("missing"), "rows"
                )
            )
        ),
        with_views(
            "SELECT 'merchant_id' AS col, merchant_id AS missing, count(*) AS rows FROM txn WHERE merchant_id NOT IN (SELECT id FROM merchants) GROUP BY 2 "
            "UNION ALL SELECT 'account_id', account_id, count(*) FROM alerts WHERE account_id NOT IN (SELECT id FROM accounts WHERE status = 'active') GROUP BY 2",
            "txn",
            "merchants",
            "alerts",
            "accounts",
        ),
    ),
    "orphan_rows": (
        lambda s, d: out(
            Y.orphan_rows(A.txn(s, d), A.merchants(s, d), "merchant_id").select("id", "account_id", "merchant_id", "amount", "created_at")
        ),
        with_views(
            "SELECT id, account_id, merchant_id, CAST(amount AS DOUBLE) AS amount, created_at FROM txn WHERE merchant_id NOT IN (SELECT id FROM merchants)",
            "txn",
            "merchants",
        ),
    ),
    "orphan_alerts": (
        lambda s, d: out(
            Y.orphan_rows(A.alerts(s, d), A.accounts(s, d).where(F.col("status") == "active"), "account_id").select("id", "account_id", "rule_code")
        ),
        with_views(
            "SELECT id, account_id, rule_code FROM alerts WHERE account_id NOT IN (SELECT id FROM accounts WHERE status = 'active')",
            "alerts",
            "accounts",
        ),
    ),
    "apply_defaults": (
        defaults,
        with_views(
            "SELECT id, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE txn_count END AS txn_count, "
            "CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE CAST(total_amount AS DOUBLE) END AS total_amount, "
            "CASE WHEN o_orderkey % 7 = 0 THEN '{}' ELSE evidence END AS evidence, CASE WHEN o_orderkey % 11 = 0 THEN 'open' ELSE status END AS status FROM alerts",
            "alerts",
        ),
    ),
    "touch_updated_at": (
        touched,
        with_views(
            "SELECT off AS _offset, cdc_op, CASE WHEN cdc_op = 'u' THEN make_timestamp(source_ts_ms * 1000) ELSE TIMESTAMP '2020-01-01 00:00:00' END AS updated_at FROM log",
            "log",
        ),
    ),
    "latest_state": (
        lambda s, d: out(S.latest_state(A.cdc_log(s, d)).select(*STATE_COLUMNS)),
        with_views(f"SELECT {STATE_SQL} FROM newest WHERE cdc_op <> 'd'", "newest"),
    ),
    "latest_state_sort_key": (
        # the reference key of transactions: account, creation time and id together
        lambda s, d: out(S.latest_state(A.cdc_log(s, d), key=("account_id", "created_at", "id")).select(*STATE_COLUMNS)),
        with_views(f"SELECT {STATE_SQL} FROM log WHERE cdc_op <> 'd'", "log"),
    ),
    "row_versions": (
        lambda s, d: out(S.row_versions(A.cdc_log(s, d), F.col("amount") > 100).select(*STATE_COLUMNS)),
        with_views(f"SELECT {STATE_SQL} FROM log WHERE amount > 100", "log"),
    ),
    "deleted_rows": (
        lambda s, d: out(S.deleted_rows(A.cdc_log(s, d)).select(*STATE_COLUMNS)),
        with_views(f"SELECT {STATE_SQL} FROM newest WHERE cdc_op = 'd'", "newest"),
    ),
    "multi_version_ids": (
        lambda s, d: out(S.multi_version_ids(A.cdc_log(s, d))),
        with_views(
            "SELECT count(*) FILTER (WHERE n > 1) AS multi_version_keys, count(*) AS total_keys FROM (SELECT id, count(*) AS n FROM log GROUP BY id)", "log"
        ),
    ),
    "raw_vs_final_counts": (
        lambda s, d: out(S.raw_vs_final_counts(A.cdc_log(s, d), tie=("_offset",))),
        with_views(
            "SELECT (SELECT count(*) FROM log) AS raw_rows, (SELECT count(*) FROM newest WHERE cdc_op <> 'd') AS final_rows", "newest"
        ),
    ),
    "reconcile_counts": (
        reconciled,
        with_views(
            "SELECT 'accounts' AS table_name, count(*) AS source_rows, count(*) AS state_rows, true AS matches FROM accounts "
            "UNION ALL SELECT 'merchants', count(*), count(*), true FROM merchants "
            "UNION ALL SELECT 'transactions', count(*), count(*) FILTER (WHERE cdc_op <> 'd'), count(*) = count(*) FILTER (WHERE cdc_op <> 'd') FROM newest",
            "newest",
            "accounts",
            "merchants",
        ),
    ),
    "arrived_count": (
        arrived,
        with_views(
            "SELECT count(*) AS arrived, count(*) FILTER (WHERE ingested_at > TIMESTAMP '2024-01-20 00:00:00') AS arrived_recently FROM txn "
            "WHERE description LIKE '%\"k\": 1%' AND account_id IN (SELECT id FROM accounts WHERE status = 'active')",
            "txn",
            "accounts",
        ),
    ),
    "distinct_types": (
        lambda s, d: out(S.distinct_types(A.txn(s, d))),
        with_views("SELECT DISTINCT type FROM txn", "txn"),
    ),
    "compact_log": (
        compacted,
        with_views(f"SELECT {STATE_SQL} FROM newest WHERE cdc_op <> 'd'", "newest"),
    ),
    "table_freshness": (
        lambda s, d: out(S.table_freshness(A.txn(s, d))),
        with_views("SELECT count(*) AS rows, max(ingested_at) AS last_ingested_at FROM txn", "txn"),
    ),
}
