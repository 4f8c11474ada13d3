"""Registered queries: intents and the balance ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import intents as I
from ledgerline.operators import ledger as B
from ledgerline.operators.state import latest_state
from ledgerline.schemas import TRANSACTIONS
from ledgerline.session import shared_dir
from ledgerline.sources.logs import append_versions, read_log
from workload import adapters as A
from workload.adapters import out, with_views

FLOW_SQL = """flow AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id, ts AS "at", CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_id % 23 = 0 THEN 'suspend' WHEN event_id % 23 = 1 THEN 'reactivate' WHEN event_id % 11 = 0 THEN 'topup' ELSE 'txn' END AS kind,
    CASE event_type WHEN 'signup' THEN 'refund' WHEN 'view' THEN 'transfer' ELSE 'purchase' END AS type,
    CAST(value * 3 AS DECIMAL(18,2)) AS amount, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS intent,
    regexp_extract(props, '"k": ([0-9]+)', 1) AS merchant_id,
    CASE event_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' ELSE 'VND' END AS currency, props AS description FROM events)"""
OPENING_SQL = """numbered AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY "at", id) AS n FROM flow),
opening AS (SELECT id AS account_id, CAST((CAST(abs(balance) * 100 AS BIGINT) // 4) / 100.0 AS DECIMAL(18,2)) AS balance, status,
    CASE WHEN c_custkey % 3 = 0 THEN 'USD' ELSE 'VND' END AS account_currency FROM accounts WHERE c_custkey % 15 <> 14)"""
EVENTS_SQL = f"{FLOW_SQL},\n{OPENING_SQL}"

# One step per event in account order; an unknown account has neither balance nor status.
FOLD_SQL = """fold AS (
  SELECT a.account_id, CAST(0 AS BIGINT) AS n, o.balance, o.status AS state, CAST(NULL AS TIMESTAMP) AS "at", CAST(NULL AS VARCHAR) AS id,
    CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS type, CAST(NULL AS DECIMAL(18,2)) AS amount,
    CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS txn_status, CAST(NULL AS VARCHAR) AS reason,
    CAST(NULL AS VARCHAR) AS merchant_id, CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS VARCHAR) AS description
  FROM (SELECT DISTINCT account_id FROM flow) a LEFT JOIN opening o ON o.account_id = a.account_id
  UNION ALL
  SELECT e.account_id, e.n,
    CASE WHEN f.state IS NULL THEN NULL
         WHEN f.state = 'active' AND e.kind = 'topup' AND e.amount > 0 THEN CAST(f.balance + e.amount AS DECIMAL(18,2))
         WHEN f.state = 'active' AND e.kind = 'txn' AND e.intent <> 'failed' AND e.type = 'refund' THEN CAST(f.balance + e.amount AS DECIMAL(18,2))
         WHEN f.state = 'active' AND e.kind = 'txn' AND e.intent <> 'failed' AND f.balance >= e.amount THEN CAST(f.balance - e.amount AS DECIMAL(18,2))
         ELSE f.balance END,
    CASE WHEN e.kind = 'suspend' AND f.state = 'active' THEN 'suspended'
         WHEN e.kind = 'reactivate' AND f.state = 'suspended' THEN 'active' ELSE f.state END,
    e."at", e.id, e.kind, e.type, e.amount,
    CASE WHEN e.kind = 'topup' AND e.amount <= 0 THEN 'V' WHEN f.state IS NULL THEN 'M'
         WHEN e.kind = 'txn' THEN CASE WHEN f.state <> 'active' THEN 'R' WHEN e.intent = 'failed' THEN 'F'
              WHEN e.type <> 'refund' AND f.balance < e.amount THEN 'I' ELSE 'C' END
         WHEN e.kind = 'topup' THEN CASE WHEN f.state <> 'active' THEN 'X' ELSE 'C' END
         WHEN e.kind = 'suspend' THEN CASE WHEN f.state = 'active' THEN 'C' ELSE 'X' END
         ELSE CASE WHEN f.state = 'suspended' THEN 'C' ELSE 'X' END END,
    CASE WHEN f.state IS NULL THEN NULL
         WHEN e.kind = 'txn' THEN CASE WHEN f.state <> 'active' OR e.intent = 'failed' OR (e.type <> 'refund' AND f.balance < e.amount) THEN 'failed' ELSE 'completed' END
         WHEN e.kind = 'topup' AND e.amount > 0 AND f.state = 'active' THEN 'completed' END,
    CASE WHEN e.kind = 'topup' AND e.amount <= 0 THEN 'amount must be > 0' WHEN f.state IS NULL THEN 'account not found'
         WHEN e.kind = 'txn' THEN CASE WHEN f.state <> 'active' THEN 'rejected: account ' || f.state WHEN e.intent = 'failed' THEN NULL
              WHEN e.type <> 'refund' AND f.balance < e.amount THEN 'insufficient funds' END
         WHEN e.kind = 'topup' THEN CASE WHEN f.state <> 'active' THEN 'cannot top up account in status ''' || f.state || '''' END
         WHEN e.kind = 'suspend' THEN CASE WHEN f.state <> 'active' THEN 'not_active' END
         ELSE CASE WHEN f.state <> 'suspended' THEN 'not_suspended' END END,
    e.merchant_id, e.currency, e.description
  FROM fold f JOIN numbered e ON e.account_id = f.account_id AND e.n = f.n + 1),
decided AS (SELECT account_id, "at", id, kind, type, CAST(amount AS DOUBLE) AS amount, outcome, txn_status IS NOT NULL AS recorded,
    txn_status AS status, reason, CAST(balance AS DOUBLE) AS balance_after, state AS account_status, merchant_id, currency, description, n FROM fold WHERE n > 0)"""

# what enters the transactions table: a reason replaces the description, a top-up takes its account's currency
RECORDED_SQL = """recorded_rows AS (SELECT id, d.account_id, CASE WHEN kind <> 'topup' THEN merchant_id END AS merchant_id, amount,
    coalesce(CASE WHEN kind = 'topup' THEN account_currency ELSE currency END, 'VND') AS currency,
    CASE WHEN kind = 'topup' THEN 'deposit' ELSE type END AS type, d.status,
    CASE WHEN kind = 'topup' THEN 'Top up via UI' ELSE coalesce(reason, description) END AS description, "at" AS created_at
  FROM decided d LEFT JOIN opening o ON o.account_id = d.account_id WHERE recorded)"""


def ledger(s, d):
    return B.apply_ledger(A.ledger_events(s, d), A.ledger_accounts(s, d))


def topups(s, d):
    """Top-ups with what they leave in the transactions table."""
    decided = ledger(s, d).where(F.col("kind") == "topup")
    rows = B.recorded_transactions(decided, A.ledger_accounts(s, d)).select("id", "type", "currency", "description")
    shown = decided.select("account_id", "at", "id", "amount", "outcome", "recorded", "status", "reason", "balance_after", "account_status")
    return shown.join(rows, "id", "left")


def intents_to_log(s, d):
    """Submitted intents, merchants by name, the ledger, and the rows it records as versions in the stored log; the state read back."""
    valid = I.validate_intents(A.intents(s, d)).where("reason IS NULL")
    known = I.resolve_merchant(valid, A.merchants(s, d)).where("reason IS NULL")
    events = known.selectExpr(
        "account_id", "at", "id", "'txn' AS kind", "type", "CAST(amount AS DECIMAL(18,2)) AS amount", "'completed' AS intent", *B.CARRIED
    )
    accounts = A.ledger_accounts(s, d).withColumn("id", F.expr(A.as_uuid("id")))
    rows = B.recorded_transactions(B.apply_ledger(events, accounts), accounts)
    versions = rows.selectExpr(
        *rows.columns, "created_at AS updated_at", "'c' AS cdc_op", "unix_millis(created_at) AS _source_ts_ms", "CAST(id AS BIGINT) AS _offset"
    )
    path = f"{shared_dir(s)}/log-{uuid.uuid4().hex}"
    append_versions(versions, path, "ledger", 0)
    return latest_state(read_log(s, path, TRANSACTIONS)).select(*rows.columns)


def fold_sql(body, *more, flow=FLOW_SQL):
    return with_views(body, "accounts", extra=(f"{flow},\n{OPENING_SQL}", FOLD_SQL, *more), recursive=True)


INTENTS_SQL = """intents AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id,
    CASE WHEN event_id % 11 = 0 THEN 'acct-' || user_id ELSE '00000000-0000-4000-8000-' || lpad(CAST(user_id AS VARCHAR), 12, '0') END AS account_id,
    CASE WHEN event_id % 17 = 0 THEN 'GBP' WHEN event_id % 17 = 1 THEN 'VND' ELSE 'USD' END AS currency,
    CASE event_type WHEN 'error' THEN 'theft' ELSE 'purchase' END AS type,
    CASE WHEN event_id % 19 = 0 OR event_id % 3 = 0 THEN '' WHEN event_id % 19 = 1 THEN 'm-1' ELSE '00000000-0000-4000-8000-000000000007' END AS merchant_id,
    CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'Supplier#' || lpad(CAST(user_id % 130 AS VARCHAR), 9, '0') END AS merchant, value
  FROM events),
reasons AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'account_id must be a UUID'
    WHEN event_id % 13 IN (0, 1) OR CAST(value AS DECIMAL(18,2)) <= 0 THEN 'amount must be > 0'
    WHEN currency = 'GBP' THEN 'currency must be one of VND,USD,EUR,JPY,THB'
    WHEN type = 'theft' THEN 'type must be one of purchase,transfer,withdrawal,deposit,refund'
    WHEN event_id % 19 = 0 THEN 'merchant_id or merchant (name) is required'
    WHEN merchant_id = 'm-1' THEN 'merchant_id must be a UUID' END AS reason FROM intents)"""

# the flow of acceptable intents; their accounts are written as UUIDs
INTENT_FLOW = f"""{INTENTS_SQL.replace("merchant, value", 'merchant, value, ts AS "at", CAST(user_id AS VARCHAR) AS plain_id', 1)},
flow AS (SELECT plain_id AS account_id, "at", r.id, 'txn' AS kind, type, CAST(value AS DECIMAL(18,2)) AS amount, 'completed' AS intent,
    CASE WHEN merchant_id <> '' THEN merchant_id ELSE m.id END AS merchant_id, currency, 'Demo from UI' AS description
  FROM reasons r LEFT JOIN (SELECT name, min(id) AS id FROM merchants GROUP BY name) m ON m.name = r.merchant
  WHERE reason IS NULL AND (merchant_id <> '' OR m.id IS NOT NULL))"""

QUERIES = {
    "intents_to_log": (
        lambda s, d: out(intents_to_log(s, d)),
        with_views(
            "SELECT * REPLACE ('00000000-0000-4000-8000-' || lpad(account_id, 12, '0') AS account_id) FROM recorded_rows",
            "accounts",
            "merchants",
            extra=(f"{INTENT_FLOW},\n{OPENING_SQL}", FOLD_SQL, RECORDED_SQL),
            recursive=True,
        ),
    ),
    "validate_intents": (
        lambda s, d: out(I.validate_intents(A.intents(s, d)).select("id", "currency", "type", "reason")),
        with_views("SELECT id, currency, type, reason FROM reasons", extra=(INTENTS_SQL,)),
    ),
    "resolve_merchant": (
        lambda s, d: out(
            I.resolve_merchant(I.validate_intents(A.intents(s, d)).where("reason IS NULL"), A.merchants(s, d)).select(
                "id", "merchant_id", "reason"
            )
        ),
        with_views(
            "SELECT r.id, CASE WHEN r.merchant_id <> '' THEN r.merchant_id ELSE m.id END AS merchant_id, "
            "CASE WHEN r.merchant_id = '' AND m.id IS NULL THEN 'merchant not found: ' || r.merchant END AS reason "
            "FROM reasons r LEFT JOIN (SELECT name, min(id) AS id FROM merchants GROUP BY name) m ON m.name = r.merchant WHERE r.reason IS NULL",
            "merchants",
            extra=(INTENTS_SQL,),
        ),
    ),
    "apply_ledger": (lambda s, d: out(ledger(s, d)), fold_sql("SELECT * EXCLUDE (n) FROM decided")),
    "apply_topup": (
        lambda s, d: out(topups(s, d)),
        fold_sql(
            "SELECT d.account_id, \"at\", d.id, d.amount, outcome, recorded, d.status, reason, balance_after, account_status, "
            "r.type, r.currency, r.description FROM decided d LEFT JOIN recorded_rows r ON r.id = d.id WHERE kind = 'topup'",
            RECORDED_SQL,
        ),
    ),
    "apply_status_commands": (
        lambda s, d: out(ledger(s, d).where(F.col("kind").isin("suspend", "reactivate"))),
        fold_sql("SELECT * EXCLUDE (n) FROM decided WHERE kind IN ('suspend', 'reactivate')"),
    ),
    "ledger_outcome_counts": (
        lambda s, d: out(B.ledger_outcome_counts(ledger(s, d))),
        fold_sql(
            "SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'C') AS completed, count(*) FILTER (WHERE outcome = 'R') AS rejected, "
            "count(*) FILTER (WHERE outcome = 'I') AS insufficient, count(*) FILTER (WHERE outcome = 'M') AS missing, count(*) FILTER (WHERE outcome = 'F') AS declined, "
            "CAST(count(*) FILTER (WHERE outcome = 'C') AS DOUBLE) / count(*) AS completion_rate FROM decided WHERE kind = 'txn'"
        ),
    ),
    "ledger_transactions": (
        lambda s, d: out(B.recorded_transactions(ledger(s, d), A.ledger_accounts(s, d))),
        fold_sql("SELECT * FROM recorded_rows", RECORDED_SQL),
    ),
    "closing_balances": (
        lambda s, d: out(B.closing_balances(ledger(s, d), A.ledger_accounts(s, d))),
        fold_sql(
            "SELECT o.account_id AS id, coalesce(l.balance_after, CAST(o.balance AS DOUBLE)) AS balance, coalesce(l.account_status, o.status) AS status "
            "FROM opening o LEFT JOIN (SELECT * FROM decided QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY n DESC) = 1) l ON l.account_id = o.account_id"
        ),
    ),
}
