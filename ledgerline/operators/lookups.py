"""Entity views: transactions, accounts and merchants as pages ask for them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.skew import salted_join
from ledgerline.functions.timing import Instant, stamp_text
from ledgerline.functions.values import UUID_PATTERN
from ledgerline.operators.alerts import open_alerts_24h
from ledgerline.operators.state import latest_state

# ---- fixed values: page sizes ----
LIVE_ROWS, SINCE_ROWS, HISTORY_ROWS = 20, 100, 20
SEARCH_DEFAULT, SEARCH_MAX = 50, 200
HIGHLIGHT_ABOVE = 100_000_000
# ----------------------------------


def live_transactions(txns: DataFrame, accounts: DataFrame, merchants: DataFrame, limit: int = LIVE_ROWS) -> DataFrame:
    """Newest transactions with account and merchant names; the rows are limited before the joins."""
    newest = txns.orderBy(F.desc("_source_ts_ms"), "id").limit(limit)
    who = accounts.select(F.col("id").alias("account_id"), F.col("full_name").alias("account_name"))
    where = merchants.select(
        F.col("id").alias("merchant_id"),
        F.col("name").alias("merchant_name"),
        F.col("category").alias("merchant_category"),
        F.col("risk_level").alias("merchant_risk"),
    )
    return (
        newest.join(who, "account_id", "left")
        .join(where, "merchant_id", "left")
        .select(
            "id",
            "amount",
            "currency",
            "type",
            "status",
            stamp_text("created_at").alias("created_at"),
            F.col("_source_ts_ms").alias("source_ts_ms"),
            stamp_text("_ingested_at").alias("ingested_at"),
            "account_name",
            "merchant_name",
            "merchant_category",
            "merchant_risk",
        )
    )


def within(limit: int, most: int) -> int:
    """A page size, refused if it is out of range rather than changed."""
    if not 1 <= int(limit) <= most:
        raise ValueError(f"limit must be 1 to {most}")
    return int(limit)


def cursor_value(cursor: str | int | None) -> tuple[int, str | None]:
    """(commit time, id) of a cursor `time:id`; the time alone for a first page; anything else starts from 0."""
    time, colon, last = (str(cursor) if cursor is not None else "").partition(":")
    return (int(time), last if colon else None) if time.isascii() and time.isdigit() else (0, None)


def transactions_since(
    txns: DataFrame, cursor: str | int | None, limit: int = SINCE_ROWS, highlight_above: float = HIGHLIGHT_ABOVE
) -> DataFrame:
    """The next rows after a cursor, oldest first, large amounts marked.

    The next cursor is `source_ts_ms:id` of the last row, so rows of one
    millisecond that do not fit on a page come on the next.
    """
    amount = F.col("amount")
    time, last = cursor_value(cursor)
    after = F.col("_source_ts_ms") > time
    if last is not None:
        after = (F.col("_source_ts_ms") >= time) & (after | (F.col("id") > last))
    return (
        txns.where(after)
        .orderBy("_source_ts_ms", "id")
        .limit(limit)
        .select(
            "id",
            "account_id",
            amount.cast("double").alias("amount"),
            "currency",
            "type",
            "status",
            F.col("_source_ts_ms").alias("source_ts_ms"),
            F.when(amount > F.lit(highlight_above).cast("decimal(18,2)"), 1).otherwise(0).alias("is_fraud"),
        )
    )


def since_from_log(
    log: DataFrame, cursor: str | int | None, limit: int = SINCE_ROWS, highlight_above: float = HIGHLIGHT_ABOVE
) -> DataFrame:
    """The same page from the stored versions.

    Versions before the cursor are left out before the newest are chosen, which changes nothing: the newest version of a
    row on the page comes after the cursor itself. The bound reaches the scan.
    """
    time, _ = cursor_value(cursor)
    return transactions_since(latest_state(log.where(F.col("_source_ts_ms") >= time)), cursor, limit, highlight_above)


def live_from_log(
    log: DataFrame, accounts: DataFrame, merchants: DataFrame, as_of_ms: int, limit: int = LIVE_ROWS, window_ms: int = 60_000
) -> DataFrame:
    """The newest transactions up to an instant, from the stored versions.

    Looks back a minute, and eight times as far until enough rows are found or everything was seen: the newest rows
    are those of the newest versions, so a time that holds enough of them holds all that are wanted.
    """
    until = log.where(F.col("_source_ts_ms") <= as_of_ms)
    while window_ms < as_of_ms:
        recent = latest_state(until.where(F.col("_source_ts_ms") > as_of_ms - window_ms))
        if recent.limit(limit).count() == limit:
            return live_transactions(recent, accounts, merchants, limit)
        window_ms *= 8
    return live_transactions(latest_state(until), accounts, merchants, limit)


def require_uuid(value: str) -> str:
    if not re.match(UUID_PATTERN, value):
        raise ValueError("invalid uuid")
    return value


def transaction_by_id(txns: DataFrame, txn_id: str, validate: bool = True) -> DataFrame:
    """One transaction with its commit and ingest times in milliseconds."""
    wanted = require_uuid(txn_id) if validate else txn_id
    return (
        txns.where(F.col("id") == wanted)
        .limit(1)
        .select(
            "id",
            "account_id",
            "merchant_id",
            F.col("amount").cast("double").alias("amount"),
            "currency",
            "type",
            "status",
            "description",
            stamp_text("created_at").alias("created_at"),
            F.col("_source_ts_ms").alias("source_ts_ms"),
            stamp_text("_ingested_at").alias("ingested_at"),
            F.unix_millis("_ingested_at").alias("ingested_at_ms"),
            "cdc_op",
        )
    )


def active_accounts(accounts: DataFrame) -> DataFrame:
    rows = accounts.where(F.col("status") == "active")
    return rows.select("id", "full_name", "email", "status").orderBy("full_name", "id")


def account_search(
    accounts: DataFrame, alerts: DataFrame, as_of: Instant, q: str = "", limit: int = SEARCH_DEFAULT
) -> DataFrame:
    """Accounts whose name or e-mail contains the text, with their open cases of 24 hours.

    The page is cut before the cases are joined.
    """
    text = q.strip().lower()
    rows = accounts
    if text:
        rows = rows.where(F.lower("full_name").contains(text) | F.lower("email").contains(text))
    page = rows.orderBy("full_name", "id").limit(within(limit, SEARCH_MAX))
    cases = open_alerts_24h(alerts, as_of).withColumnRenamed("account_id", "id")
    return page.join(cases, "id", "left").select(
        "id",
        "full_name",
        "email",
        F.col("balance").cast("double").alias("balance"),
        "status",
        F.coalesce("open_alerts_24h", F.lit(0)).alias("open_alerts_24h"),
    )


def account_by_id(accounts: DataFrame, account_id: str, validate: bool = True) -> DataFrame:
    wanted = require_uuid(account_id) if validate else account_id
    return (
        accounts.where(F.col("id") == wanted)
        .limit(1)
        .select(
            "id",
            "full_name",
            "email",
            "phone",
            F.col("balance").cast("double").alias("balance"),
            "currency",
            "status",
            "created_at",
            "updated_at",
        )
    )


def newest_per_account(rows: DataFrame, limit: int) -> DataFrame:
    """The newest rows of every account; each map task passes on at most `limit` per account."""
    w = W.partitionBy("account_id").orderBy(F.desc("created_at"), "id")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def account_transactions(
    txns: DataFrame, merchants: DataFrame, account_id: str | None = None, limit: int = HISTORY_ROWS
) -> DataFrame:
    """Last transactions of one account, or of every account, with merchant names."""
    if account_id is None:
        rows = newest_per_account(txns, limit)
    else:
        rows = txns.where(F.col("account_id") == account_id).orderBy(F.desc("created_at"), "id").limit(limit)
    names = merchants.select(F.col("id").alias("merchant_id"), F.col("name").alias("merchant_name"))
    # top-ups have no merchant, and a popular one has very many rows
    named = rows.join(names, "merchant_id", "left") if account_id else salted_join(rows, names, "merchant_id", tie="id", how="left")
    return named.select(
        "account_id",
        "id",
        "type",
        "status",
        F.col("amount").cast("double").alias("amount"),
        "currency",
        "description",
        "merchant_name",
        "created_at",
    )


def account_alerts(alerts: DataFrame, account_id: str | None = None, limit: int = HISTORY_ROWS) -> DataFrame:
    """Last cases of one account, or of every account."""
    if account_id is None:
        rows = newest_per_account(alerts, limit)
    else:
        rows = alerts.where(F.col("account_id") == account_id).orderBy(F.desc("created_at"), "id").limit(limit)
    return rows.select(
        "account_id",
        "id",
        "rule_code",
        "severity",
        "txn_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        "status",
        "evidence",
        "created_at",
    )


def merchant_list(merchants: DataFrame) -> DataFrame:
    return merchants.select("id", "name", "category", "risk_level").orderBy("name", "id")

