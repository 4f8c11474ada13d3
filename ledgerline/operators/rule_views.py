"""The rules as their views show them, their history per minute, and the live feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timing import Instant, minute, stamp_text, trailing
from ledgerline.functions.values import plain_number
from ledgerline.operators.rules import (
    account_activity,
    all_rule_flags,
    large_amount_flags,
    multi_currency_flags,
    risky_merchants,
    rule_flags,
    union_all,
    velocity_flags,
    zscore_flags,
)
from ledgerline.params import FEED, HighRisk, LargeAmount, RuleSet

# ---- fixed values: rule numbers of the views, limits of the history and the feed ----
RULE_IDS = {
    "R1": "VELOCITY",
    "R2": "ZSCORE",
    "R3": "LARGE_AMT",
    "R4": "HIGH_RISK",
    "R5": "MULTI_CCY",
    "R6": "FAIL_SPIKE",
}
HISTORY_MINUTES = (1, 360)
HISTORY_DEFAULT_MINUTES = 30
HISTORY_ZSCORE_PROXY = 50_000_000
FEED_LIMIT = 50
# -------------------------------------------------------------------------------------


def view_columns(code: str, flags: DataFrame) -> DataFrame:
    """Display columns of one rule: amounts as doubles, times as text, lists joined."""
    money = F.col("amount").cast("double").alias("amount") if "amount" in flags.columns else None
    if code == "VELOCITY":
        return flags.select(
            "account_id",
            "txn_count",
            "total_amount",
            stamp_text("window_start").alias("window_start"),
            stamp_text("window_end").alias("window_end"),
        )
    if code == "ZSCORE":
        return flags.select(
            F.col("id").alias("txn_id"),
            "account_id",
            money,
            "type",
            stamp_text("created_at").alias("created_at"),
            "avg_amount",
            "std_amount",
            "z_score",
        )
    if code == "LARGE_AMT":
        return flags.select(
            "id",
            "account_id",
            "merchant_id",
            money,
            "currency",
            "type",
            "status",
            stamp_text("created_at").alias("ts"),
        )
    if code == "HIGH_RISK":
        return flags.select(
            "id",
            "account_id",
            money,
            "type",
            stamp_text("created_at").alias("created_at"),
            "merchant_name",
            "risk_level",
        )
    if code == "MULTI_CCY":
        return flags.select(
            "account_id",
            F.array_join("currencies", ",").alias("currencies"),
            "currency_count",
            "txn_count",
            stamp_text("first_txn").alias("first_txn"),
            stamp_text("last_txn").alias("last_txn"),
        )
    return flags.select("account_id", "failed_count", "total_count", "fail_rate_pct")


def rule_view(
    rule_id: str, txns: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True
) -> DataFrame:
    """Display rows of one view ('R1'..'R6')."""
    code = RULE_IDS[rule_id]
    return view_columns(code, rule_flags(code, txns, merchants, as_of, rules, upper_bound))


def rule_views(
    txns: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True
) -> dict[str, DataFrame]:
    """View id ('R1'..'R6') -> display rows, the account rules from one aggregation."""
    flags = all_rule_flags(txns, merchants, as_of, rules, upper_bound)
    return {rid: view_columns(code, flags[code]) for rid, code in RULE_IDS.items()}


def rule_view_counts(views: dict[str, DataFrame]) -> DataFrame:
    """Flagged rows per view, a view without any included with 0."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("flagged")).select(F.lit(rid).alias("rule_id"), "flagged")
        for rid, rows in views.items()
    ]
    return union_all(parts)


def rule_history(
    txns: DataFrame,
    merchants: DataFrame,
    as_of: Instant,
    minutes: int = HISTORY_DEFAULT_MINUTES,
    large: LargeAmount = LargeAmount(),
    risk: HighRisk = HighRisk(),
    zscore_proxy: float = HISTORY_ZSCORE_PROXY,
    upper_bound: bool = True,
    clamp: bool = True,
) -> DataFrame:
    """(rule_id, bucket, flags): one scan counted per minute and merchant, then split by rule.

    R1 and R5 count every transaction and R6 the failed ones; R2 counts amounts
    above a fixed limit in place of the z-score. `clamp=False` lifts the
    6-hour limit of the display.
    """
    lowest, highest = HISTORY_MINUTES
    span = max(lowest, min(highest, int(minutes))) if clamp else int(minutes)
    recent = txns.where(trailing("created_at", as_of, span * 60, upper_bound))

    def above(limit: float):
        return F.count_if(F.col("amount") > F.lit(limit).cast("decimal(18,2)"))

    per_merchant = recent.groupBy(minute("created_at").alias("bucket"), "merchant_id").agg(
        F.count(F.lit(1)).alias("n"),
        above(zscore_proxy).alias("n_proxy"),
        above(large.max_amount).alias("n_large"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    risky = risky_merchants(merchants, risk).select("merchant_id", F.lit(True).alias("risky"))
    marked = per_merchant.join(risky, "merchant_id", "left")
    per_minute = marked.groupBy("bucket").agg(
        F.sum("n").alias("R1"),
        F.sum("n_proxy").alias("R2"),
        F.sum("n_large").alias("R3"),
        F.sum(F.when(F.col("risky"), F.col("n")).otherwise(0)).alias("R4"),
        F.sum("n_failed").alias("R6"),
    )
    long = per_minute.withColumn("R5", F.col("R1")).unpivot("bucket", list(RULE_IDS), "rule_id", "flags")
    # a minute without a matching row has no point, except in R6, which counts within all rows
    return long.where((F.col("flags") > 0) | (F.col("rule_id") == "R6"))


def feed_branches(
    txns: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = FEED, upper_bound: bool = True
) -> dict[str, DataFrame]:
    """The six parts of the live feed, each with its own windows, severities and text."""

    def entry(code: str, severity: str, rows: DataFrame, at: str, message) -> DataFrame:
        return rows.select(
            F.lit(code).alias("rule"),
            F.lit(severity).alias("severity"),
            F.col("account_id").alias("subject"),
            F.unix_millis(at).alias("detected_at_ms"),
            message.alias("message"),
        )

    activity = account_activity(
        txns, as_of, rules.velocity, rules.multi_currency, rules.fail_spike, upper_bound
    )
    burst = velocity_flags(activity, rules.velocity)
    currencies = multi_currency_flags(activity, rules.multi_currency)
    large = large_amount_flags(txns, as_of, rules.large_amount, upper_bound)
    outliers = zscore_flags(txns, as_of, rules.zscore, upper_bound)
    spike = rules.fail_spike
    # here the unrounded rate is compared
    failing = activity.where(
        (F.col("f_failed") >= spike.min_failed)
        & (F.try_divide(F.col("f_failed"), F.col("f_n")) > spike.max_rate_pct / 100)
    )
    risk = rules.high_risk
    per_merchant = (
        txns.where(trailing("created_at", as_of, risk.window_s, upper_bound))
        .groupBy("account_id", "merchant_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("last"))
    )
    routed = (
        per_merchant.join(risky_merchants(merchants, risk), "merchant_id")
        .groupBy("account_id")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.min("merchant_name").alias("merchant_name"))
    )

    def text(c) -> F.Column:
        return c.cast("string")

    return {
        "VELOCITY": entry(
            "VELOCITY",
            "high",
            burst,
            "window_end",
            F.concat(
                text(F.col("txn_count")),
                F.lit(" txns, "),
                plain_number(F.col("total_amount") / 1e6, 1),
                F.lit("M VND in 5 min"),
            ),
        ),
        "LARGE_AMT": entry(
            "LARGE_AMT",
            "high",
            large,
            "created_at",
            F.concat(
                F.lit("Single txn "),
                plain_number(F.col("amount").cast("double") / 1e6, 1),
                F.lit("M "),
                F.col("currency"),
            ),
        ),
        "MULTI_CCY": entry(
            "MULTI_CCY",
            "medium",
            currencies,
            "last_txn",
            F.concat(
                text(F.col("currency_count")),
                F.lit(" currencies in 10 min: "),
                F.array_join("currencies", ","),
            ),
        ),
        "ZSCORE": entry(
            "ZSCORE",
            "medium",
            outliers,
            "created_at",
            F.concat(
                F.lit("z="),
                plain_number(F.col("z"), 1),
                F.lit(" vs 30d avg "),
                plain_number(F.col("avg_amount") / 1e3, 0),
                F.lit("k"),
            ),
        ),
        "HIGH_RISK": entry(
            "HIGH_RISK",
            "high",
            routed,
            "last",
            F.concat(text(F.col("n")), F.lit(" txns to high-risk merchant: "), F.col("merchant_name")),
        ),
        "FAIL_SPIKE": entry(
            "FAIL_SPIKE",
            "high",
            failing,
            "f_last",
            F.concat(
                text(F.col("f_failed")),
                F.lit("/"),
                text(F.col("f_n")),
                F.lit(" failed ("),
                plain_number(F.col("f_failed") / F.col("f_n") * 100, 0),
                F.lit("% fail rate, 30 min)"),
            ),
        ),
    }


def alert_feed(
    txns: DataFrame,
    merchants: DataFrame,
    as_of: Instant,
    rules: RuleSet = FEED,
    limit: int = FEED_LIMIT,
    upper_bound: bool = True,
) -> DataFrame:
    """The newest detections of all rules, newest first."""
    rows = union_all(list(feed_branches(txns, merchants, as_of, rules, upper_bound).values()))
    return rows.orderBy(F.desc("detected_at_ms"), "rule", "subject", "message").limit(limit)
