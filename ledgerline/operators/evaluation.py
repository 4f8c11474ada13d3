"""Scoring the rules against labelled accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.params import POSITIVE_LABELS


def rule_confusion(labels: DataFrame, flagged: DataFrame, positives: dict[str, tuple[str, ...]] = POSITIVE_LABELS) -> DataFrame:
    """TP / FP / FN / TN per rule over labelled accounts (account_id, label; NULL label = clean).

    `flagged` has (rule_code, account_id). Each label is a positive for the rules
    the mapping lists it under. Every account is read once: which rules flagged it
    comes as a small set, joined by account, and the six verdicts are counted from it.
    """
    per_account = flagged.groupBy("account_id").agg(F.collect_set("rule_code").alias("fired"))
    judged = labels.join(per_account, "account_id", "left")
    verdicts = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule_code"),
                F.coalesce(F.array_contains("fired", rule), F.lit(False)).alias("hit"),
                F.coalesce(F.col("label").isin(*sources), F.lit(False)).alias("positive"),
            )
            for rule, sources in positives.items()
        ]
    )
    each = judged.select(F.explode(verdicts).alias("v")).select("v.*")

    def cell(hit: bool, positive: bool) -> Column:
        return F.count_if((F.col("hit") == hit) & (F.col("positive") == positive))

    return each.groupBy("rule_code").agg(
        cell(True, True).alias("tp"),
        cell(True, False).alias("fp"),
        cell(False, True).alias("fn"),
        cell(False, False).alias("tn"),
    )


def rule_scores(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 per rule; NULL where undefined."""
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    scored = confusion.withColumns({"precision": precision, "recall": recall})
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1)


def rule_macro_f1(scores: DataFrame) -> DataFrame:
    """One row: mean of the defined F1 values and how many are defined."""
    return scores.agg(F.avg("f1").alias("macro_f1"), F.count("f1").alias("rules_scored"))


def rules_firing(flagged: DataFrame, rule_codes: tuple[str, ...]) -> DataFrame:
    """Every rule with its number of flagged rows and whether it fires at all."""
    spark = flagged.sparkSession
    codes = spark.createDataFrame([(c,) for c in rule_codes], "rule_code string")
    counts = flagged.groupBy("rule_code").agg(F.count(F.lit(1)).alias("n"))
    return codes.join(counts, "rule_code", "left").select(
        "rule_code", F.coalesce("n", F.lit(0)).alias("flagged"), F.col("n").isNotNull().alias("fires")
    )
