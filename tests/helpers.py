"""Small literal inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

AS_OF = "2024-05-01 12:00:00"
TXN = (
    "id string, account_id string, merchant_id string, amount decimal(18,2), currency string, type string, "
    "status string, created_at timestamp"
)


def txns(spark, rows):
    """Rows of (id, account, amount, seconds before AS_OF, overrides)."""
    out = []
    for row in rows:
        tid, account, amount, age, *rest = row
        more = rest[0] if rest else {}
        out.append(
            (
                str(tid),
                account,
                more.get("merchant_id", "m1"),
                str(amount),
                more.get("currency", "VND"),
                more.get("type", "purchase"),
                more.get("status", "completed"),
                float(age),
            )
        )
    raw = spark.createDataFrame(
        out, "id string, account_id string, merchant_id string, amount string, currency string, type string, status string, age double"
    )
    at = f"timestamp_micros(unix_micros(TIMESTAMP '{AS_OF}') - CAST(age * 1000000 AS BIGINT))"
    return raw.selectExpr(
        "id", "account_id", "merchant_id", "CAST(amount AS DECIMAL(18,2)) AS amount", "currency", "type", "status", f"{at} AS created_at"
    )


def merchants(spark):
    rows = [("m1", "Corner Shop", "grocery", "low"), ("m9", "Night Casino", "gambling", "high")]
    return spark.createDataFrame(rows, "id string, name string, category string, risk_level string")


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def same(left, right):
    """Equal as multisets of rows."""
    columns = left.columns
    return left.exceptAll(right.select(*columns)).isEmpty() and right.select(*columns).exceptAll(left).isEmpty()


def hot(spark, n, account="hot"):
    """Transactions of which a third belong to one account."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, account).otherwise(F.concat(F.lit("a"), (F.col("id") % 97).cast("string"))).alias("account_id"),
        F.lit("m1").alias("merchant_id"),
        ((F.col("id") * 7919) % 1000 / 10 + F.when(F.col("id") % 211 == 0, 900).otherwise(0)).cast("decimal(18,2)").alias("amount"),
        F.lit("VND").alias("currency"),
        F.lit("purchase").alias("type"),
        F.lit("completed").alias("status"),
        F.expr(f"TIMESTAMP '{AS_OF}' - make_dt_interval(0, 0, 0, id % 500)").alias("created_at"),
    )
