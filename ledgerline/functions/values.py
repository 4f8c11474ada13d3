"""Money, rounding and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: identifier pattern and severity order ----
UUID_PATTERN = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}
# -------------------------------------------------------------


def exact_sum(col: str | Column) -> Column:
    """Sum money as decimals and give a double: exact, whatever the order of rows."""
    return F.sum(col).cast("double")


def exact_avg(col: str) -> Column:
    """Mean over the non-null values of a decimal column, as a double."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def round_even(col: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(col, digits)


def plain_number(col: Column, digits: int) -> Column:
    """Number as text without exponent and without trailing zeros ('12.5', '7')."""
    text = F.bround(col, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "") if digits else text


def is_uuid(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).rlike(UUID_PATTERN)


def severity_rank(col: str | Column) -> Column:
    """1 (low) to 4 (critical); 0 for anything else."""
    c = F.col(col) if isinstance(col, str) else col
    ranked = F.lit(0)
    for name, rank in SEVERITY_RANK.items():
        ranked = F.when(c == name, F.lit(rank)).otherwise(ranked)
    return ranked


def severity_name(rank: Column) -> Column:
    """Inverse of :func:`severity_rank`; an unknown rank reads as 'low'."""
    named = F.lit("low")
    for name, value in SEVERITY_RANK.items():
        named = F.when(rank == value, F.lit(name)).otherwise(named)
    return named


def spelled_out(counts: Column) -> Column:
    """Expand counted values [(value, n), ...] into the flat list they stand for."""
    return F.flatten(F.transform(counts, lambda c: F.array_repeat(c["value"], c["n"].cast("int"))))


def counts_text(counts: Column) -> Column:
    """Counted values as text: 'purchase=3,transfer=1'."""
    return F.array_join(F.transform(counts, lambda c: F.concat(c["value"], F.lit("="), c["n"].cast("string"))), ",")
