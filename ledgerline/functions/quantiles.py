"""Exact quantiles that do not gather the rows.

Values are counted first (combining on the map side); the final step then holds
one entry per distinct value, which for millisecond measurements is limited by
the largest value and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_freq"))


def interpolated(value: str, probability: float) -> Column:
    """Linearly interpolated quantile over :func:`value_counts` rows."""
    return F.percentile(value, F.lit(probability), F.col("_freq"))

