"""Delay quantiles of any range from stored sketches, one a minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timing import Instant, instant, minute
from ledgerline.operators.dashboards import LAG, pipeline_lag

PRECISION = 800  # of a sketch: its rank error is below 0.5 % at this setting
RANK_ERROR = 0.005


def delay_sketches(log: DataFrame, precision: int = PRECISION) -> DataFrame:
    """(minute, rows, sketch): a mergeable sketch of the delays of each ingest minute, of a few kilobytes whatever the minute's rows.

    Stored once a minute is over, these rows answer for it; a minute with late rows is made again. Rows without an
    ingest or commit time are left out.
    """
    rows = pipeline_lag(log).where(f"_ingested_at IS NOT NULL AND {LAG} IS NOT NULL")
    return rows.groupBy(minute("_ingested_at").alias("minute")).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint(LAG, F.lit(precision)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, start: Instant, end: Instant, probabilities: Sequence[float] = (0.5, 0.95, 0.99), by_s: int | None = None) -> DataFrame:
    """Quantiles of the delays of all minutes from `start` to before `end`, or of every `by_s` seconds of them.

    Only sketches are read: an hour is answered from 60 rows. The rank of each value is within RANK_ERROR of the asked one.
    Columns: time (the range's start), rows, and for each probability p50_ms and so on. An empty range gives no row.
    """
    wanted = sketches.where((F.col("minute") >= instant(start)) & (F.col("minute") < instant(end)))
    time = F.window("minute", f"{by_s} seconds")["start"] if by_s else instant(start)
    merged = wanted.groupBy(time.alias("time")).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("sketch").alias("s"))
    names = [f"p{p * 100:g}_ms".replace(".", "_") for p in probabilities]
    quantiles = [F.kll_sketch_get_quantile_bigint("s", F.lit(float(p))).alias(n) for p, n in zip(probabilities, names)]
    return merged.select("time", "rows", *quantiles).orderBy("time")
