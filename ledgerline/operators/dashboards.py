"""Dashboard series and pipeline health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.quantiles import interpolated, value_counts
from ledgerline.functions.timing import (
    Instant,
    before,
    instant,
    just_ingested,
    millis_between,
    minute,
    trailing,
)
from ledgerline.functions.values import exact_avg, exact_sum, round_even
from ledgerline.params import DAY, HOUR, MINUTE, Velocity

LAG = "lag_ms"


def volume_per_minute(txns: DataFrame, as_of: Instant, window_s: int = HOUR, upper_bound: bool = True) -> DataFrame:
    """Count, sum, failed and flagged transactions per minute."""
    return (
        txns.where(trailing("created_at", as_of, window_s, upper_bound))
        .groupBy(minute("created_at").alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            exact_sum("amount").alias("total_amount"),
            F.count_if(F.col("status") == "failed").alias("failed_count"),
            F.count_if(F.col("status") == "flagged").alias("flagged_count"),
        )
        .orderBy("minute")
    )


def txn_per_minute(
    txns: DataFrame,
    as_of: Instant | None = None,
    window_s: int = HOUR,
    start: Instant | None = None,
    end: Instant | None = None,
    upper_bound: bool = True,
) -> DataFrame:
    """Count per minute over the trailing window, or between two instants, both included."""
    if start is not None and end is not None:
        rows = txns.where((F.col("created_at") >= instant(start)) & (F.col("created_at") <= instant(end)))
    else:
        rows = txns.where(trailing("created_at", as_of, window_s, upper_bound))
    return rows.groupBy(minute("created_at").alias("time")).agg(F.count(F.lit(1)).alias("txn_count")).orderBy("time")


def amount_per_minute(txns: DataFrame, as_of: Instant, window_s: int = HOUR, upper_bound: bool = True) -> DataFrame:
    rows = txns.where(trailing("created_at", as_of, window_s, upper_bound))
    per_minute = rows.groupBy(minute("created_at").alias("time"))
    return per_minute.agg(exact_sum("amount").alias("total_amount")).orderBy("time")


def type_breakdown(txns: DataFrame, as_of: Instant, window_s: int = DAY, upper_bound: bool = True) -> DataFrame:
    """Count, sum and mean per transaction type, largest count first."""
    return (
        txns.where(trailing("created_at", as_of, window_s, upper_bound))
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            exact_sum("amount").alias("total_amount"),
            exact_avg("amount").alias("avg_amount"),
        )
        .orderBy(F.desc("txn_count"), "type")
    )


def status_mix(txns: DataFrame, as_of: Instant, window_s: int = HOUR, upper_bound: bool = True) -> DataFrame:
    rows = txns.where(trailing("created_at", as_of, window_s, upper_bound))
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "status")


def top_merchants(
    txns: DataFrame,
    merchants: DataFrame,
    as_of: Instant,
    window_s: int = DAY,
    limit: int = 20,
    by_risk: bool = True,
    upper_bound: bool = True,
) -> DataFrame:
    """Largest merchants by amount; `by_risk=False` groups by name and category only.

    Amounts are summed per merchant id before the names are joined, so a merchant
    with very many payments joins as one row.
    """
    per_id = (
        txns.where(trailing("created_at", as_of, window_s, upper_bound) & F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    )
    keys = ["name", "category", "risk_level"] if by_risk else ["name", "category"]
    named = per_id.join(merchants.select(F.col("id").alias("merchant_id"), *keys), "merchant_id")
    return (
        named.groupBy(*keys)
        .agg(F.sum("n").alias("txn_count"), exact_sum("total").alias("total_amount"))
        .orderBy(F.desc("total_amount"), *keys)
        .limit(limit)
    )


def ingestion_lag(log: DataFrame, as_of: Instant, window_s: int = HOUR, upper_bound: bool = True) -> DataFrame:
    """Rows and mean / largest delay from creation to ingestion per ingest minute."""
    return (
        log.where(trailing("_ingested_at", as_of, window_s, upper_bound))
        .select(minute("_ingested_at").alias("ingested_minute"), millis_between("created_at", "_ingested_at").alias(LAG))
        .groupBy("ingested_minute")
        .agg(
            F.count(F.lit(1)).alias("rows_ingested"),
            exact_avg(LAG).alias("avg_lag_ms"),
            F.max(LAG).alias("max_lag_ms"),
        )
        .orderBy("ingested_minute")
    )


def pipeline_lag(log: DataFrame) -> DataFrame:
    """Adds the delay from commit to ingestion in milliseconds."""
    return log.withColumn(LAG, F.unix_millis("_ingested_at") - F.col("_source_ts_ms"))


def latency_quantiles(log: DataFrame, start: Instant, end: Instant, exact: bool = True) -> DataFrame:
    """p50 / p95 / p99 delay per ingest minute, exact or with a bounded rank error."""
    rows = pipeline_lag(log.where((F.col("_ingested_at") >= instant(start)) & (F.col("_ingested_at") <= instant(end))))
    rows = rows.select(minute("_ingested_at").alias("time"), LAG)
    points = "array(0.50D, 0.95D, 0.99D)"
    if exact:
        # one entry per distinct delay and minute, then one pass for all three points
        grouped = value_counts(rows, LAG, ["time"]).groupBy("time")
        quantiles = grouped.agg(F.expr(f"percentile({LAG}, {points}, _freq) AS q"))
    else:
        quantiles = rows.groupBy("time").agg(F.expr(f"percentile_approx({LAG}, {points}, 10000) AS q"))
    return quantiles.selectExpr("time", "q[0] AS p50_ms", "q[1] AS p95_ms", "q[2] AS p99_ms").orderBy("time")


def lag_histogram(
    log: DataFrame, as_of: Instant, window_s: int = MINUTE, limit: int = 10, upper_bound: bool = True
) -> DataFrame:
    """Number of rows per delay, largest delays first."""
    rows = pipeline_lag(log.where(trailing("_ingested_at", as_of, window_s, upper_bound)))
    return (
        rows.groupBy(F.col(LAG).alias("pipeline_lag_ms"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("pipeline_lag_ms"))
        .limit(limit)
    )


def txn_latency(state: DataFrame, condition=None) -> DataFrame:
    """End-to-end delay of each selected row."""
    rows = state if condition is None else state.where(condition)
    return rows.select(
        "id",
        F.col("_source_ts_ms").alias("source_ts_ms"),
        F.unix_millis("_ingested_at").alias("ingested_ms"),
        (F.unix_millis("_ingested_at") - F.col("_source_ts_ms")).alias("e2e_latency_ms"),
    )


def health_summary(
    state: DataFrame, as_of: Instant, window_s: int = 5 * MINUTE, rate_s: int = 5, tz: str = "UTC"
) -> DataFrame:
    """One row: mean and p95 delay, current rate, rows created today, sample size.

    One scan serves both the recent sample and the day's total; the day is that
    of `as_of` in time zone `tz`, as two instants that reach the scan.
    """
    day = F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(instant(as_of), F.current_timezone()), tz))

    def midnight(date):
        return F.from_utc_timestamp(F.to_utc_timestamp(date.cast("timestamp"), tz), F.current_timezone())

    sampled = just_ingested("_ingested_at", as_of, window_s)
    today = (F.col("created_at") >= midnight(day)) & (F.col("created_at") < midnight(F.date_add(day, 1)))
    counted = (
        state.where(sampled | today)
        .select(
            F.when(sampled, millis_between("created_at", "_ingested_at")).alias(LAG),
            (sampled & (F.col("_ingested_at") > before(as_of, rate_s))).alias("now"),
            sampled.alias("sampled"),
            today.alias("today"),
        )
        .groupBy(LAG)
        .agg(
            F.count(F.lit(1)).alias("_freq"),
            F.count_if("now").alias("now"),
            F.count_if("sampled").alias("sampled"),
            F.count_if("today").alias("today"),
        )
    )
    measured = F.sum(F.when(F.col(LAG).isNotNull(), F.col("_freq")))
    return counted.agg(
        round_even(F.try_divide(F.sum(F.col(LAG) * F.col("_freq")), measured), 0).alias("avg_latency_ms"),
        round_even(interpolated(LAG, 0.95), 0).alias("p95_latency_ms"),
        round_even(F.coalesce(F.sum("now"), F.lit(0)) / F.lit(float(rate_s)), 1).alias("tps_now"),
        F.coalesce(F.sum("today"), F.lit(0)).alias("total_today"),
        F.coalesce(F.sum("sampled"), F.lit(0)).alias("sample_rows"),
    )


def tps_series(state: DataFrame, as_of: Instant, seconds: int = 60) -> DataFrame:
    """Rows ingested per second, seconds without rows included with 0.

    The fill covers `as_of - seconds` up to but not including `as_of`; a row in
    the last second itself still gives its own point.
    """
    second = F.floor(F.unix_millis("_ingested_at") / 1000).cast("bigint").alias("t")
    seen = (
        state.where(just_ingested("_ingested_at", as_of, seconds)).groupBy(second).agg(F.count(F.lit(1)).alias("tps"))
    )
    spark = state.sparkSession
    end = F.unix_timestamp(instant(as_of))
    fill = spark.range(seconds).select((end - seconds + F.col("id")).alias("t"), F.lit(0).cast("bigint").alias("tps"))
    return seen.unionByName(fill).groupBy("t").agg(F.sum("tps").alias("tps")).orderBy("t")


def events_last_minute(state: DataFrame, as_of: Instant, window_s: int = MINUTE) -> DataFrame:
    rows = state.where(just_ingested("_ingested_at", as_of, window_s))
    return rows.agg(F.count(F.lit(1)).alias("events_last_minute"))


def panel_velocity(
    txns: DataFrame, as_of: Instant, params: Velocity = Velocity(), upper_bound: bool = True
) -> DataFrame:
    """The velocity rule without its lists: one aggregation, one exchange."""
    return (
        txns.where(trailing("created_at", as_of, params.window_s, upper_bound))
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            exact_sum("amount").alias("total_amount"),
            F.min("created_at").alias("window_start"),
            F.max("created_at").alias("window_end"),
        )
        .where((F.col("txn_count") > params.max_count) | (F.col("total_amount") > params.max_total))
        .orderBy(F.desc("txn_count"), "account_id")
    )


def latency_summary(samples: DataFrame, warmup: int = 3, target_ms: float = 5000) -> DataFrame:
    """One row over latency samples (sample_no, e2e_latency_ms).

    The first `warmup` samples and those that timed out (not positive) are left out.
    """
    value = "e2e_latency_ms"
    measured = samples.where((F.col("sample_no") >= warmup) & (F.col(value) > 0))
    # percentile() counts equal values before they are exchanged
    return measured.agg(
        F.count(value).alias("samples"),
        F.min(value).alias("min_ms"),
        F.avg(value).alias("avg_ms"),
        F.percentile(value, F.lit(0.50)).alias("median_ms"),
        F.when(F.count(value) > 1, F.stddev_samp(value)).otherwise(F.lit(0.0)).alias("stddev_ms"),
        F.percentile(value, F.lit(0.95)).alias("p95_ms"),
        F.percentile(value, F.lit(0.99)).alias("p99_ms"),
        F.max(value).alias("max_ms"),
        F.try_divide(F.count_if(F.col(value) <= target_ms), F.count(value)).alias("within_target"),
    )


def throughput_summary(batches: DataFrame, warmup_rows: int) -> DataFrame:
    """One row over batch timings (inserted_after, rows, started_ms, ended_ms).

    `inserted_after` is the running total after the batch. Batches that end within
    the warm-up rows are left out of the measured figures. The p95 is the value
    at position floor(0.95 n) of the sorted durations, counted from 0.
    """
    batch_ms = F.col("ended_ms") - F.col("started_ms")
    b = batches.withColumn("batch_ms", batch_ms)
    measured = F.col("inserted_after") > warmup_rows
    kept = F.when(measured, F.col("batch_ms"))
    elapsed = F.max("ended_ms") - F.min("started_ms")
    warm_end = F.min(F.when(F.col("inserted_after") >= warmup_rows, F.col("ended_ms")))
    measured_elapsed = F.max("ended_ms") - warm_end
    # just above 0.95, so that a whole-numbered 0.95 n selects the next position
    p95 = F.expr(
        f"percentile_disc(0.95000000001D) WITHIN GROUP (ORDER BY IF(inserted_after > {int(warmup_rows)}, batch_ms, NULL))"
    )
    return b.agg(
        F.sum("rows").alias("total_rows"),
        (F.sum("rows") - warmup_rows).alias("measured_rows"),
        F.try_divide(F.sum("rows") * 1000.0, elapsed).alias("burst_tps"),
        F.coalesce(F.try_divide((F.sum("rows") - warmup_rows) * 1000.0, measured_elapsed), F.lit(0.0)).alias("sustained_tps"),
        F.count(kept).alias("batches_measured"),
        F.min(kept).alias("batch_ms_min"),
        F.avg(kept).alias("batch_ms_avg"),
        p95.alias("batch_ms_p95"),
        F.max(kept).alias("batch_ms_max"),
    )
