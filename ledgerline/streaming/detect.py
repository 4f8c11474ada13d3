"""Continuous detection: exact passes over the current state, or event-time windows."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.values import round_even
from ledgerline.operators.alerts import new_cases
from ledgerline.params import RuleSet
from ledgerline.plans.detection import alert_tick, run_alert_tick
from ledgerline.sources.logs import alert_sink, writer_name
from ledgerline.streaming.ingest import start

LOG = logging.getLogger(__name__)
INTERVAL = "30 seconds"
PANE_S = 30  # seconds of event time counted together


def stream_detect(
    arrivals: DataFrame,
    load_state: Callable[[], tuple[DataFrame, DataFrame, DataFrame, DataFrame]],
    alert_path: str,
    checkpoint: str,
    as_of: Callable[[DataFrame], object] | None = None,
    rules: RuleSet = RuleSet(),
    override_s: int | None = None,
    trigger: str | None = INTERVAL,
    on_error: Callable[[int, str, str], None] | None = None,
) -> StreamingQuery:
    """Run a detection pass for every batch of arrivals, by default every 30 seconds.

    `load_state` gives (transactions, merchants, accounts, alerts) as they are
    now. `as_of` derives the instant of the pass from the batch; without it the
    newest creation time in the batch is used, which makes a replay repeat the same
    passes. A pass that is run again replaces its own cases.

    All rules run in one pass over the state. Where that fails, the rules run one by one, so a rule
    that cannot run is logged (and told to `on_error` as (batch, rule, text)) while the cases of the others are
    stored. Only a pass in which every rule fails stops the stream.
    """
    writer = writer_name(checkpoint)

    def newest(batch: DataFrame):
        return batch.agg(F.max("created_at").cast("string").alias("t")).first()["t"]

    def run(batch: DataFrame, batch_id: int) -> None:
        at = (as_of or newest)(batch)
        if at is None:
            return
        txns, merchants, accounts, alerts = load_state()
        # cases this very batch wrote before a failure must not suppress its repetition
        own = F.col("writer").startswith(writer) & (F.col("batch_id") == batch_id)
        earlier = alerts.where(~own) if {"writer", "batch_id"} <= set(alerts.columns) else alerts
        try:
            decided = alert_tick(txns, merchants, accounts, earlier, at, rules, override_s)
            alert_sink(new_cases(decided, at), alert_path, writer, batch_id)
        except (PySparkException, Py4JJavaError) as problem:
            LOG.warning("batch %d: running its rules one by one, as the joint pass failed: %s", batch_id, problem)
            store = lambda cases, code: alert_sink(cases, alert_path, writer, batch_id)
            report = run_alert_tick(txns, merchants, accounts, earlier, at, store, rules, override_s)
            failed = [r for r in report if "error" in r]
            for r in failed:
                if on_error:
                    on_error(batch_id, r["rule_code"], r["error"])
            if len(failed) == len(report):
                raise

    return start(arrivals.writeStream.foreachBatch(run), checkpoint, trigger)


def _panes(txns: DataFrame, pane_s: int, *columns: Column) -> DataFrame:
    """Cells of `pane_s` seconds of an account: each row is in one."""
    return txns.groupBy(F.window("created_at", f"{pane_s} seconds"), "account_id").agg(F.count(F.lit(1)).alias("n"), *columns)


def _merged(panes: DataFrame, window_s: int, pane_s: int, *columns: Column) -> DataFrame:
    """Windows that slide by a pane, from the panes in them."""
    if window_s % pane_s:
        raise ValueError(f"a window of {window_s} seconds is not made of panes of {pane_s}")
    sliding = F.window(F.window_time("window"), f"{window_s} seconds", f"{pane_s} seconds")
    return panes.groupBy(sliding.alias("window"), "account_id").agg(F.sum("n").alias("n"), *columns)


def rule_windows(txns: DataFrame, rules: RuleSet = RuleSet(), pane_s: int = PANE_S) -> dict[str, DataFrame]:
    """The account rules over event-time windows that slide by `pane_s`, from stored rows or a stream with a watermark.

    Windows start at multiples of the pane and exclude their end. A row is counted into one pane, and only panes
    are repeated for the windows they are in, so a busy account costs no more in a long window than in a short one.
    """

    def flat(rows: DataFrame, code: str, *columns: str) -> DataFrame:
        return rows.select(
            F.lit(code).alias("rule_code"),
            "account_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *columns,
        )

    v, m, f = rules.velocity, rules.multi_currency, rules.fail_spike
    burst = _merged(_panes(txns, pane_s, F.sum("amount").alias("total")), v.window_s, pane_s, F.sum("total").cast("double").alias("total_amount"))
    burst = burst.withColumnRenamed("n", "txn_count").where((F.col("txn_count") > v.max_count) | (F.col("total_amount") > v.max_total))
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("used")))).alias("currencies")
    hops = _merged(_panes(txns, pane_s, F.collect_set("currency").alias("used")), m.window_s, pane_s, every)
    hops = hops.withColumnRenamed("n", "txn_count").where(F.size("currencies") > m.max_currencies)
    failed = _panes(txns, pane_s, F.count_if(F.col("status") == "failed").alias("failed"))
    spikes = (
        _merged(failed, f.window_s, pane_s, F.sum("failed").alias("failed_count"))
        .withColumnRenamed("n", "total_count")
        .withColumn("fail_rate_pct", round_even(F.col("failed_count") / F.col("total_count") * 100, 1))
        .where((F.col("failed_count") >= f.min_failed) & (F.col("fail_rate_pct") > f.max_rate_pct))
    )
    return {
        "VELOCITY": flat(burst, "VELOCITY", "txn_count", "total_amount"),
        "MULTI_CCY": flat(hops, "MULTI_CCY", "txn_count", "currencies"),
        "FAIL_SPIKE": flat(spikes, "FAIL_SPIKE", "failed_count", "total_count", "fail_rate_pct"),
    }


def stream_rule_windows(txns: DataFrame, rules: RuleSet = RuleSet(), delay: str = "10 minutes", pane_s: int = PANE_S) -> dict[str, DataFrame]:
    """The same over a stream (output mode `append`): a window is told once, when the watermark has passed its end.

    Two stateful steps follow one another, panes and windows. Rows later than `delay` are left out;
    :func:`repaired_windows` puts their windows right.
    """
    return rule_windows(txns.withWatermark("created_at", delay), rules, pane_s)


def repaired_windows(
    told: DataFrame, txns: DataFrame, late: DataFrame, code: str, rules: RuleSet = RuleSet(), pane_s: int = PANE_S
) -> DataFrame:
    """The windows of a rule as they would have been told with its late rows in time.

    `told` are the windows the stream gave, `txns` all stored transactions, `late` (account_id, created_at) those that came too late. Only windows
    with a late row are made anew, from the rows of their accounts near those times.
    """
    window_s = {"VELOCITY": rules.velocity, "MULTI_CCY": rules.multi_currency, "FAIL_SPIKE": rules.fail_spike}[code].window_s
    touched = late.groupBy(F.window("created_at", f"{window_s} seconds", f"{pane_s} seconds").alias("w"), "account_id").agg(F.count(F.lit(1)).alias("late"))
    touched = touched.selectExpr("account_id AS _account", "w.start AS _start", "w.end AS _end")
    # whole windows before and after, so that an equality can deal the rows
    span = lambda at: F.floor(F.unix_timestamp(at) / window_s)
    near = touched.select("_account", F.explode(F.sequence(span("_start"), span("_end"))).alias("_span")).distinct()
    rows = txns.join(near, (F.col("account_id") == F.col("_account")) & (span("created_at") == F.col("_span")), "left_semi")
    mine = (F.col("account_id") == F.col("_account")) & (F.col("window_start") == F.col("_start"))
    made = rule_windows(rows, rules, pane_s)[code].join(touched, mine, "left_semi")
    return told.join(touched, mine, "left_anti").unionByName(made)


def tumbling_minutes(txns: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Count and amount per minute of event time."""
    per_minute = txns.withWatermark("created_at", delay).groupBy(F.window("created_at", "1 minute"))
    return per_minute.agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast("double").alias("total_amount")
    ).select(F.col("window.start").alias("minute"), "txn_count", "total_amount")
