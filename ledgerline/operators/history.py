"""Rules over any window of the past, not only the one that ends now.

A window of fixed length moves over an account's rows: each row enters it at its time and leaves it when the window has passed.
Counting along entries and leavings in time order gives what every window holds, in one pass. Time is cut into
slices, and a row near the end of one also enters the next, so a slice is complete in itself and an account with a large share of
all rows is dealt over as many tasks as it has slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.params import HOUR, Velocity


def window_ends(txns: DataFrame, window_s: int, slice_s: int = HOUR) -> DataFrame:
    """(account_id, slice, at, txn_count, total_amount): for every distinct time of an account's rows, what the window that ends there holds.

    Both ends of the window belong to it. A slice must be as long as the window at least. Rows without a time or account are left out.
    """
    if slice_s < window_s:
        raise ValueError("a slice must not be shorter than the window")
    width, length = window_s * 1_000_000, slice_s * 1_000_000
    timed = txns.where("account_id IS NOT NULL AND created_at IS NOT NULL").selectExpr("account_id", "amount", "unix_micros(created_at) AS t")
    own = f"CAST(floor(t / {length}) AS BIGINT)"
    rim = f"t >= ({own} + 1) * {length} - {width}"
    dealt = timed.selectExpr("account_id", "amount", "t", f"explode(IF({rim}, array({own}, {own} + 1), array({own}))) AS slice")
    # at one instant rows enter before others leave
    moves = f"array(named_struct('at', t, 'sign', 1), named_struct('at', t + {width}, 'sign', -1))"
    steps = dealt.selectExpr("account_id", "slice", "amount", f"inline({moves})")
    order = Window.partitionBy("account_id", "slice").orderBy("at", F.desc("sign"))
    held = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = steps.select(
        "account_id",
        "slice",
        "at",
        "sign",
        F.sum("sign").over(held).alias("txn_count"),
        F.sum(F.expr("amount * sign")).over(held).alias("total_amount"),
        F.lead("at").over(order).alias("next_at"),
        F.lead("sign").over(order).alias("next_sign"),
    )
    last = "sign = 1 AND (next_at IS NULL OR next_at > at OR next_sign = -1)"
    return counted.where(f"{last} AND at >= slice * {length}").select("account_id", "slice", "at", "txn_count", "total_amount")


def velocity_any_window(txns: DataFrame, params: Velocity = Velocity(), slice_s: int = HOUR) -> DataFrame:
    """Accounts that had too many transactions, or too much money, in any window of the rule's length.

    One row per account: the most transactions and the most money any window held, the first time a window was over a limit, and
    how many distinct times were. The windows looked at end at a row of the account; any other holds no more than one of those.
    """
    over = f"txn_count > {params.max_count} OR total_amount > {float(params.max_total)!r}D"
    ends = window_ends(txns, params.window_s, max(slice_s, params.window_s))
    per_account = ends.groupBy("account_id").agg(
        F.max("txn_count").alias("peak_count"),
        F.max("total_amount").cast("double").alias("peak_amount"),
        F.expr(f"timestamp_micros(min(IF({over}, at, NULL)))").alias("first_over"),
        F.expr(f"count_if({over})").alias("times_over"),
    )
    return per_account.where("times_over > 0").orderBy(F.desc("peak_count"), "account_id")
