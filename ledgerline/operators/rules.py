"""The six detection rules over current-state transactions.

The three account rules share one aggregation: rows in the widest window are
first counted per account and small dimension (type, status, currency), which
combines on the map side, and only those few counts are merged per account. An
account with a third of all rows therefore costs as much as any other, and the
list-valued outputs are counted values instead of one entry per transaction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.skew import salted_join
from ledgerline.functions.timing import Instant, trailing, trailing_sql
from ledgerline.params import FailSpike, HighRisk, LargeAmount, MultiCurrency, RuleSet, Velocity, ZScore


def counted_values(cells: str, field: str) -> str:
    """SQL for the counted values of one dimension of the collected cells, in value order."""
    return (
        f"transform(array_sort(array_distinct(transform({cells}, c -> c.{field}))), v -> named_struct('value', v, 'n', "
        f"aggregate(filter({cells}, c -> c.{field} = v), 0L, (total, c) -> total + c.n)))"
    )


def account_activity(
    txns: DataFrame,
    as_of: Instant,
    velocity: Velocity | None = None,
    multi_currency: MultiCurrency | None = None,
    fail_spike: FailSpike | None = None,
    upper_bound: bool = True,
) -> DataFrame:
    """One row per account with what the requested account rules need."""
    wanted = [p for p in (velocity, multi_currency, fail_spike) if p]
    recent = txns.where(trailing("created_at", as_of, max(p.window_s for p in wanted), upper_bound))

    def inside(p) -> str:
        return trailing_sql("created_at", as_of, p.window_s, upper_bound)

    dims: list[str] = []
    cells: list[str] = []
    merged: list[str] = []
    if velocity:
        w = inside(velocity)
        dims += ["type", "status"]
        cells += [
            f"count_if({w}) AS v_n",
            f"sum(IF({w}, amount, NULL)) AS v_total",
            f"min(IF({w}, created_at, NULL)) AS v_first",
            f"max(IF({w}, created_at, NULL)) AS v_last",
        ]
        merged += [
            "sum(v_n) AS v_n",
            "CAST(sum(v_total) AS DOUBLE) AS v_total",
            "min(v_first) AS v_first",
            "max(v_last) AS v_last",
            "collect_list(IF(v_n > 0, named_struct('type', type, 'status', status, 'n', v_n), NULL)) AS v_cells",
        ]
    if multi_currency:
        w = inside(multi_currency)
        dims += ["currency"]
        cells += [
            f"count_if({w}) AS m_n",
            f"min(IF({w}, created_at, NULL)) AS m_first",
            f"max(IF({w}, created_at, NULL)) AS m_last",
        ]
        merged += [
            "sum(m_n) AS m_n",
            "min(m_first) AS m_first",
            "max(m_last) AS m_last",
            "collect_set(IF(m_n > 0, currency, NULL)) AS m_currencies",
        ]
    if fail_spike:
        w = inside(fail_spike)
        cells += [
            f"count_if({w}) AS f_n",
            f"count_if({w} AND status = 'failed') AS f_failed",
            f"max(IF({w}, created_at, NULL)) AS f_last",
        ]
        merged += ["sum(f_n) AS f_n", "sum(f_failed) AS f_failed", "max(f_last) AS f_last"]
    per_cell = recent.groupBy("account_id", *dims).agg(*map(F.expr, cells))
    return per_cell.groupBy("account_id").agg(*map(F.expr, merged))


def velocity_flags(activity: DataFrame, params: Velocity) -> DataFrame:
    """Flagged accounts with totals and counted transaction types and statuses."""
    return activity.where(f"v_n > {params.max_count} OR v_total > {float(params.max_total)!r}D").selectExpr(
        "account_id",
        "v_n AS txn_count",
        "v_total AS total_amount",
        "v_first AS window_start",
        "v_last AS window_end",
        "unix_timestamp(v_last) - unix_timestamp(v_first) AS window_seconds",
        f"{counted_values('v_cells', 'type')} AS txn_types",
        f"{counted_values('v_cells', 'status')} AS txn_statuses",
    )


def multi_currency_flags(activity: DataFrame, params: MultiCurrency) -> DataFrame:
    return activity.where(f"size(m_currencies) > {params.max_currencies}").selectExpr(
        "account_id",
        "array_sort(m_currencies) AS currencies",
        "size(m_currencies) AS currency_count",
        "m_n AS txn_count",
        "m_first AS first_txn",
        "m_last AS last_txn",
    )


def fail_spike_flags(activity: DataFrame, params: FailSpike) -> DataFrame:
    """Flagged accounts; the rate is rounded before it is compared."""
    rated = activity.selectExpr(
        "account_id",
        "f_failed AS failed_count",
        "f_n AS total_count",
        "bround(try_divide(f_failed, f_n) * 100, 1) AS fail_rate_pct",
    )
    return rated.where(f"failed_count >= {params.min_failed} AND fail_rate_pct > {float(params.max_rate_pct)!r}D")


def rule_velocity(txns: DataFrame, as_of: Instant, params: Velocity = Velocity(), upper_bound: bool = True) -> DataFrame:
    """Accounts with too many transactions, or too much money, in the trailing window."""
    activity = account_activity(txns, as_of, velocity=params, upper_bound=upper_bound)
    return velocity_flags(activity, params).orderBy(F.desc("txn_count"), "account_id")


def rule_multi_currency(
    txns: DataFrame, as_of: Instant, params: MultiCurrency = MultiCurrency(), upper_bound: bool = True
) -> DataFrame:
    """Accounts that used more than the allowed number of currencies in the window."""
    activity = account_activity(txns, as_of, multi_currency=params, upper_bound=upper_bound)
    return multi_currency_flags(activity, params).orderBy(F.desc("currency_count"), "account_id")


def rule_fail_spike(
    txns: DataFrame, as_of: Instant, params: FailSpike = FailSpike(), upper_bound: bool = True
) -> DataFrame:
    """Accounts with several failed transactions that are also the larger part of all."""
    activity = account_activity(txns, as_of, fail_spike=params, upper_bound=upper_bound)
    return fail_spike_flags(activity, params).orderBy(F.desc("failed_count"), "account_id")


def account_baselines(txns: DataFrame, as_of: Instant, params: ZScore, upper_bound: bool = True) -> DataFrame:
    """Mean, population deviation and count per account over the baseline window."""
    return (
        txns.where(trailing("created_at", as_of, params.baseline_s, upper_bound))
        .groupBy("account_id")
        .agg(
            F.expr("avg(CAST(amount AS DOUBLE)) AS avg_amount"),
            F.expr("stddev_pop(CAST(amount AS DOUBLE)) AS std_amount"),
            F.expr("count(*) AS txn_count_30d"),
        )
        .where(f"txn_count_30d >= {params.min_history}")
    )


def zscore_flags(txns: DataFrame, as_of: Instant, params: ZScore = ZScore(), upper_bound: bool = True) -> DataFrame:
    """Recent transactions far from their account's baseline, with the unrounded z in `z`.

    The baseline contains the tested transactions too. A deviation of zero gives
    no z and therefore no flag.
    """
    recent = txns.where(trailing("created_at", as_of, params.window_s, upper_bound)).select(
        "id", "account_id", "amount", "type", "merchant_id", "created_at"
    )
    baselines = account_baselines(txns, as_of, params, upper_bound)
    # the baseline counts each account's rows already, the recent ones among them
    counts = baselines.selectExpr("account_id", "txn_count_30d AS _n")
    joined = salted_join(recent, baselines, "account_id", tie="id", counts=counts)
    scored = joined.selectExpr("*", "(CAST(amount AS DOUBLE) - avg_amount) / nullif(std_amount, 0) AS z")
    return scored.where(f"abs(z) > {float(params.max_abs_z)!r}D")


def rule_zscore(txns: DataFrame, as_of: Instant, params: ZScore = ZScore(), upper_bound: bool = True) -> DataFrame:
    """Transactions more than `max_abs_z` deviations from the account's mean."""
    flags = zscore_flags(txns, as_of, params, upper_bound).selectExpr("* EXCEPT (z)", "bround(z, 2) AS z_score")
    return flags.orderBy(F.expr("abs(z_score)").desc(), "id")


def large_amount_flags(txns: DataFrame, as_of: Instant, params: LargeAmount, upper_bound: bool = True) -> DataFrame:
    recent = trailing_sql("created_at", as_of, params.window_s, upper_bound)
    return txns.where(f"amount > CAST({params.max_amount} AS DECIMAL(18,2)) AND {recent}").select("id", "account_id", "merchant_id", "amount", "currency", "type", "status", "created_at")


def rule_large_amount(
    txns: DataFrame, as_of: Instant, params: LargeAmount = LargeAmount(), upper_bound: bool = True
) -> DataFrame:
    """Single transactions above the amount limit."""
    return large_amount_flags(txns, as_of, params, upper_bound).orderBy(F.desc("amount"), "id")


def risky_merchants(merchants: DataFrame, params: HighRisk) -> DataFrame:
    """Labelled merchants, deleted ones included: a deleted merchant still taints its payments."""
    labelled = merchants.where(F.col("risk_level") == params.risk_level)
    return labelled.selectExpr("id AS merchant_id", "name AS merchant_name", "risk_level")


def high_risk_flags(
    txns: DataFrame, merchants: DataFrame, as_of: Instant, params: HighRisk = HighRisk(), upper_bound: bool = True
) -> DataFrame:
    recent = txns.where(trailing("created_at", as_of, params.window_s, upper_bound)).select(
        "id", "account_id", "amount", "type", "created_at", "merchant_id"
    )
    return salted_join(recent, risky_merchants(merchants, params), "merchant_id", tie="id").drop("merchant_id")


def rule_high_risk(
    txns: DataFrame, merchants: DataFrame, as_of: Instant, params: HighRisk = HighRisk(), upper_bound: bool = True
) -> DataFrame:
    """Transactions with a merchant labelled high-risk."""
    return high_risk_flags(txns, merchants, as_of, params, upper_bound).orderBy(F.desc("created_at"), "id")


def rule_flags(
    code: str, txns: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True
) -> DataFrame:
    """The flagged rows of one rule, unsorted."""
    if code == "VELOCITY":
        return velocity_flags(account_activity(txns, as_of, velocity=rules.velocity, upper_bound=upper_bound), rules.velocity)
    if code == "MULTI_CCY":
        activity = account_activity(txns, as_of, multi_currency=rules.multi_currency, upper_bound=upper_bound)
        return multi_currency_flags(activity, rules.multi_currency)
    if code == "FAIL_SPIKE":
        activity = account_activity(txns, as_of, fail_spike=rules.fail_spike, upper_bound=upper_bound)
        return fail_spike_flags(activity, rules.fail_spike)
    if code == "ZSCORE":
        flags = zscore_flags(txns, as_of, rules.zscore, upper_bound)
        return flags.selectExpr("* EXCEPT (z)", "bround(z, 2) AS z_score")
    if code == "LARGE_AMT":
        return large_amount_flags(txns, as_of, rules.large_amount, upper_bound)
    if code == "HIGH_RISK":
        return high_risk_flags(txns, merchants, as_of, rules.high_risk, upper_bound)
    raise ValueError(f"unknown rule: {code}")


def all_rule_flags(
    txns: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True
) -> dict[str, DataFrame]:
    """The flagged rows of each rule, unsorted; the account rules share one aggregation."""
    activity = account_activity(txns, as_of, rules.velocity, rules.multi_currency, rules.fail_spike, upper_bound)
    shared = {
        "VELOCITY": velocity_flags(activity, rules.velocity),
        "MULTI_CCY": multi_currency_flags(activity, rules.multi_currency),
        "FAIL_SPIKE": fail_spike_flags(activity, rules.fail_spike),
    }
    order = ("VELOCITY", "ZSCORE", "LARGE_AMT", "HIGH_RISK", "MULTI_CCY", "FAIL_SPIKE")
    return {c: shared[c] if c in shared else rule_flags(c, txns, merchants, as_of, rules, upper_bound) for c in order}


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rule_flagged_accounts(flags: dict[str, DataFrame], accounts: DataFrame | None = None) -> DataFrame:
    """(rule_code, account_id) pairs, restricted to an account set where one is given."""
    parts = [rows.select(F.lit(code).alias("rule_code"), "account_id") for code, rows in flags.items()]
    pairs = union_all(parts).distinct()
    return pairs if accounts is None else pairs.join(accounts.select("account_id"), "account_id", "left_semi")
