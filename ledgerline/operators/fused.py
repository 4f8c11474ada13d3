"""All six rules from one pass over the current state.

Every row of the state is read and deduplicated once. It contributes to its account (baseline, counts of every window),
if it is recent to a small cell (account, type, status, currency), and if a rule about single rows may flag it, it is kept as
a row. One aggregate makes all three, and its result, which holds accounts and recent rows only, is stored for the pass.
The rules are decided on what was stored: the account rules in one more aggregate, the row rules in one join with the
baselines, each row giving as many payload rows as rules flag it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timing import Instant, trailing, trailing_sql
from ledgerline.operators.alerts import payload
from ledgerline.operators.rules import counted_values, risky_merchants
from ledgerline.operators.state import latest_state
from ledgerline.params import RuleSet
from ledgerline.session import shared_dir
from ledgerline.sources.logs import log_since

OF_ACCOUNT, OF_CELL, OF_ROW = 0, 1, 2
ROW = ("id", "amount", "currency", "type", "status", "merchant_id", "created_at")


def widest_window(rules: RuleSet) -> int:
    """Seconds before an instant in which a row can matter to any rule."""
    every = (rules.velocity, rules.large_amount, rules.high_risk, rules.multi_currency, rules.fail_spike, rules.zscore)
    return max(rules.zscore.baseline_s, *[p.window_s for p in every])


def recent_state(log: DataFrame, as_of: Instant, rules: RuleSet = RuleSet()) -> DataFrame:
    """The current rows that can matter to a pass, from the stored log: only the months and times in question are read."""
    return latest_state(log_since(log, as_of, widest_window(rules)))


def tick_facts(state: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True) -> DataFrame:
    """What the rules need of the state: a row per account, per recent cell and per row that a row rule may flag.

    Counts combine on the map side, so a hot account costs no more than any other; kept rows are keys of their own.
    """

    def inside(seconds: int) -> str:
        return trailing_sql("created_at", as_of, seconds, upper_bound)

    v, m, f = inside(rules.velocity.window_s), inside(rules.multi_currency.window_s), inside(rules.fail_spike.window_s)
    z, base = inside(rules.zscore.window_s), inside(rules.zscore.baseline_s)
    large = f"{inside(rules.large_amount.window_s)} AND amount > CAST({rules.large_amount.max_amount} AS DECIMAL(18,2))"
    risk = f"{inside(rules.high_risk.window_s)} AND merchant_id IS NOT NULL"
    kept = ", ".join(f"'{c}', {c}" for c in ROW)
    empty = "CAST(NULL AS STRING)"

    def part(number: int, dims: bool, row: bool) -> str:
        values = [f"'part', {number}", *[f"'{c}', {c if dims else empty}" for c in ("type", "status", "currency")]]
        return f"named_struct({', '.join(values)}, 'row', IF({str(row).lower()}, named_struct({kept}), NULL))"

    parts = [
        part(OF_ACCOUNT, False, False),
        f"IF(({v}) OR ({m}), {part(OF_CELL, True, False)}, NULL)",
        f"IF(({z}) OR ({large}) OR ({risk}), {part(OF_ROW, False, True)}, NULL)",
    ]
    rows = state.where(trailing("created_at", as_of, widest_window(rules), upper_bound))
    dealt = rows.selectExpr("account_id", "amount", "created_at", "status = 'failed' AS failed", f"inline(array_compact(array({', '.join(parts)})))")
    of_base = f"IF({base}, CAST(amount AS DOUBLE), NULL)"
    return dealt.groupBy("account_id", "part", "type", "status", "currency", "row").agg(
        F.expr(f"count_if({v}) AS v_n"),
        F.expr(f"CAST(sum(IF({v}, amount, NULL)) AS DOUBLE) AS v_total"),
        F.expr(f"min(IF({v}, created_at, NULL)) AS v_first"),
        F.expr(f"max(IF({v}, created_at, NULL)) AS v_last"),
        F.expr(f"count_if({m}) AS m_n"),
        F.expr(f"min(IF({m}, created_at, NULL)) AS m_first"),
        F.expr(f"max(IF({m}, created_at, NULL)) AS m_last"),
        F.expr(f"count_if({f}) AS f_n"),
        F.expr(f"count_if({f} AND failed) AS f_failed"),
        F.expr(f"count_if({base}) AS txn_count_30d"),
        F.expr(f"avg({of_base}) AS avg_amount"),
        F.expr(f"stddev_pop({of_base}) AS std_amount"),
    )


def _payloads(rows: DataFrame, flagged: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """A payload row for every rule whose condition holds, from conditions and payload columns by rule."""
    parts = []
    for condition, columns in flagged.values():
        fields = ", ".join(f"'{name}', {value}" for name, value in columns.items())
        parts.append(f"IF({condition}, named_struct({fields}), NULL)")
    return rows.selectExpr(f"inline(array_compact(array({', '.join(parts)})))")


def account_payloads(facts: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """The account rules, from one aggregate with a row per account: its own counts and its few cells."""
    mine = f"part = {OF_ACCOUNT}"
    scalars = ("v_n", "v_total", "v_first", "v_last", "m_n", "m_first", "m_last", "f_n", "f_failed")
    cells = "collect_list(IF(part = {0} AND {1} > 0, named_struct('type', type, 'status', status, 'currency', currency, 'n', {1}), NULL))"
    accounts = (
        facts.where(f"part <> {OF_ROW}")
        .groupBy("account_id")
        .agg(
            *[F.expr(f"max(IF({mine}, {c}, NULL)) AS {c}") for c in scalars],
            F.expr(f"{cells.format(OF_CELL, 'v_n')} AS v_cells"),
            F.expr(f"{cells.format(OF_CELL, 'm_n')} AS m_cells"),
        )
    )
    named = accounts.selectExpr(
        "*",
        "v_first AS window_start",
        "v_last AS window_end",
        "unix_timestamp(v_last) - unix_timestamp(v_first) AS window_seconds",
        "array_sort(array_compact(array_distinct(m_cells.currency))) AS currencies",
        "m_first AS first_txn",
        "m_last AS last_txn",
        "f_failed AS failed_count",
        "f_n AS total_count",
        "bround(try_divide(f_failed, f_n) * 100, 1) AS fail_rate_pct",
    ).withColumn("currency_count", F.size("currencies"))
    v, m, f = rules.velocity, rules.multi_currency, rules.fail_spike
    # the lists are made for flagged accounts alone: they stand inside the conditional payload
    velocity = payload("VELOCITY", rules, count="v_n", total="v_total")
    velocity["evidence"] = (
        "transform(array(named_struct("
        f"'txn_types', {counted_values('v_cells', 'type')}, 'txn_statuses', {counted_values('v_cells', 'status')})), "
        f"lists -> {velocity['evidence'].replace(', txn_types', ', lists.txn_types').replace(', txn_statuses', ', lists.txn_statuses')})[0]"
    )
    flagged = {
        "VELOCITY": (f"v_n > {v.max_count} OR v_total > {float(v.max_total)!r}D", velocity),
        "MULTI_CCY": (f"currency_count > {m.max_currencies}", payload("MULTI_CCY", rules, count="m_n")),
        "FAIL_SPIKE": (f"failed_count >= {f.min_failed} AND fail_rate_pct > {float(f.max_rate_pct)!r}D", payload("FAIL_SPIKE", rules)),
    }
    return _payloads(named, flagged)


def row_payloads(facts: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True) -> DataFrame:
    """The rules about single rows: each kept row meets its account's baseline and its merchant once."""

    def inside(seconds: int) -> str:
        return trailing_sql("created_at", as_of, seconds, upper_bound)

    rows = facts.where(f"part = {OF_ROW}").selectExpr("account_id", "row.*")
    enough = f"part = {OF_ACCOUNT} AND txn_count_30d >= {rules.zscore.min_history}"
    baselines = facts.where(enough).select("account_id", "avg_amount", "std_amount", "txn_count_30d")
    # one row a key on the right of both joins: adaptive execution cuts an account or merchant with very many kept rows into several tasks
    joined = rows.join(baselines, "account_id", "left").join(risky_merchants(merchants, rules.high_risk), "merchant_id", "left")
    scored = joined.withColumn("z", F.expr("(CAST(amount AS DOUBLE) - avg_amount) / nullif(std_amount, 0)"))
    scored = scored.withColumn("z_score", F.bround("z", 2))
    limit = rules.large_amount
    flagged = {
        "ZSCORE": (f"{inside(rules.zscore.window_s)} AND abs(z) > {float(rules.zscore.max_abs_z)!r}D", payload("ZSCORE", rules)),
        "LARGE_AMT": (f"{inside(limit.window_s)} AND amount > CAST({limit.max_amount} AS DECIMAL(18,2))", payload("LARGE_AMT", rules)),
        "HIGH_RISK": (f"{inside(rules.high_risk.window_s)} AND risk_level IS NOT NULL", payload("HIGH_RISK", rules)),
    }
    return _payloads(scored, flagged)


def fused_payloads(
    state: DataFrame, merchants: DataFrame, as_of: Instant, rules: RuleSet = RuleSet(), upper_bound: bool = True
) -> DataFrame:
    """Payload rows of all rules, as :func:`ledgerline.operators.alerts.rules_all` gives them, from one pass over the state.

    The facts are stored in the shared folder before the rules read them, so the state is neither read nor deduplicated again,
    and an executor lost later costs a re-read.
    """
    shared_dir(state.sparkSession)
    facts = tick_facts(state, as_of, rules, upper_bound).checkpoint()
    return account_payloads(facts, rules).unionByName(row_payloads(facts, merchants, as_of, rules, upper_bound))


def flagged_accounts(payloads: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """(rule_code, account_id) pairs of payload rows, restricted to an account set where one is given."""
    pairs = payloads.select("rule_code", "account_id").distinct()
    return pairs if accounts is None else pairs.join(accounts.select("account_id"), "account_id", "left_semi")
