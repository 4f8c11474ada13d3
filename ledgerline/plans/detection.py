"""One detection pass from current state to new cases."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from ledgerline.functions.timing import Instant
from ledgerline.operators.alerts import aggregate_alerts, alert_payload, decide_alerts, new_cases, outcome_summary
from ledgerline.operators.fused import fused_payloads, recent_state
from ledgerline.operators.rules import all_rule_flags
from ledgerline.params import RuleSet

LOG = logging.getLogger(__name__)


def alert_tick(
    txns: DataFrame,
    merchants: DataFrame,
    accounts: DataFrame,
    alerts: DataFrame,
    as_of: Instant,
    rules: RuleSet = RuleSet(),
    override_s: int | None = None,
    upper_bound: bool = True,
) -> DataFrame:
    """All candidate cases of one pass with their outcome.

    The state is read once (:mod:`ledgerline.operators.fused`); what the rules need of it is stored first.
    """
    payloads = fused_payloads(txns, merchants, as_of, rules, upper_bound)
    return decide_alerts(aggregate_alerts(payloads), alerts, accounts, as_of, override_s)


def alert_tick_from_log(
    log: DataFrame,
    merchants: DataFrame,
    accounts: DataFrame,
    alerts: DataFrame,
    as_of: Instant,
    rules: RuleSet = RuleSet(),
    override_s: int | None = None,
    upper_bound: bool = True,
) -> DataFrame:
    """The pass over the stored version log: one scan of the months in question, one choice of newest versions."""
    return alert_tick(recent_state(log, as_of, rules), merchants, accounts, alerts, as_of, rules, override_s, upper_bound)


def run_alert_tick(
    txns: DataFrame,
    merchants: DataFrame,
    accounts: DataFrame,
    alerts: DataFrame,
    as_of: Instant,
    append: Callable[[DataFrame, str], None],
    rules: RuleSet = RuleSet(),
    override_s: int | None = None,
    upper_bound: bool = True,
) -> list[dict]:
    """Run one pass rule by rule and report new / dedup / skipped for each.

    `append(cases, rule_code)` stores the new cases of a rule. A rule that fails
    is reported as an error and does not stop the others. The decided rows of a
    rule (one per account at most) are kept for the append and the summary; the
    summary is six numbers.
    """
    flags = all_rule_flags(txns, merchants, as_of, rules, upper_bound)
    report = []
    for code, rows in flags.items():
        try:
            candidates = aggregate_alerts(alert_payload(code, rows, rules))
            decided = decide_alerts(candidates, alerts, accounts, as_of, override_s).persist()
            try:
                append(new_cases(decided, as_of), code)
                counts = outcome_summary(decided).first()
            finally:
                decided.unpersist()
            done = counts.asDict() if counts else {"rule_code": code, "new": 0, "dedup": 0, "skipped": 0}
            report.append(done)
        except PySparkException as problem:
            LOG.error("rule %s failed: %s", code, problem)
            report.append({"rule_code": code, "error": str(problem).splitlines()[0]})
    return report
