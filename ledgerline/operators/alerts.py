"""From flagged rows to cases: severity, payload, one case per account, suppression, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.timing import Instant, before, instant, instant_sql, stamp_sql, trailing
from ledgerline.functions.values import severity_name, severity_rank, spelled_out
from ledgerline.operators.rules import union_all
from ledgerline.params import DEDUP_WINDOW_S, DEDUP_WINDOW_UNKNOWN_S, RuleSet
from ledgerline.schemas import RULE_CODES, SEVERITIES

# ---- fixed values: list limits ----
LIST_DEFAULT = 500
FIRINGS = 100  # shown of one account
RAW_TEXT_LENGTH, SHORT_ID_LENGTH = 120, 8
# -----------------------------------

TOTAL = "decimal(38,2)"


def classify_severity(code: str, rules: RuleSet = RuleSet()) -> str:
    """SQL for the severity of one flagged row of a rule."""
    if code == "ZSCORE":
        return f"IF(abs(z_score) > {float(rules.zscore.critical_abs_z)!r}D, 'critical', 'high')"
    if code == "LARGE_AMT":
        return f"IF(amount > CAST({rules.large_amount.critical_amount} AS DECIMAL(18,2)), 'critical', 'high')"
    return "'medium'" if code in ("HIGH_RISK", "MULTI_CCY") else "'high'"


# ---- fixed values: fields of the evidence per rule ----
EVIDENCE_FIELDS = {
    "VELOCITY": {
        "window_seconds": "window_seconds",
        "window_start": stamp_sql("window_start"),
        "window_end": stamp_sql("window_end"),
        "txn_types": "txn_types",
        "txn_statuses": "txn_statuses",
    },
    "ZSCORE": {
        "txn_id": "id",
        "z_score": "CAST(z_score AS DECIMAL(38,2))",
        "type": "type",
        "merchant_id": "merchant_id",
        "avg_amount": "CAST(avg_amount AS DECIMAL(38,6))",
        "std_amount": "CAST(std_amount AS DECIMAL(38,6))",
        "txn_count_30d": "txn_count_30d",
    },
    "LARGE_AMT": {
        "txn_id": "id",
        "currency": "currency",
        "type": "type",
        "merchant_id": "merchant_id",
        "status": "status",
    },
    "HIGH_RISK": {"txn_id": "id", "merchant_name": "merchant_name", "risk_level": "risk_level", "type": "type"},
    "MULTI_CCY": {
        "currencies": "currencies",
        "currency_count": "currency_count",
        "first_txn": stamp_sql("first_txn"),
        "last_txn": stamp_sql("last_txn"),
    },
    "FAIL_SPIKE": {
        "failed_count": "failed_count",
        "total_count": "total_count",
        "fail_rate_pct": "CAST(fail_rate_pct AS DECIMAL(38,1))",
    },
}
# -------------------------------------------------------


def evidence(code: str) -> str:
    """SQL for what the case shows as proof, as JSON text; absent values are written as null."""
    fields = ", ".join(f"'{name}', {value}" for name, value in EVIDENCE_FIELDS[code].items())
    return f"to_json(named_struct({fields}), map('ignoreNullFields', 'false'))"


def payload(code: str, rules: RuleSet = RuleSet(), count: str | None = None, total: str | None = None) -> dict[str, str]:
    """SQL for the payload columns of one flagged row of a rule; `count` and `total` name other columns for them.

    `position` orders the rows of an account the way the rule sorts its result;
    the lowest is the one whose evidence a case keeps.
    """
    n, amount, position, txn_id = {
        "VELOCITY": ("txn_count", "total_amount", "0D", "''"),
        "ZSCORE": ("1", "amount", "-abs(z_score)", "id"),
        "LARGE_AMT": ("1", "amount", "-CAST(amount AS DOUBLE)", "id"),
        "HIGH_RISK": ("1", "amount", "-CAST(unix_micros(created_at) AS DOUBLE)", "id"),
        "MULTI_CCY": ("txn_count", "0", "0D", "''"),
        "FAIL_SPIKE": ("failed_count", "0", "0D", "''"),
    }[code]
    return {
        "rule_code": f"'{code}'",
        "account_id": "account_id",
        "txn_count": f"CAST({count or n} AS BIGINT)",
        "total_amount": f"CAST({total or amount} AS {TOTAL})",
        "severity": classify_severity(code, rules),
        "evidence": evidence(code),
        "position": position,
        "txn_id": txn_id,
    }


def alert_payload(code: str, flags: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """Flagged rows of one rule as (rule, account, count, amount, severity, evidence)."""
    return flags.selectExpr(*[f"{value} AS {name}" for name, value in payload(code, rules).items()])


def rules_all(flags: dict[str, DataFrame], rules: RuleSet = RuleSet()) -> DataFrame:
    """All rules in one long table of payload rows."""
    return union_all([alert_payload(code, rows, rules) for code, rows in flags.items()])


def aggregate_alerts(payloads: DataFrame) -> DataFrame:
    """One case per (rule, account): summed counts and amounts, highest severity, first evidence.

    Where several rows were merged the evidence also says how many. Rows without
    an account are skipped.
    """
    first = F.min_by("evidence", F.struct("position", "txn_id"))
    merged = (
        payloads.where(F.col("account_id").isNotNull() & (F.col("account_id") != ""))
        .groupBy("rule_code", "account_id")
        .agg(
            F.sum("txn_count").alias("txn_count"),
            F.sum("total_amount").cast(TOTAL).alias("total_amount"),
            F.max(severity_rank("severity")).alias("rank"),
            first.alias("evidence"),
            F.count(F.lit(1)).alias("matches"),
        )
    )
    counted = F.concat(
        F.regexp_replace("evidence", r"\}$", ""), F.lit(',"matches":'), F.col("matches").cast("string"), F.lit("}")
    )
    return merged.select(
        "rule_code",
        "account_id",
        "txn_count",
        "total_amount",
        severity_name(F.col("rank")).alias("severity"),
        F.when(F.col("matches") > 1, counted).otherwise(F.col("evidence")).alias("evidence"),
    )


def dedup_window(override_s: int | None = None) -> str:
    """SQL for the suppression seconds of `rule_code`."""
    if override_s is not None:
        return str(int(override_s))
    known = " ".join(f"WHEN '{code}' THEN {seconds}" for code, seconds in DEDUP_WINDOW_S.items())
    return f"CASE rule_code {known} ELSE {DEDUP_WINDOW_UNKNOWN_S} END"


def suppressing_cases(alerts: DataFrame, as_of: Instant, override_s: int | None = None) -> DataFrame:
    """(account, rule) pairs with a case younger than the rule's suppression window."""
    longest = override_s if override_s is not None else max(*DEDUP_WINDOW_S.values(), DEDUP_WINDOW_UNKNOWN_S)
    age_us = f"unix_micros({instant_sql(as_of)}) - unix_micros(created_at)"
    recent = alerts.where(F.col("created_at") > before(as_of, longest))
    young = recent.where(f"{age_us} < ({dedup_window(override_s)}) * 1000000L")
    return young.select("account_id", "rule_code").distinct()


def dedup_alerts(candidates: DataFrame, alerts: DataFrame, as_of: Instant, override_s: int | None = None) -> DataFrame:
    """Candidates without a recent case for the same account and rule."""
    return candidates.join(suppressing_cases(alerts, as_of, override_s), ["account_id", "rule_code"], "left_anti")


def skip_orphan_alerts(candidates: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates whose account exists, the orphans)."""
    known = accounts.select(F.col("id").alias("account_id"))
    return candidates.join(known, "account_id", "left_semi"), candidates.join(known, "account_id", "left_anti")


def decide_alerts(
    candidates: DataFrame, alerts: DataFrame, accounts: DataFrame, as_of: Instant, override_s: int | None = None
) -> DataFrame:
    """Candidates with their `outcome`: dedup, else skipped (orphan account), else new."""
    young = suppressing_cases(alerts, as_of, override_s).withColumn("young", F.lit(True))
    known = accounts.select(F.col("id").alias("account_id"), F.lit(True).alias("known"))
    return (
        candidates.join(young, ["account_id", "rule_code"], "left")
        .join(known, "account_id", "left")
        .withColumn("outcome", F.when(F.col("young"), "dedup").when(F.col("known"), "new").otherwise("skipped"))
        .drop("young", "known")
    )


def outcome_summary(decided: DataFrame) -> DataFrame:
    """Per rule: how many cases are new, suppressed and skipped."""
    return decided.groupBy("rule_code").agg(
        F.count_if(F.col("outcome") == "new").alias("new"),
        F.count_if(F.col("outcome") == "dedup").alias("dedup"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
    )


def new_cases(decided: DataFrame, as_of: Instant) -> DataFrame:
    """Rows to append to the alert log.

    The id is derived from rule, account and detection time, so a pass that is
    run again writes the same case and not a second one.
    """
    at = instant(as_of)
    digest = F.sha2(F.concat_ws("|", "rule_code", "account_id", F.unix_micros(at).cast("string")), 256)
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return decided.where(F.col("outcome") == "new").select(
        F.concat_ws("-", *parts).alias("id"),
        "account_id",
        "rule_code",
        "severity",
        F.col("txn_count").cast("int").alias("txn_count"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        "evidence",
        F.lit("open").alias("status"),
        F.lit(None).cast("string").alias("notes"),
        at.alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )


def alert_list(
    alerts: DataFrame,
    accounts: DataFrame,
    rule: str | None = None,
    severity: str | None = None,
    limit: int | None = LIST_DEFAULT,
) -> DataFrame:
    """Newest cases with the account name, optionally of one rule or severity.

    The newest rows are taken before the accounts are joined; `limit=None` lists all cases,
    as the grouped forms need.
    """
    if rule and rule not in RULE_CODES:
        raise ValueError(f"invalid rule: {rule}")
    if severity and severity not in SEVERITIES:
        raise ValueError(f"invalid severity: {severity}")
    rows = alerts
    if rule:
        rows = rows.where(F.col("rule_code") == rule)
    if severity:
        rows = rows.where(F.col("severity") == severity)
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    newest = rows if limit is None else rows.orderBy(F.desc("created_at"), "id").limit(limit)
    names = accounts.select(F.col("id").alias("account_id"), F.col("full_name").alias("account_name"))
    return newest.join(names, "account_id", "left").select(
        "id",
        "account_id",
        "account_name",
        "rule_code",
        "severity",
        "txn_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        "evidence",
        "status",
        "created_at",
    )


def alert_groups(listed: DataFrame, firings: int = FIRINGS) -> DataFrame:
    """Cases grouped per account, newest account first.

    Totals count all cases given; of the cases themselves the newest `firings` of each account are
    shown, newest first, so that no account's list outgrows a row.
    """
    firing = F.struct(
        F.unix_micros("created_at").alias("at"),
        "id",
        "rule_code",
        "severity",
        "txn_count",
        "total_amount",
        "evidence",
        "status",
        "created_at",
    )
    totals = listed.groupBy("account_id").agg(
        F.max("account_name").alias("account_name"),
        F.max("created_at").alias("last_seen"),
        F.count(F.lit(1)).alias("total_firings"),
    )
    # row_number keeps the newest of each map task before the exchange
    turn = F.row_number().over(W.partitionBy("account_id").orderBy(F.desc("created_at"), F.desc("id")))
    shown = listed.withColumn("_turn", turn).where(F.col("_turn") <= firings).groupBy("account_id")
    shown = shown.agg(F.sort_array(F.collect_list(firing), asc=False).alias("firings"))
    grouped = totals.join(shown, "account_id")
    return grouped.orderBy(F.desc("last_seen"), "account_id")


def alert_rule_buckets(listed: DataFrame) -> DataFrame:
    """Per account and rule: highest severity and number of firings, most severe first."""
    buckets = listed.groupBy("account_id", "rule_code").agg(
        F.max(severity_rank("severity")).alias("rank"), F.count(F.lit(1)).alias("firings")
    )
    return buckets.orderBy("account_id", F.desc("rank"), F.desc("firings"), "rule_code").select(
        "account_id", "rule_code", severity_name(F.col("rank")).alias("severity"), "firings"
    )


def alert_account_totals(listed: DataFrame) -> DataFrame:
    """Per account: summed amount, highest severity, open cases."""
    return listed.groupBy("account_id").agg(
        F.sum(F.coalesce(F.col("total_amount"), F.lit(0)).cast(TOTAL)).cast("double").alias("total_amount"),
        severity_name(F.max(severity_rank("severity"))).alias("max_severity"),
        F.count_if(F.col("status") == "open").alias("open_count"),
    )


def shortened(text: Column, length: int) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("…"))).otherwise(text)


def grouped_number(text: Column) -> Column:
    """Number with thousands separators and at most two decimals, no trailing zeros."""
    value = text.try_cast("double")
    formatted = F.regexp_replace(F.call_function("format_number", value, F.lit("#,##0.##")), "^-0$", "0")
    return F.when(value.isNull(), text).otherwise(formatted)


def alert_evidence_text(alerts: DataFrame) -> DataFrame:
    """Adds `evidence_text`: one line per case; unreadable evidence shows its first characters."""
    raw = F.col("evidence")

    def get(name: str) -> Column:
        return F.get_json_object(raw, f"$.{name}")

    def shown(name: str, missing: str) -> Column:
        return F.coalesce(get(name), F.lit(missing))

    listed = F.from_json(get("txn_types"), "array<string>")
    counts = F.from_json(get("txn_types"), "array<struct<value:string,n:bigint>>")
    types = F.when(get("txn_types").startswith("[{"), spelled_out(counts)).otherwise(listed)
    joined_types = F.coalesce(F.array_join(types, ", "), F.lit(""))
    currencies = F.coalesce(F.array_join(F.from_json(get("currencies"), "array<string>"), ", "), F.lit(""))
    lines = {
        "VELOCITY": F.concat(F.lit("window "), shown("window_seconds", "undefined"), F.lit("s · types ["), joined_types, F.lit("]")),
        "LARGE_AMT": F.concat(
            F.lit("txn "),
            F.coalesce(shortened(get("txn_id"), SHORT_ID_LENGTH), F.lit("")),
            F.lit(" · "),
            shown("currency", "undefined"),
            F.lit(" · "),
            shown("type", "undefined"),
        ),
        "ZSCORE": F.concat(
            F.lit("z="),
            grouped_number(shown("z_score", "undefined")),
            F.lit(" · avg "),
            grouped_number(shown("avg_amount", "undefined")),
            F.lit(" · std "),
            grouped_number(shown("std_amount", "undefined")),
            F.lit(" · n="),
            shown("txn_count_30d", "?"),
        ),
        "HIGH_RISK": F.concat(
            F.lit("merchant "), shown("merchant_name", "?"), F.lit(" · risk "), shown("risk_level", "?"), F.lit(" · "), shown("type", "")
        ),
        "MULTI_CCY": F.concat(shown("currency_count", "?"), F.lit(" currencies: ["), currencies, F.lit("]")),
        "FAIL_SPIKE": F.concat(
            shown("failed_count", "undefined"),
            F.lit("/"),
            shown("total_count", "undefined"),
            F.lit(" failed · rate "),
            grouped_number(shown("fail_rate_pct", "undefined")),
            F.lit("%"),
        ),
    }
    text = shortened(raw, RAW_TEXT_LENGTH)
    for code, line in lines.items():
        text = F.when(F.col("rule_code") == code, line).otherwise(text)
    parsed = F.get_json_object(raw, "$").isNotNull()
    return alerts.withColumn(
        "evidence_text",
        F.when(raw.isNull() | (raw == ""), F.lit(None)).when(parsed, text).otherwise(shortened(raw, RAW_TEXT_LENGTH)),
    )


def alert_counts(alerts: DataFrame, as_of: Instant | None = None, seconds: int = 3600, by_severity: bool = False) -> DataFrame:
    """Cases per rule (and severity) with first and last time, of all time or a trailing window."""
    rows = alerts if as_of is None else alerts.where(trailing("created_at", as_of, seconds))
    keys = ["rule_code", "severity"] if by_severity else ["rule_code"]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("alerts"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")
    )


def open_alerts_24h(alerts: DataFrame, as_of: Instant, upper_bound: bool = True) -> DataFrame:
    """Open cases per account in the last 24 hours."""
    open_now = alerts.where((F.col("status") == "open") & trailing("created_at", as_of, 24 * 3600, upper_bound))
    return open_now.groupBy("account_id").agg(F.count(F.lit(1)).alias("open_alerts_24h"))


def case_status(alerts: DataFrame, transitions: DataFrame) -> DataFrame:
    """Cases with their newest status.

    `transitions` has (alert_id, status, at); only known states count, the last
    one wins, and a case with none keeps its own. Closing sets `resolved_at`.
    """
    known = transitions.where(F.col("status").isin("open", "closed_fraud", "closed_clean"))
    last = known.groupBy(F.col("alert_id").alias("id")).agg(F.max(F.struct("at", "status")).alias("t"))
    joined = alerts.join(last, "id", "left")
    status = F.coalesce("t.status", "status")
    return joined.withColumn(
        "resolved_at",
        F.when(F.col("t").isNull(), F.col("resolved_at")).when(F.col("t.status") != "open", F.col("t.at")),
    ).withColumn("status", status).drop("t")
