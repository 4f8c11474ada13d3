"""From string columns of the wire to typed versions, and row-level checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.skew import salted_join
from ledgerline.schemas import (
    ACCOUNTS,
    AMOUNT,
    FRAUD_ALERTS,
    MERCHANTS,
    MONEY,
    STAMP,
    STAMP_OR_NULL,
    TRANSACTIONS,
    WHOLE,
    TableSpec,
)


def wire_instant(text: Column) -> Column:
    """ISO text, also with slashes, or epoch seconds or milliseconds written as digits; NULL when empty or unreadable."""
    digits = text.try_cast("bigint")
    epoch = F.when(text.rlike("^[0-9]{11,}$"), F.timestamp_millis(digits)).when(text.rlike("^[0-9]{9,10}$"), F.timestamp_seconds(digits))
    slashed = F.when(text.rlike("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"), F.translate(text, "/", "-").try_cast("timestamp"))
    return F.coalesce(text.try_cast("timestamp"), epoch, slashed)


def blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def split_readable(flat: DataFrame, table: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows whose required times are empty or readable, the others as messages with what could not be read)."""
    times = [c for c, kind in table.columns.items() if kind == STAMP]
    broken = [F.when(~blank(F.col(c)) & wire_instant(F.col(c)).isNull(), F.lit(c)) for c in times]
    marked = flat.withColumn("_unreadable", F.array_compact(F.array(*broken)))
    lost = marked.where(F.size("_unreadable") > 0)
    return marked.where(F.size("_unreadable") == 0).drop("_unreadable"), lost.select(F.to_json(F.struct("*")).alias("_corrupt_record"))


def type_rows(flat: DataFrame, table: TableSpec, truncate_seconds: bool = False) -> DataFrame:
    """Typed versions of a table.

    Unreadable amounts become NULL rather than failing the row, because a delete
    marker may carry its key only. Missing creation and update times fall back to
    the commit time; unreadable ones become NULL, which `check_domains` reports and
    :func:`split_readable` sets aside. `truncate_seconds` drops sub-second digits of text times.
    """
    commit = F.timestamp_millis("__source_ts_ms")

    def typed(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == AMOUNT:
            return c.try_cast(MONEY)
        if kind == WHOLE:
            return c.try_cast("int")
        if kind in (STAMP, STAMP_OR_NULL):
            t = wire_instant(c)
            t = F.date_trunc("second", t) if truncate_seconds else t
            return F.when(blank(c), commit).otherwise(t) if kind == STAMP else t
        return c

    extra = [c for c in ("_partition", "_offset", "_rest") if c in flat.columns]
    return flat.select(
        *[typed(c, k).alias(c) for c, k in table.columns.items()],
        F.col("__op").alias("cdc_op"),
        F.col("__source_ts_ms").alias("_source_ts_ms"),
        *extra,
    )


def promote(log: DataFrame, table: TableSpec) -> DataFrame:
    """Stored versions with the columns of a newer declaration of their table, also where they were written before it.

    A column without a value is taken from the variant `_rest`, typed like a message's field, except that a missing time stays
    missing. What the declaration names is taken out of sight there: `_rest` stays as it was stored. A value of another kind,
    such as an object for a number, is null.
    """

    def kept(name: str, kind: str) -> Column:
        text = F.try_variant_get("_rest", f"$.{name}", "string")
        typed = {AMOUNT: text.try_cast(MONEY), WHOLE: text.try_cast("int"), STAMP: wire_instant(text), STAMP_OR_NULL: wire_instant(text)}.get(kind, text)
        return F.coalesce(F.col(name), typed) if name in log.columns else typed

    return log.withColumns({name: kept(name, kind) for name, kind in table.columns.items()})


def type_transactions(flat: DataFrame, **kw) -> DataFrame:
    return type_rows(flat, TRANSACTIONS, **kw)


def type_accounts(flat: DataFrame, **kw) -> DataFrame:
    return type_rows(flat, ACCOUNTS, **kw)


def type_merchants(flat: DataFrame, **kw) -> DataFrame:
    return type_rows(flat, MERCHANTS, **kw)


def type_alerts(flat: DataFrame, **kw) -> DataFrame:
    return type_rows(flat, FRAUD_ALERTS, **kw)


def check_domains(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Adds `violations`: names of the broken NOT NULL and allowed-value rules of each row."""
    present = set(rows.columns)
    broken = [
        F.when(F.col(c).isNull(), F.lit(f"{c}_null")) for c in table.required if c in present
    ]
    broken += [
        F.when(~F.col(c).isin(*allowed), F.lit(f"{c}_domain")) for c, allowed in table.domains.items() if c in present
    ]
    return rows.withColumn("violations", F.array_compact(F.array(*broken)))


def split_checked(rows: DataFrame, table: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy every rule, rows that do not with their violations)."""
    checked = check_domains(rows, table)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def check_unique_email(accounts: DataFrame) -> DataFrame:
    """E-mail addresses used by more than one account, with the number of uses; a missing address is none."""
    return accounts.where("email IS NOT NULL").groupBy("email").agg(F.count(F.lit(1)).alias("uses")).where(F.col("uses") > 1)


def check_foreign_keys(rows: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Values of `column` with no parent row, and how many rows carry each.

    The rows are first reduced to one per value, so a value carried by a large
    share of the rows costs no more than any other.
    """
    used = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parents.select(F.col("id").alias(column)), column, "left_anti")


def orphan_rows(rows: DataFrame, parents: DataFrame, column: str, tie: str = "id") -> DataFrame:
    """The rows themselves whose `column` has no parent row; a missing parent many rows name is spread."""
    missing = check_foreign_keys(rows, parents, column).select(column)
    return salted_join(rows, missing, column, tie).select(*rows.columns)


def apply_defaults(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Fill missing values with the table's column defaults."""
    kinds = dict(rows.dtypes)
    return rows.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
            for c, v in table.defaults.items()
            if c in kinds
        }
    )


def touch_updated_at(log: DataFrame) -> DataFrame:
    """Every update version carries its commit time as `updated_at`."""
    return log.withColumn(
        "updated_at",
        F.when(F.col("cdc_op") == "u", F.timestamp_millis("_source_ts_ms")).otherwise(F.col("updated_at")),
    )
