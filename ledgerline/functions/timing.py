"""Time expressions. Everything is relative to an explicit `as_of` instant.

The `*_sql` forms give SQL text to be placed inside larger expressions; the other
functions give columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = str | datetime


def instant_sql(value: Instant) -> str:
    """Timestamp literal for text such as '2024-01-31 00:00:00' or a datetime."""
    if isinstance(value, datetime):
        return f"timestamp_micros({round(value.timestamp() * 1_000_000)})"
    if "'" in value or "\\" in value:
        raise ValueError(f"not an instant: {value}")
    return f"TIMESTAMP '{value}'"


def before_sql(as_of: Instant, seconds: int) -> str:
    return f"({instant_sql(as_of)} - INTERVAL {int(seconds)} SECONDS)"


def trailing_sql(col: str, as_of: Instant, seconds: int, upper_bound: bool = True) -> str:
    """`as_of - seconds <= col <= as_of`.

    The bounds fold to literals, so they reach the scan. The upper bound keeps
    replays of past instants honest; without it rows dated after `as_of` count too,
    as a query anchored at the current time lets them.
    """
    lower = f"{col} >= {before_sql(as_of, seconds)}"
    return f"({lower} AND {col} <= {instant_sql(as_of)})" if upper_bound else f"({lower})"


def instant(value: Instant) -> Column:
    return F.expr(instant_sql(value))


def before(as_of: Instant, seconds: int) -> Column:
    """The instant `seconds` earlier than `as_of`."""
    return F.expr(before_sql(as_of, seconds))


def trailing(col: str, as_of: Instant, seconds: int, upper_bound: bool = True) -> Column:
    return F.expr(trailing_sql(col, as_of, seconds, upper_bound))


def just_ingested(col: str, as_of: Instant, seconds: int, upper_bound: bool = True) -> Column:
    """Like :func:`trailing`, but with an open lower end."""
    lower = f"{col} > {before_sql(as_of, seconds)}"
    return F.expr(f"({lower} AND {col} <= {instant_sql(as_of)})" if upper_bound else lower)


def minute(col: str) -> Column:
    return F.expr(f"date_trunc('minute', {col})")


def millis_between(start: str, end: str) -> Column:
    """Whole milliseconds from start to end, counted by millisecond boundaries."""
    return F.expr(f"unix_millis({end}) - unix_millis({start})")


def month_key(col: str | Column) -> Column:
    """Partition value of the version log, such as 202401."""
    return F.date_format(col, "yyyyMM").cast("int")


def stamp_sql(col: str) -> str:
    """Millisecond text form used in evidence and in the rule views."""
    return f"date_format({col}, 'yyyy-MM-dd HH:mm:ss.SSS')"


def stamp_text(col: str) -> Column:
    return F.expr(stamp_sql(col))
