"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_KEYS = 1000  # how many keys are salted at most; any other holds less than 1/1000 of the rows
TASK_ROWS = 100_000  # rows of one key that are no burden for one task
NULL_SALTS = 10_000  # rows without a key match nothing and may go anywhere


def heavy_keys(rows: DataFrame, key: str, most: int = MOST_KEYS, min_rows: int = TASK_ROWS) -> DataFrame:
    """(key, _salts) of the keys with the most rows, at most `most` of them, each with over `min_rows`.

    `_salts` is the number of parts of at most `min_rows` rows. The result has a fixed size
    bound and may be broadcast. A key left out because others are larger has less than
    1/`most` of the rows. Counts combine on the map side, so finding a hot key does not itself
    meet the skew.
    """
    counts = rows.where(f"{key} IS NOT NULL").groupBy(key).agg(F.expr("count(*) AS _n"))
    return heavy(counts, key, most, min_rows)


def heavy(counts: DataFrame, key: str, most: int = MOST_KEYS, min_rows: int = TASK_ROWS) -> DataFrame:
    """The same from counts (key, _n) that are at hand."""
    largest = counts.where(f"_n > {min_rows}").orderBy(F.desc("_n"), key).limit(most)
    return largest.selectExpr(key, f"CAST(ceil(_n / {min_rows}) AS BIGINT) AS _salts")


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    tie: str,
    how: str = "inner",
    min_rows: int = TASK_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join facts to a lookup with one row per key, a heavy key being spread over as many parts as it fills.

    Only the heavy keys are salted: the facts of one go to its parts by the hash of `tie`, and only
    those lookup rows are repeated. Facts without a key, which a left join keeps, are spread
    too. With `counts` (key, _n) the facts are not read once more to find the heavy keys.
    """
    keys = heavy_keys(facts, key, min_rows=min_rows) if counts is None else heavy(counts, key, min_rows=min_rows)
    hot = F.broadcast(keys)
    salt = f"CASE WHEN {key} IS NULL THEN pmod(xxhash64({tie}), {NULL_SALTS}) WHEN _salts > 1 THEN pmod(xxhash64({tie}), _salts) ELSE 0L END"
    spread = facts.join(hot, key, "left").selectExpr("* EXCEPT (_salts)", f"{salt} AS _salt")
    repeated = lookup.join(hot, key, "left").selectExpr(
        "* EXCEPT (_salts)", "explode(sequence(0L, coalesce(_salts, 1L) - 1L)) AS _salt"
    )
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")
