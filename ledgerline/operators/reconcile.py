"""Which rows of two tables differ, found from checksums of key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_BITS = 16  # of a key's hash: 65,536 leaves
LEVEL_BITS = 4  # nodes of one level are compared sixteen at a time


def checksums(rows: DataFrame, key: Sequence[str] = ("id",), columns: Sequence[str] | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """(leaf, n, a, b): number and order-free checksums of the rows whose key hash begins with the leaf's bits.

    Sums and exclusive-ors of two row hashes, so neither a changed, a lost nor a repeated row leaves them as they were. Nulls
    count as values. Combined on the map side: at most 2 ** bits rows are exchanged for each task.
    """
    shown = list(columns or [c for c in rows.columns if not c.startswith("_")])
    leaf = F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)
    one, other = F.xxhash64(*[_with_null(c) for c in shown]), F.xxhash64(F.lit("k"), *[_with_null(c) for c in reversed(shown)])
    hashed = rows.select(leaf.alias("leaf"), one.alias("x"), other.alias("y"))
    return hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.expr("CAST(x AS DECIMAL(38,0))")).alias("a"), F.expr("bit_xor(y)").alias("b")
    )


def _with_null(column: str):
    """A null changes no hash by itself, so it is marked."""
    return F.struct(F.col(column).isNull(), F.col(column))


def differing_leaves(left: DataFrame, right: DataFrame, bits: int = LEAF_BITS) -> list[int]:
    """Leaves in which two checksum tables disagree, found level by level from the root down.

    The sums of a node are those of its children. Equal roots end the comparison at once; below, only the children of differing nodes are
    looked at, so the driver sees sixteen numbers for each of them.
    """

    def at(level: int, table: DataFrame, parents: list[int] | None) -> dict:
        node = F.expr(f"shiftrightunsigned(leaf, {bits - level})")
        rows = table if parents is None else table.where(F.expr(f"shiftrightunsigned(leaf, {bits - level + LEVEL_BITS})").isin(parents))
        sums = rows.groupBy(node.alias("node")).agg(F.sum("n"), F.sum("a"), F.expr("bit_xor(b)"))
        return {r[0]: tuple(r)[1:] for r in sums.collect()}

    nodes: list[int] | None = None
    for level in range(0, bits + 1, LEVEL_BITS):
        mine, theirs = at(level, left, nodes), at(level, right, nodes)
        nodes = sorted(n for n in mine.keys() | theirs.keys() if mine.get(n) != theirs.get(n))
        if not nodes:
            return []
    return nodes


def differences(left: DataFrame, right: DataFrame, key: Sequence[str] = ("id",), columns: Sequence[str] | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """(key..., left_rows, right_rows): the keys whose rows are not the same in both tables, with how often each side has them.

    Equal tables cost one aggregate each. Otherwise the rows of differing leaves alone are counted by content and compared, and keys with
    the same rows on both sides drop out. Keys with the same number of rows on either side were changed.
    """
    spark = left.sparkSession
    shown = list(columns or [c for c in left.columns if not c.startswith("_")])
    sums = [checksums(rows, key, shown, bits) for rows in (left, right)]
    stored = [s.persist() for s in sums]
    try:
        leaves = differing_leaves(*stored, bits)
    finally:
        for s in stored:
            s.unpersist()
    suspects = spark.createDataFrame([(n,) for n in leaves], "_leaf long")

    def counted(rows: DataFrame, side: int) -> DataFrame:
        inside = rows.withColumn("_of", F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)).join(suspects, F.col("_of") == F.col("_leaf"), "left_semi")
        content = F.struct(*[_with_null(c) for c in shown])
        return inside.select(*key, F.sha2(F.to_json(content), 256).alias("_row"), F.lit(side).alias("_side"))

    both = counted(left, 1).unionByName(counted(right, -1))
    per_row = both.groupBy(*key, "_row").agg(F.sum("_side").alias("_balance"), F.count_if(F.col("_side") == 1).alias("_l"), F.count_if(F.col("_side") == -1).alias("_r"))
    per_key = per_row.groupBy(*key).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"), F.count_if(F.col("_balance") != 0).alias("_odd"))
    return per_key.where("_odd > 0").drop("_odd")
