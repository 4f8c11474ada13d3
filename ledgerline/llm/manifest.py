"""Merkle manifest of a dataset: a tree for each group of rows, one root over all, and a proof for every row.

The rank of a node within its tree is written in base 8. A block is the 4096 consecutive nodes that share all but
the lowest four digits; those digits are grouped away one after another, so a block becomes one row whose struct nests
its runs down to the leaves. The hashes of blocks are the nodes of the next, 4096 times smaller, round. On the way back
the nested structs are spelled out with `transform` and `explode`, which have every sibling of a node at hand: no row of a
leaf is ever joined to another. The paths above a block meet it in an aggregation by block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import checkpointed

RUN_BITS = 3  # 8 nodes make a run
DIGITS = 4  # a block spans so many digits of the rank: 4096 nodes, whatever the size of the table
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_RUN = 1 << RUN_BITS
_STEPS = "array<struct<before:string,after:string>>"


def leaf_hash(columns: Sequence[str]) -> str:
    """SQL for the hash of some columns: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = [f"IF({c} IS NULL, '-', concat(octet_length(CAST({c} AS STRING)), ':', CAST({c} AS STRING)))" for c in columns]
    return f"sha2(concat({', '.join(parts)}), 256)"


def folded(path: str, leaf: str) -> str:
    """SQL for the root that a leaf's hash and the siblings along its path give."""
    return f"aggregate({path}, {leaf}, (h, s) -> sha2(concat(s.before, h, s.after), 256))"


def proof(path: str) -> str:
    """SQL for the hash of all siblings along a path, level by level and left to right."""
    return f"sha2(concat_ws('', flatten(transform({path}, s -> array(s.before, s.after)))), 256)"


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `rank`, from 0 within each `tree` by the columns of `order`, and `depth`, the levels a tree of that many nodes has.

    Rows are dealt by ranges of (tree, order), so a tree with a third of all rows is cut into ordinary parts; a part's
    rows are numbered alone and shifted by the counts of the parts before it. Rows that are equal in all of
    `order` are spread too, and their order among each other is open.
    """
    marked = rows.withColumn("_tie", F.monotonically_increasing_id())
    parts = marked.repartitionByRange("tree", *order, "_tie").withColumn("_part", F.spark_partition_id())
    parts = checkpointed(parts)
    counts = parts.groupBy("tree", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("tree").alias("_tree"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("_total"),
    )
    inside = Window.partitionBy("_part", "tree").orderBy(*order, "_tie")
    numbered = parts.withColumn("_number", F.row_number().over(inside) - 1)
    joined = numbered.join(shifts, (F.col("_part") == F.col("_of")) & F.col("tree").eqNullSafe(F.col("_tree")))
    depth = f"size(filter(sequence(0, 20), k -> shiftleft(1L, {RUN_BITS} * k) < _total))"
    return joined.selectExpr("tree", "_shift + _number AS rank", f"{depth} AS depth", "node")


def _blocks(nodes: DataFrame) -> DataFrame:
    """(tree, depth, block, node) from nodes (tree, depth, rank, node): four levels nested into one struct.

    `depth` counts the levels still to be made: a tree that is done passes its single node on unhashed.
    """
    digits = [f"shiftright(rank, {RUN_BITS * k}) & {_RUN - 1} AS d{k}" for k in range(DIGITS)]
    rows = nodes.selectExpr("tree", "depth", f"shiftright(rank, {RUN_BITS * DIGITS}) AS block", *digits, "node")
    rows = rows.repartition("tree", "block")
    for k in range(DIGITS):
        keys = ["tree", "depth", "block", *[f"d{j}" for j in range(k + 1, DIGITS)]]
        runs = rows.groupBy(*keys).agg(F.expr(f"transform(sort_array(collect_list(struct(d{k}, node))), x -> x.node)").alias("kids"))
        joint = f"IF(depth > {k}, sha2(concat_ws('', kids.hash), 256), kids[0].hash)"
        rows = runs.selectExpr(*keys, f"named_struct('hash', {joint}, 'kids', kids) AS node")
    return rows


def _spelled(blocks: DataFrame) -> DataFrame:
    """One row for each node nested in blocks (depth, node, path, ...), its steps put before the path of the block."""
    siblings = "concat_ws('', slice(node.kids.hash, 1, i))", f"concat_ws('', slice(node.kids.hash, i + 2, {_RUN}))"
    step = f"named_struct('before', {siblings[0]}, 'after', {siblings[1]})"
    rest = [c for c in blocks.columns if c not in ("node", "path")]
    rows = blocks
    for k in reversed(range(DIGITS)):
        rows = rows.selectExpr(*rest, "path", f"explode(transform(node.kids, (kid, i) -> named_struct('kid', kid, 'step', {step}))) AS part")
        rows = rows.selectExpr(*rest, f"IF(depth > {k}, concat(array(part.step), path), path) AS path", "part.kid AS node")
    return rows


def _met(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Each block with the path above it, brought together by (tree, block)."""
    above = [c for c in paths.columns if c not in ("tree", "block")]
    both = blocks.unionByName(paths, allowMissingColumns=True)
    values = [F.first(c, ignorenulls=True).alias(c) for c in ("depth", "node", *above)]
    return both.groupBy("tree", "block").agg(*values)


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """The stored blocks of every round, from nodes (tree, depth, rank, node) to one block for each tree."""
    most = nodes.agg(F.max("depth")).first()[0] or 0
    rounds = []
    while True:
        rounds.append(checkpointed(_blocks(nodes)))
        most -= DIGITS
        if most <= 0:
            return rounds
        nodes = rounds[-1].selectExpr("tree", f"greatest(depth - {DIGITS}, 0) AS depth", "block AS rank", f"{_UPPER} AS node")


_UPPER = "named_struct('hash', node.hash, 'id', named_struct('tree', tree, 'block', block))"


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "lang", key: str = "doc_id", other: str | None = None) -> DataFrame:
    """(key, leaf, other, subroot, root, path) for each row of docs.

    A leaf is `leaf_hash(columns)`. The rows of a value of `tree` (null is a value) ascend by `key`; while several
    nodes remain, each run of 8 becomes the hash of its hashes, a last run being shorter. The subroots, by ascending
    value of `tree` (null first, UTF-8 bytewise), likewise give `root`. `path` holds for every level up to the root the hashes
    left (`before`) and right (`after`) of the node in its run, as one string each; a level of a lone node holds two empty ones.
    `other` is SQL over docs kept for each row, such as the hash of a changed row.

    Rows with equal keys stand in the order of their leaves, a null key first; equal rows each have a place of their own.
    An empty table gives no rows. A lone row is its own root, with an empty path. Columns not named are left out, and
    none can clash: the leaves keep to a struct. Only hashes are shuffled, never texts.
    """
    hashed = docs.selectExpr(f"CAST({tree} AS STRING) AS tree", f"{key} AS id", f"{leaf_hash(columns)} AS hash", f"{other or 'CAST(NULL AS STRING)'} AS other")
    leaves = checkpointed(hashed).selectExpr("tree", "id", "hash", "named_struct('hash', hash, 'id', id, 'other', other) AS node")
    of_rows = _climbed(ranked(leaves, ("id", "hash")))
    tops = of_rows[-1].selectExpr("CAST(NULL AS STRING) AS tree", "tree AS id", f"{_UPPER} AS node")
    of_trees = _climbed(ranked(tops, ("id",)))
    paths = of_trees[-1].selectExpr("tree", "block", f"CAST(array() AS {_STEPS}) AS path", "node.hash AS root")
    for blocks in reversed(of_trees):
        found = _spelled(_met(blocks, paths))
        paths = found.selectExpr("node.id.tree AS tree", "node.id.block AS block", "path", "root", "node.hash AS subroot")
        if blocks is not of_trees[0]:
            paths = paths.drop("subroot")
    for blocks in reversed(of_rows[1:]):
        paths = _spelled(_met(blocks, paths)).selectExpr("node.id.tree AS tree", "node.id.block AS block", "path", "root", "subroot")
    found = _spelled(_met(of_rows[0], paths))
    return found.selectExpr(f"node.id AS {key}", "node.hash AS leaf", "node.other AS other", "subroot", "root", "path")


def tampered_leaf(columns: Sequence[str] = COLUMNS, key: str = "doc_id", text: str = "text") -> str:
    """SQL for the leaf after tampering: where 3 divides the checksum of the decimal key, A to Z of the text are lower-cased.

    Null elsewhere (also for a null key), as nothing was changed there.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = [f"translate({c}, '{upper}', '{upper.lower()}')" if c == text else c for c in columns]
    return f"IF(crc32(CAST(CAST({key} AS STRING) AS BINARY)) % 3 = 0, {leaf_hash(lowered)}, NULL)"
