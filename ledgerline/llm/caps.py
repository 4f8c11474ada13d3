"""Near-duplicate vectors found through spherical caps around the directions of a random product code."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import arrow_pass, checkpointed
from ledgerline.llm.components import components

THRESHOLD = 0.98
PARTS = 4  # a direction is made of one word from each of so many codebooks
LEAST = 24  # directions that every vector is under, whatever its place
SPARE = 4  # directions there are for each listing of a vector under one: a lone vector meets few others
GROUP = 1024  # vectors compared with each other at once: a larger group is cut into blocks, taken in pairs
SEED = 11
_ROWS = 512  # vectors decoded at once


@lru_cache(maxsize=8)
def _code(dim: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """A rotation of `dim` components into PARTS equal parts, and a codebook of words of equal length for each part.

    A part of one component has two words. With four components or fewer there are 16 directions then, and all
    vectors of a label are compared.
    """
    part = max(1, math.ceil(dim / PARTS))
    rnd = np.random.default_rng([SEED, dim, words])
    turn, _ = np.linalg.qr(rnd.standard_normal((part * PARTS, part * PARTS)))
    books = rnd.standard_normal((PARTS, words, part)) if part > 1 else np.array([[[1.0], [-1.0]]] * PARTS)
    return turn[:dim], books / np.linalg.norm(books, axis=2, keepdims=True) / math.sqrt(PARTS)


def _ragged(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places in two ascending lists of owners that have the same owner."""
    low, high = np.searchsorted(right, left), np.searchsorted(right, left, side="right")
    sizes = high - low
    return np.repeat(np.arange(len(left)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - low, sizes)


def _sums(lists: list[np.ndarray]) -> np.ndarray:
    """The LEAST largest sums of one entry from each list, row by row; a sum of the largest needs only the largest of each."""

    def top(x: np.ndarray) -> np.ndarray:
        return x if x.shape[1] <= LEAST else -np.partition(-x, LEAST - 1, axis=1)[:, :LEAST]

    best = [top(x) for x in lists]
    while len(best) > 1:
        best = [top((a[:, :, None] + b[:, None, :]).reshape(len(a), -1)) for a, b in zip(best[::2], best[1::2])]
    return best[0]


def list_decode(vectors: np.ndarray, words: int, cap: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction): all directions whose product with a unit vector is at least `cap`, at least LEAST of them.

    A direction's product is the sum of its parts' products. Words are kept while the best words of all other parts
    could still lift them over the cap, then pairs of words, then pairs of pairs: what is spelled out is little more than the result.
    """
    turn, books = _code(vectors.shape[1], words)
    parts = np.split(vectors @ turn, PARTS, axis=1)
    products = [p @ b.T for p, b in zip(parts, books)]
    needed = np.minimum(cap, _sums(products).min(axis=1)) - 1e-12
    best = [p.max(axis=1) for p in products]
    total = sum(best)
    lists = []
    for p, top in zip(products, best):
        row, word = np.nonzero(p >= (needed - total + top)[:, None] - 1e-12)
        lists.append((row, word.astype(np.int64), p[row, word], top))
    while len(lists) > 1:
        joined = []
        for (row, word, value, top), (row2, word2, value2, top2) in zip(lists[::2], lists[1::2]):
            a, b = _ragged(row, row2)
            value, top = value[a] + value2[b], top + top2
            over = np.flatnonzero(value >= (needed - total + top)[row[a]] - 1e-12)
            # numbers of equal length on both sides, so a shift by the second's range keeps them apart
            span = books.shape[1] ** (PARTS // len(lists))
            joined.append((row[a[over]], word[a[over]] * span + word2[b[over]], value[over], top))
        lists = joined
    return lists[0][0], lists[0][1]


def cap_for(dim: int, words: int) -> float:
    """The product that about LEAST of all directions exceed for a vector in random position."""
    return NormalDist().inv_cdf(1 - min(0.5, LEAST / words**PARTS)) / math.sqrt(max(dim, 1))


def _under_caps(classes: DataFrame, words: int) -> DataFrame:
    """Add `caps`, the ascending directions each vector is under."""

    def step(batches):
        for batch in batches:
            flat = [np.asarray(v, dtype=np.float64) for v in batch["v"].to_pylist()]
            dims = np.array([len(v) for v in flat], dtype=np.int64)
            caps: list = [None] * len(flat)
            for dim in np.unique(dims).tolist():
                members = np.flatnonzero(dims == dim)
                for k in range(0, len(members), _ROWS):
                    some = members[k : k + _ROWS]
                    vectors = np.stack([flat[m] for m in some])
                    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # squares of any component stay finite
                    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
                    row, direction = list_decode(vectors, words, cap_for(dim, words))
                    order = np.lexsort((direction, row))
                    for m, own in zip(some, np.split(direction[order], np.cumsum(np.bincount(row, minlength=len(some)))[:-1])):
                        caps[m] = own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(caps, pa.list_(pa.int64()))], names=[*batch.schema.names, "caps"])

    schema = T.StructType([*classes.schema.fields, T.StructField("caps", T.ArrayType(T.LongType()))])
    return arrow_pass(classes, step, schema)


def _cells(classes: DataFrame) -> DataFrame:
    """(cap, i, j, own, class, ...): the members of each direction that has several, in cells of two blocks at most."""
    listed = classes.selectExpr("class", "label", "dim", "explode(caps) AS cap")
    shared = listed.groupBy("label", "dim", "cap").agg(F.count("*").alias("n")).where("n > 1")
    shared = checkpointed(shared.selectExpr("label AS _label", "dim AS _dim", "cap AS _cap", f"CAST(ceil(n / {GROUP}) AS INT) AS blocks"))
    same = (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim")) & (F.col("cap") == F.col("_cap"))
    active = listed.join(shared, same).selectExpr("class AS _class", "cap", "blocks", "CAST(pmod(xxhash64(class, cap), blocks) AS INT) AS own")
    dealt = active.selectExpr("_class", "cap", "own", "explode(sequence(0, blocks - 1)) AS other")
    members = dealt.join(classes, F.col("_class") == F.col("class"))
    return members.selectExpr("cap", "least(own, other) AS i", "greatest(own, other) AS j", "own", "class", "label", "dim", "n", "v", "caps")


def _linked(cells: DataFrame, threshold: float) -> DataFrame:
    """(class, other, n): what the verified pairs of a cell add to the links of a class, and a link towards the smallest class of its component there."""
    schema = T.StructType([T.StructField("class", T.LongType()), T.StructField("other", T.LongType()), T.StructField("n", T.LongType())])
    keys = ("label", "dim", "cap", "i", "j")

    def cell(table: pa.Table) -> pa.RecordBatch | None:
        x = np.array(table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(table.num_rows, -1)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        own, numbers, copies = (table[c].to_numpy() for c in ("own", "class", "n"))
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        if table["i"][0].as_py() != table["j"][0].as_py():
            near &= own[:, None] != own[None, :]
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            return None
        near = near[np.ix_(linked, linked)]
        # a pair is counted in the cell of its first common direction alone
        lists = table["caps"].combine_chunks().take(pa.array(linked))
        flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(linked)), np.diff(lists.offsets.to_numpy()))
        before = flat < table["cap"][0].as_py()
        _, column, uses = np.unique(flat[before], return_inverse=True, return_counts=True)
        several = uses[column] > 1
        earlier = np.zeros((len(linked), len(uses)), dtype=np.float32)
        earlier[row[before][several], column[several]] = 1
        earlier = earlier[:, uses > 1]
        counted = near & ((earlier @ earlier.T) == 0)
        numbers, copies = numbers[linked], copies[linked]
        # components inside the cell: the smallest class in reach, then its own smallest, until nothing changes
        order = np.argsort(numbers)
        near, rank = near[np.ix_(order, order)], np.arange(len(linked))
        reach = rank
        while True:
            lower = np.minimum(reach, np.where(near, reach[None, :], len(rank)).min(axis=1))
            lower = lower[lower]
            if (lower == reach).all():
                break
            reach = lower
        root = np.empty(len(rank), dtype=np.int64)
        root[order] = numbers[order][reach]
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(root), pa.array(counted @ copies)], names=["class", "other", "n"])

    def step(batches):
        held, at = [], None
        for batch in batches:
            found = list(zip(*(batch[k].to_pylist() for k in keys)))
            first = 0
            for k in range(len(found) + 1):
                if k == len(found) or found[k] != at:
                    if k > first:
                        held.append(batch.slice(first, k - first))
                    if k < len(found):
                        if held and (out := cell(pa.Table.from_batches(held))):
                            yield out
                        held, at, first = [], found[k], k
        if held and (out := cell(pa.Table.from_batches(held))):
            yield out

    rows = cells.repartition(*keys).sortWithinPartitions(*keys)
    return arrow_pass(rows, step, schema)


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id) for each row (id, label, embedding): other vectors of its label with at least this cosine.

    Every vector is listed under all directions of a random product code that exceed a common threshold, and under at least
    LEAST; the size of the code grows with the table, so that a vector without neighbours shares few directions.
    Vectors under one direction are compared in double precision. No pair below the threshold is linked, and a pair
    above it is missed only if its lists share nothing (the README has the recall). n_links counts rows, component_id is
    the smallest id reachable by links, the row itself included.

    Equal vectors of a label are one class and are compared once. A null label or vector, a vector of zeros, an empty one,
    and one with a null or non-finite component link with nothing; neither do vectors of different length. Repeated rows, and
    rows with equal or null ids, are rows of their own; a null id is never the smallest. No rows give none. Other columns are not read.
    """
    odd = "x -> x IS NULL OR isnan(CAST(x AS DOUBLE)) OR abs(CAST(x AS DOUBLE)) = double('inf')"
    sound = f"coalesce(label IS NOT NULL AND NOT exists(embedding, {odd}) AND exists(embedding, x -> x <> 0), false)"
    plain = rows.selectExpr("id", "label", f"IF({sound}, embedding, NULL) AS embedding")
    grouped = plain.where("embedding IS NOT NULL").groupBy("label", "embedding").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    numbered = checkpointed(grouped.withColumn("class", F.monotonically_increasing_id()))
    words = max(8, math.ceil((SPARE * LEAST * max(numbered.count(), 1)) ** (1 / PARTS)))
    vectors = numbered.selectExpr("class", "label", "size(embedding) AS dim", "n", "embedding AS v")
    listed = checkpointed(_under_caps(vectors, words))
    found = checkpointed(_linked(_cells(listed), threshold))
    counts = found.groupBy("class").agg(F.sum("n").alias("more")).selectExpr("class AS _class", "more")
    roots = components(found.selectExpr("class AS a", "other AS b"))
    firsts = numbered.select("class", "first")
    least = roots.join(firsts, F.col("node") == F.col("class")).groupBy("root").agg(F.min("first").alias("least"))
    of_class = roots.join(least, "root").selectExpr("node AS _node", "least", "true AS linked")
    known = numbered.join(counts, F.col("class") == F.col("_class"), "left").join(of_class, F.col("class") == F.col("_node"), "left")
    known = known.selectExpr(
        "label AS _l", "embedding AS _e", "n - 1 + coalesce(more, 0) AS n_links", "IF(linked, least, first) AS component_id"
    )
    joined = plain.join(known, (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e")), "left")
    return joined.selectExpr("id", "coalesce(n_links, 0L) AS n_links", "coalesce(component_id, id) AS component_id")
