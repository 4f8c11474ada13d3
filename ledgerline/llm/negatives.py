"""Hard negatives by exact integer scores, computed as float32 matrix products in a residue number system.

An integer score is known from its residues modulo a few primes, as long as their product exceeds twice its size. The
components' residues are so small that a float32 product over 64 of them is exact. How many primes are needed follows
from the longest vector of the table. Rows and anchors are packed into blocks; every block of anchors meets every block of rows
once in each of two passes (the stated query set against all rows), and each meeting keeps only what can be among the first
of an anchor, so that the final choice, a window over scores, reads a few rows for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import arrow_pass, checkpointed

BLOCK_ROWS, BLOCK_ANCHORS = 4096, 512
BLOCK_CELLS = 1 << 20  # components in a block of rows at most, unless a single row holds more
DEPTH = 64  # components multiplied before a reduction: 64 residues of at most 510, squared, stay below 2 ** 24
TASK_SCORES = 1 << 30  # scores computed by one task
_LOW = np.iinfo(np.int64).min


def primes() -> Iterator[int]:
    """The primes below 1024, downwards: half of one, squared and taken 64 times, is exact in float32."""
    for n in range(1023, 500, -1):
        if all(n % k for k in range(2, 32)):
            yield n


def enough_primes(most: int) -> list[int]:
    """So many primes that every integer of at most this size, of either sign, has residues of its own."""
    found, reach = [], 1
    for p in primes():
        if reach > 2 * most + 1:
            break
        found.append(p)
        reach *= p
    return found


def _centred(values: np.ndarray, p: int) -> np.ndarray:
    residues = values % p
    return (residues - p * (residues > p // 2)).astype(np.float32)


def exact_products(a: np.ndarray, b: np.ndarray, moduli: list[int]) -> np.ndarray:
    """All inner products of the integer rows of a and of b, from float32 products modulo each prime.

    Mixed-radix digits, each centred around zero, give signed values; all but the last sum stay below the product of
    the primes taken so far, and the result fits 64 bits as the moduli were chosen for it.
    """
    total, reach = np.zeros((len(a), len(b)), dtype=np.int64), 1
    for p in moduli:
        left, right = _centred(a, p), _centred(b, p)
        residues = np.zeros(total.shape, dtype=np.int64)
        for k in range(0, a.shape[1], DEPTH):
            residues += np.matmul(left[:, k : k + DEPTH], right[:, k : k + DEPTH].T).astype(np.int64)
            residues %= p
        digits = (residues - total % p) * pow(reach % p, -1, p) % p if reach > 1 else residues
        digits -= p * (digits > p // 2)
        total += digits * np.int64(reach)
        reach *= p
    return total


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows with `v`, their vector as integers floor(scale * x), and `norm`, its squared length.

    A row with a null vector, or with any null or non-finite component, takes no part; neither does one
    whose squared length is 2 ** 62 or more, as its scores need not fit 64 bits.
    """
    sound = f"{vector} IS NOT NULL AND NOT exists({vector}, x -> x IS NULL OR isnan(CAST(x AS DOUBLE)) OR abs(CAST(x AS DOUBLE)) = double('inf'))"
    size = f"aggregate({vector}, 0D, (s, x) -> s + pow(floor({scale}D * x), 2))"
    kept = rows.where(sound).where(f"{size} < pow(2D, 62)")
    return kept.withColumns({"v": F.expr(f"transform({vector}, x -> CAST(floor({scale}D * x) AS BIGINT))"), "norm": F.expr(size)})


def _list(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch[name][row].values


def _filled(flat: list[np.ndarray], width: int, kind: str) -> bytes:
    """Vectors as the rows of one matrix, the shorter ones filled with zeros."""
    out = np.zeros((len(flat), width), dtype=kind)
    for k, v in enumerate(flat):
        out[k, : len(v)] = v
    return out.tobytes()


def _packed(rows: DataFrame, most: int, kind: str, columns: list[str]) -> DataFrame:
    """Blocks of at most `most` rows (id, ..., v): a list of each column, ordered by id, and one matrix.

    `v` holds integers, or the bytes of some. A task keeps one block in memory, bounded in rows and in components.
    """
    fields = [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in columns]
    schema = T.StructType([*fields, T.StructField("width", T.IntegerType()), T.StructField("matrix", T.BinaryType())])
    as_bytes = isinstance(rows.schema["v"].dataType, T.BinaryType)

    def block(parts: list[pa.RecordBatch], names: list[str]) -> pa.RecordBatch:
        held = pa.Table.from_batches(parts).combine_chunks()
        held = held.take(pc.sort_indices(held["id"], null_placement="at_start"))
        if as_bytes:
            flat = [np.frombuffer(x, dtype=kind) for x in held["v"].to_pylist()]
        else:
            flat = [np.asarray(x, dtype=np.int64) for x in held["v"].to_pylist()]
        width = max(map(len, flat))
        lists = [pa.ListArray.from_arrays(pa.array([0, held.num_rows], pa.int32()), pa.concat_arrays(held[c].chunks)) for c in columns]
        return pa.RecordBatch.from_arrays([*lists, pa.array([width], pa.int32()), pa.array([_filled(flat, width, kind)])], names=names)

    def step(batches):
        held, rows_held, widest = [], 0, 1
        names = [*columns, "width", "matrix"]
        for batch in batches:
            lengths = pc.binary_length(batch["v"]) if as_bytes else pc.list_value_length(batch["v"])
            sizes = lengths.to_numpy(zero_copy_only=False) // (np.dtype(kind).itemsize if as_bytes else 1)
            at = 0
            for k, size in enumerate(sizes.tolist()):
                if rows_held and (rows_held >= most or (rows_held + 1) * max(widest, size) > BLOCK_CELLS):
                    if k > at:
                        held.append(batch.slice(at, k - at))
                    yield block(held, names)
                    held, rows_held, widest, at = [], 0, 1, k
                rows_held, widest = rows_held + 1, max(widest, size)
            if batch.num_rows > at:
                held.append(batch.slice(at))
        if rows_held:
            yield block(held, names)

    return arrow_pass(rows.select(*columns, "v"), step, schema)


def _anchors_of(blocks: DataFrame, kind: str) -> DataFrame:
    """(key, id, label, v) of the rows of blocks that are anchors; the key tells rows with equal ids apart."""
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("id", blocks.schema["id"].dataType.elementType),
            T.StructField("label", blocks.schema["label"].dataType.elementType),
            T.StructField("v", T.BinaryType()),
        ]
    )

    def step(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                at = np.flatnonzero(_list(batch, "anchor", row).to_numpy(zero_copy_only=False))
                if len(at):
                    matrix = _matrix(batch, row, kind)
                    keys = pa.array(batch["block"][row].as_py() * BLOCK_ROWS + at)
                    columns = [keys, _list(batch, "id", row).take(pa.array(at)), _list(batch, "label", row).take(pa.array(at))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([matrix[k].tobytes() for k in at])], names=["key", "id", "label", "v"])

    return arrow_pass(blocks, step, schema)


def _matrix(batch: pa.RecordBatch, row: int, kind: str, prefix: str = "") -> np.ndarray:
    width = batch[f"{prefix}width"][row].as_py()
    flat = np.frombuffer(batch[f"{prefix}matrix"][row].as_buffer(), dtype=kind)
    return flat.reshape(-1, width) if width else np.zeros((len(_list(batch, f"{prefix}id", row)), 0), dtype=kind)


def _codes(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the values are."""
    numbers = pa.concat_arrays([left, right]).dictionary_encode().indices.to_numpy()
    return numbers[: len(left)], numbers[len(left) :]


def _first(scores: np.ndarray, allowed: np.ndarray, most: int):
    """(row, column) of the `most` highest allowed scores of each row; columns come in the order of ties."""
    if scores.shape[1] > most:
        masked = np.where(allowed, scores, _LOW)
        bound = np.partition(masked, -most, axis=1)[:, -most]
        allowed = allowed & (scores >= bound[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < most], column[place < most]


def _meetings(blocks: DataFrame, anchors: DataFrame, cells: tuple[int, int]) -> DataFrame:
    """Each block of rows with each block of anchors, dealt over a grid of cells that keeps the copies of both few."""
    of_rows, of_anchors = cells
    dealt = blocks.selectExpr("*", f"pmod(xxhash64(block), {of_rows}) AS r", f"explode(sequence(0, {of_anchors - 1})) AS a")
    named = [f"{c} AS a_{c}" for c in anchors.columns]
    repeated = anchors.selectExpr(*named, f"pmod(xxhash64(key), {of_anchors}) AS a", f"explode(sequence(0, {of_rows - 1})) AS r")
    dealt = dealt.selectExpr("* EXCEPT (r, a)", f"CAST(r * {of_anchors} + a AS INT) AS cell")
    repeated = repeated.selectExpr("* EXCEPT (r, a)", f"CAST(r * {of_anchors} + a AS INT) AS cell")
    count = max(of_rows * of_anchors // 4, min(of_rows * of_anchors, 2 * blocks.sparkSession.sparkContext.defaultParallelism))
    return dealt.repartition(count, "cell").join(repeated.repartition(count, "cell"), "cell").drop("cell")


def hard_negatives(
    rows: DataFrame, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (3, 10), high: tuple[int, int] = (9, 10), scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows (id, label, embedding, anchor).

    Scores are inner products of the vectors as integers (`whole_vectors`). The positives of an anchor are its
    first rows of the same label, the row itself left out; the negatives for a positive are the first rows of another
    label whose score lies between the fractions `low` and `high` of the positive's, both included. Higher scores come first, ties by
    smaller id, a null id being smallest; rows that agree in both are alike in the result. With fewer rows than asked for, all are returned.

    Rows with a null label or a vector that `whole_vectors` leaves out take no part; `anchor` null is no anchor. Repeated rows are
    rows of their own. A shorter vector counts as filled with zeros. Empty tables, and anchors without a positive or without
    a negative in reach, give no rows. Ids and labels may be of any type that has an order; other columns are not read.
    """
    kept = whole_vectors(rows.select("id", "label", "embedding", "anchor").where("label IS NOT NULL"), scale=scale)
    sizes = kept.agg(F.max("norm").alias("most"), F.count("*").alias("n"), F.count_if(F.coalesce("anchor", F.lit(False))).alias("anchors")).first()
    most = math.ceil((sizes["most"] or 0) * (1 + 2**-40)) + 1
    moduli = enough_primes(most)
    kind = next(k for k in ("<i2", "<i4", "<i8") if math.isqrt(most) < np.iinfo(k).max)
    spark = rows.sparkSession
    count, asked = max(sizes["n"], 1), max(sizes["anchors"], 1)
    tasks = max(math.ceil(count * asked / TASK_SCORES), min(math.ceil(count / BLOCK_ROWS) * 2, 4 * spark.sparkContext.defaultParallelism))
    cells = tuple(max(1, math.ceil(math.sqrt(tasks * ratio))) for ratio in (count / asked, asked / count))
    cells = (min(cells[0], math.ceil(tasks / cells[1])), cells[1])

    plain = kept.selectExpr("id", "label", "coalesce(anchor, false) AS anchor", "v")
    number = F.expr("shiftleft(CAST(spark_partition_id() AS BIGINT), 20) + (monotonically_increasing_id() & 1048575)")
    blocks = checkpointed(_packed(plain, BLOCK_ROWS, kind, ["id", "label", "anchor"]).withColumn("block", number))
    anchors = checkpointed(_anchors_of(blocks, kind).repartition(math.ceil(asked / BLOCK_ANCHORS)))
    asking = _packed(anchors, BLOCK_ANCHORS, kind, ["id", "label", "key"])
    near = _best(_meetings(blocks, asking, cells), kind, moduli, positives)
    first = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_first("other"))
    near = near.withColumn("n", F.row_number().over(first)).where(f"n <= {positives}")
    chosen = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "other", "score"))).alias("chosen"))
    chosen = checkpointed(anchors.join(chosen, "key")).repartition(math.ceil(asked / BLOCK_ANCHORS))
    asking = _packed(chosen, BLOCK_ANCHORS, kind, ["id", "label", "key", "chosen"])
    far = _between(_meetings(blocks, asking, cells), kind, moduli, negatives, low, high)
    first = Window.partitionBy("key", "n").orderBy(F.desc("negative_score"), F.asc_nulls_first("negative_id"))
    ranked = far.withColumn("rank", F.row_number().over(first)).where(f"rank <= {negatives}")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _scored(batch: pa.RecordBatch, row: int, kind: str, moduli: list[int]):
    """Scores of the anchors of one meeting with its rows, and where their labels agree."""
    rows, anchors = _matrix(batch, row, kind).astype(np.int64), _matrix(batch, row, kind, "a_").astype(np.int64)
    width = min(rows.shape[1], anchors.shape[1])
    scores = exact_products(anchors[:, :width], rows[:, :width], moduli)
    own, other = _codes(_list(batch, "a_label", row), _list(batch, "label", row))
    return scores, own[:, None] == other[None, :]


def _best(meetings: DataFrame, kind: str, moduli: list[int], most: int) -> DataFrame:
    """(key, other, score): the first rows of the same label for each anchor, within each meeting."""
    ids = meetings.schema["id"].dataType.elementType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("other", ids), T.StructField("score", T.LongType())])

    def step(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                scores, same = _scored(batch, row, kind, moduli)
                keys = _list(batch, "a_key", row).to_numpy()
                own = keys - batch["block"][row].as_py() * BLOCK_ROWS
                here = np.flatnonzero((own >= 0) & (own < scores.shape[1]))
                same[here, own[here]] = False
                anchor, at = _first(scores, same, most)
                found = [pa.array(keys[anchor]), _list(batch, "id", row).take(pa.array(at)), pa.array(scores[anchor, at])]
                yield pa.RecordBatch.from_arrays(found, names=["key", "other", "score"])

    return arrow_pass(meetings.drop("anchor"), step, schema)


def _between(meetings: DataFrame, kind: str, moduli: list[int], most: int, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """The first rows of another label in reach of each positive of an anchor, within each meeting."""
    ids = meetings.schema["id"].dataType.elementType
    long, names = T.LongType(), ("key", "n", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, (long, T.IntegerType(), ids, ids, long, ids, long))])

    def scaled(scores: np.ndarray, part: tuple[int, int], up: bool) -> np.ndarray:
        """The fraction of scores, rounded up or down, without leaving 64 bits."""
        times, by = part
        whole, rest = np.divmod(scores, by)
        return whole * times + (-(-rest * times // by) if up else rest * times // by)

    def step(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                scores, same = _scored(batch, row, kind, moduli)
                lists = _list(batch, "a_chosen", row)
                flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
                owner = np.repeat(np.arange(len(sizes)), sizes)
                targets = flat.field("score").to_numpy()
                least, highest = scaled(targets, low, True), scaled(targets, high, False)
                keys, anchor_ids = _list(batch, "a_key", row), _list(batch, "a_id", row)
                for first in range(0, int(sizes.max(initial=0))):
                    # the next positive of every anchor that has one
                    at = np.flatnonzero(np.arange(len(owner)) - np.searchsorted(owner, owner) == first)
                    own = scores[owner[at]]
                    allowed = ~same[owner[at]] & (own >= least[at, None]) & (own <= highest[at, None])
                    asked, column = _first(own, allowed, most)
                    if len(asked):
                        which = pa.array(at[asked])
                        of_anchor = pa.array(owner[at[asked]])
                        found = [keys.take(of_anchor), flat.field("n").take(which), anchor_ids.take(of_anchor), flat.field("other").take(which)]
                        found += [flat.field("score").take(which), _list(batch, "id", row).take(pa.array(column)), pa.array(own[asked, column])]
                        yield pa.RecordBatch.from_arrays(found, names=list(names))

    return arrow_pass(meetings.drop("anchor"), step, schema)
