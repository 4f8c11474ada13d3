"""SimHash near-duplicates, found by meeting in the middle of small Hamming balls."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, NOT_SPACE, Words, arrow_pass, as_bytes, checkpointed
from ledgerline.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42  # of the shingle hash
BLOCK_VARIANTS = 1 << 20  # variants that one block of the variant space holds on average
TASK_VARIANTS = 1 << 20  # variants held in memory at once: some 80 MB
HOT_FACTOR = 16  # a block with so many times the average is divided before the shuffle
FINER = 8  # by so many more bits
_SLICE = 1 << 15


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): 64-bit SimHash of each text over its word shingles, repeats counted.

    Letters A to Z are lower-cased; a text with fewer words than a shingle is one shingle;
    a null or empty text, or one of white space only, has fingerprint 0.
    """

    def step(batches):
        for batch in batches:
            texts = [b" ".join((t or b"").translate(LOWER).split()) for t in as_bytes(batch["text"])]
            values = pa.array(_simhash(texts, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], values], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(docs.select("doc_id", "text"), step, f"doc_id {kind}, fp long")


def _simhash(texts: list[bytes], shingle: int) -> np.ndarray:
    import xxhash

    words = Words(texts, NOT_SPACE)
    counts = np.diff(words.bounds)
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), shingles)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = words.bounds[owner] + offset
    last = np.minimum(first + shingle, words.bounds[owner + 1]) - 1
    buffer, hashed = words.buffer, xxhash.xxh64_intdigest
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    for lo in range(0, len(owner), _SLICE):
        part = slice(lo, lo + _SLICE)
        starts, ends = words.starts[first[part]].tolist(), words.ends[last[part]].tolist()
        values = np.array([hashed(buffer[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[part]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        ones[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


# A ball of radius 3 is covered by one flip on one side and two on the other. Of three different
# bits two always lie in the same half of the word, so pairs of flips within a half suffice.
# The variants are dealt by their lowest `half` bits of either half: their block.


def _flips(half: int, radius: int) -> list[int]:
    """Changes that the flips of a fingerprint make to the number of its block."""
    most = (radius + 1) // 2
    sides = [[1 << i for i in range(half)], [1 << (half + i) for i in range(half)]]
    out = [0]
    if most >= 1:
        out += sides[0] + sides[1]
    if most >= 2:
        out += [a ^ b for side in sides for a, b in combinations(side, 2)]
    return out


def _block(half: int) -> str:
    low = (1 << half) - 1
    return f"((fp & {low}L) | shiftleft(shiftright(fp, 32) & {low}L, {half}))"


def _coarser(number: str, fine: int, half: int) -> str:
    low = (1 << half) - 1
    return f"(({number} & {low}L) | shiftleft(shiftright({number}, {fine}) & {low}L, {half}))"


def _dealt(fps: DataFrame, half: int, radius: int, hot: int) -> DataFrame:
    """(half, block, fp): each fingerprint once for every block that holds a variant of it."""
    flips = ", ".join(f"{m}L" for m in _flips(half, radius))
    rows = fps.selectExpr("fp", f"explode(transform(array({flips}), m -> {_block(half)} ^ m)) AS block")
    heavy = fps.groupBy(F.expr(_block(half)).alias("block")).count().where(f"count > {hot}").selectExpr("block", "true AS heavy")
    rows = rows.join(heavy, "block", "left")
    fine = half + FINER // 2
    finer = ", ".join(f"{m}L" for m in _flips(fine, radius))
    deeper = (
        rows.where("heavy")
        .selectExpr("block AS above", "fp", f"explode(transform(array({finer}), m -> {_block(fine)} ^ m)) AS block")
        .where(f"{_coarser('block', fine, half)} = above")
    )
    plain = rows.where("heavy IS NULL").selectExpr(f"{half} AS half", "block", "fp")
    return plain.unionAll(deeper.selectExpr(f"{fine} AS half", "block", "fp"))


def near_pairs(fps: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) at most `radius` <= 3 bits apart.

    Not all pairs: enough of them that exactly the fingerprints reachable by links stay
    connected. Every fingerprint emits its variants; those are shuffled by block, a
    fingerprint being sent once to each block that holds variants of it, and spelled out there.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the radius must be 0 to 3")
    count = fps.count()
    half = max(4, math.ceil(math.log2(max(count * 1057 / BLOCK_VARIANTS, 1)) / 2))
    rows = _dealt(fps, half, radius, HOT_FACTOR * max(BLOCK_VARIANTS // 1057, math.ceil(count / 4**half)))

    def step(batches):
        parts = [np.stack([b["half"].to_numpy(), b["block"].to_numpy(), b["fp"].to_numpy()]) for b in batches if b.num_rows]
        if not parts:
            return
        halves, blocks, values = np.concatenate(parts, axis=1)
        order = np.lexsort((blocks, halves))
        halves, blocks, values = halves[order], blocks[order], values[order].view(np.uint64)
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(halves) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
            if hi - lo > 1:
                left, right = _block_links(values[lo:hi], int(halves[lo]), int(blocks[lo]), radius)
                if len(left):
                    yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], names=["a", "b"])

    dealt = rows.repartition("half", "block").selectExpr("CAST(half AS BIGINT) AS half", "block", "fp")
    return arrow_pass(dealt, step, "a long, b long")


def _numbers(fps: np.ndarray, half: int) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    return (fps & low) | (((fps >> np.uint64(32)) & low) << np.uint64(half))


def _block_links(fps: np.ndarray, half: int, block: int, radius: int):
    """Links among the fingerprints that have variants in one block; a spanning forest of them."""
    free = 32 - half
    if len(fps) * (1 + 2 * free + free * (free - 1)) > TASK_VARIANTS and half < 28:
        # too many for memory: divide the block by one more bit of either half
        found, finer, low = [], half + 1, (1 << half) - 1
        own, flips = _numbers(fps, finer), np.array(_flips(finer, radius), dtype=np.uint64)
        for child in range(4):
            low_part, high_part = block & low, block >> half
            number = (low_part | ((child & 1) << half)) | ((high_part | ((child >> 1) << half)) << finer)
            inside = fps[np.isin(own ^ np.uint64(number), flips)]
            if len(inside) > 1:
                found.append(_block_links(inside, finer, number, radius))
        if not found:
            return fps[:0], fps[:0]
        return _forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    close, far = _masks(half, radius)
    parts = []
    for change, members in _by_change(_numbers(fps, half) ^ np.uint64(block)):
        for masks, near in ((close.get(change), True), (far.get(change), False)):
            if masks is not None:
                parts.append(((fps[members][:, None] ^ masks[None, :]).ravel(), np.repeat(members, len(masks)), near))
    variants = np.concatenate([p[0] for p in parts])
    member = np.concatenate([p[1] for p in parts])
    near = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    order = np.argsort(variants)
    variants = variants[order]
    same = variants[1:] == variants[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    variants, member, near = variants[keep], member[order][keep], near[order][keep]
    if not len(variants):
        return fps[:0], fps[:0]
    # Within a variant, members one flip away are close to all members: any of them is a hub.
    firsts = np.concatenate([[0], np.flatnonzero(variants[1:] != variants[:-1]) + 1])
    hub = np.minimum.reduceat(np.where(near, fps[member], np.uint64(2**64 - 1)), firsts)
    has_hub = np.logical_or.reduceat(near, firsts)
    sizes = np.diff(np.append(firsts, len(variants)))
    left, right = np.repeat(hub, sizes), fps[member]
    kept = np.repeat(has_hub, sizes) & (left != right)
    left, right = left[kept], right[kept]
    verified = np.bitwise_count(left ^ right) <= radius
    return _forest(left[verified], right[verified])


def _by_change(changes: np.ndarray):
    for change in np.unique(changes):
        yield int(change), np.flatnonzero(changes == change)


def _masks(half: int, radius: int):
    """Flips by the change they make to the block: those of the smaller ball, and the rest of the larger."""
    sides = [range(0, 32), range(32, 64)]
    close, far = {}, {}

    def put(into, *bits):
        mask = sum(1 << b for b in bits)
        change = sum(1 << (b if b < 32 else b - 32 + half) for b in bits if b % 32 < half)
        into.setdefault(change, []).append(mask)

    put(close)
    if radius >= 1:
        for side in sides:
            for b in side:
                put(close if radius >= 2 else far, b)
    if radius >= 3:
        for side in sides:
            for a, b in combinations(side, 2):
                put(far, a, b)
    return ({k: np.array(v, dtype=np.uint64) for k, v in x.items()} for x in (close, far))


def _forest(left: np.ndarray, right: np.ndarray):
    """The links without those that close a circle."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    pairs = np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b))
    parent = list(range(len(nodes)))
    kept = []
    for pair in pairs.tolist():
        x, y = divmod(pair, len(nodes))
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(pair)
    kept = np.array(kept, dtype=np.int64)
    return nodes[kept // max(len(nodes), 1)], nodes[kept % max(len(nodes), 1)]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs (doc_id, text, ...).

    component_id is the smallest doc_id of all documents reachable over links of at most
    `max_bits` differing fingerprint bits, the document itself included.

    Equal fingerprints are one node, so thousands of copies cost one. Null, empty and blank
    texts share fingerprint 0 and are linked like any other. Rows with a repeated doc_id are
    nodes of their own; a null doc_id is never the smallest (component_id is null if no other
    member has one). Other columns are left out, whatever their names.
    """
    marked = checkpointed(fingerprints(docs, shingle))
    nodes = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = checkpointed(components(near_pairs(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp"))
    firsts = roots.join(nodes, "fp").groupBy("root").agg(F.min("first").alias("least"))
    joined = roots.join(firsts, "root").select("fp", "least", F.lit(True).alias("linked"))
    of_node = nodes.join(joined, "fp", "left").selectExpr("fp AS node", "IF(linked, least, first) AS component_id")
    of_node = checkpointed(of_node)
    return marked.join(of_node, marked["fp"] == of_node["node"]).select("doc_id", "fp", "component_id")
