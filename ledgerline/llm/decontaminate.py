"""Benchmark decontamination: a broadcast set of test n-grams against the word windows of each text."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import LOWER, Words, append, arrow_pass, as_bytes, byte_class, checkpointed, extended, without
from ledgerline.llm.common import window_hashes

# fixed values: what a word of the normalised text consists of
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTES = byte_class(*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))

NGRAM = 10
BLOCK_PAIRS = 200_000  # (n-gram, item) pairs broadcast at once: about 25 MB
CHAIN = 4  # blocks that may follow one another inside one job

LEAKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def item_grams(items: DataFrame, n: int = NGRAM) -> DataFrame:
    """Distinct (gram, item_id) pairs: all n consecutive words of an item, or all its words if they are fewer."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    words = items.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.regexp_extract_all(F.translate("text", upper, lower), F.lit(WORD), F.lit(0)).alias("words"),
    ).where("size(words) > 0 AND item_id IS NOT NULL")
    starts = f"sequence(0, greatest(size(words) - {n}, 0))"
    gram = f"transform({starts}, i -> concat_ws(' ', slice(words, i + 1, {n})))"
    return words.selectExpr("item_id", f"explode({gram}) AS gram").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, n: int = NGRAM, clean: str | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Add column `leaks`: words of a text inside any n-gram of a benchmark item, and the items concerned.

    docs: (text, any other columns); items: (item_id, text). `leaks` has n_words, n_hit,
    items (sorted as strings) and spans (word numbers [first, after) of maximal hit runs).
    With `clean`, a column of that name holds the text without the bytes of those runs.
    The n-grams are counted first. At most `block_pairs` of them are broadcast at once; a
    larger benchmark is cut by hash into blocks, which scan the texts one after another.
    A hash hit counts only if the words are equal.

    A null or empty text has no words and stays as it is; items without words or id cannot occur. Repeated
    rows are judged alike, each on its own. Input columns named `leaks` or like `clean` are replaced.
    """
    pairs = checkpointed(item_grams(items, n))
    blocks = max(1, math.ceil(pairs.count() * 1.25 / block_pairs))
    docs = without(docs, "leaks", *([clean] if clean else []))
    found = docs
    for block in range(blocks):
        rows = pairs.where(F.expr(f"pmod(xxhash64(gram, item_id), {blocks})") == block).collect()
        grams: dict[bytes, list[str]] = defaultdict(list)
        for row in rows:
            grams[row["gram"].encode()].append(row["item_id"])
        shared = docs.sparkSession.sparkContext.broadcast(dict(grams))
        last = block == blocks - 1
        fields = [T.StructField("leaks", LEAKS)]
        if clean and last:
            fields.append(T.StructField(clean, T.StringType()))
        schema = extended(without(found, "leaks"), *fields)
        found = arrow_pass(found, _scan(shared, block > 0, clean if last else None), schema)
        if not last and block % CHAIN == CHAIN - 1:
            found = checkpointed(found)
    return found


class _Grams:
    """Hash lookup of the n-grams by their number of words."""

    def __init__(self, grams: dict[bytes, list[str]]):
        self.grams = grams
        texts = list(grams)
        words = Words(texts, WORD_BYTES)
        hashes = words.hashes()
        by_size = defaultdict(list)
        for k in range(len(texts)):
            lo, hi = words.bounds[k], words.bounds[k + 1]
            by_size[int(hi - lo)].append(window_hashes(hashes[lo:hi], int(hi - lo))[0])
        self.by_size = {}
        for size, values in by_size.items():
            values = np.unique(np.array(values, dtype=np.uint64))
            seen = np.zeros(1 << 20, dtype=bool)
            seen[values >> np.uint64(44)] = True
            self.by_size[size] = (values, seen)

    def hits(self, words: Words) -> list[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each window that equals an n-gram."""
        out = []
        hashes = words.hashes()
        for size, (values, seen) in self.by_size.items():
            windows = window_hashes(hashes, size)
            at = np.flatnonzero(seen[windows >> np.uint64(44)])
            at = at[values[np.minimum(np.searchsorted(values, windows[at]), len(values) - 1)] == windows[at]]
            at = at[words.text_of(at) == words.text_of(at + size - 1)]
            for k in at.tolist():
                items = self.grams.get(words.phrase(k, k + size))
                if items:
                    out.append((k, size, items))
        return out


def _scan(shared, again: bool, clean: str | None):
    def step(batches):
        grams = None
        for batch in batches:
            grams = grams or _Grams(shared.value)
            earlier = batch["leaks"].to_pylist() if again else [None] * batch.num_rows
            if again:
                batch = batch.drop_columns(["leaks"])
            texts = as_bytes(batch["text"])
            words = Words([(t or b"").translate(LOWER) for t in texts], WORD_BYTES)
            items: dict[int, set[str]] = defaultdict(set)
            hit = np.zeros(len(words.starts) + 1, dtype=np.int32)
            for first, size, ids in grams.hits(words):
                hit[first] += 1
                hit[first + size] -= 1
                items[int(words.text_of(np.array([first]))[0])].update(ids)
            hit = np.cumsum(hit[:-1]) > 0
            rows, cleaned = [], []
            for t, text in enumerate(texts):
                lo, hi = int(words.bounds[t]), int(words.bounds[t + 1])
                own = hit[lo:hi]
                if earlier[t]:
                    items[t].update(earlier[t]["items"])
                    for first, after in earlier[t]["spans"]:
                        own[first:after] = True
                spans = _runs(own) if t in items else []
                rows.append({"n_words": hi - lo, "n_hit": int(own.sum()), "items": sorted(items.get(t, ())), "spans": spans})
                if clean:
                    cleaned.append(_cut(text, words, t, spans))
            columns = {"leaks": pa.array(rows, _LEAKS_ARROW)}
            if clean:
                columns[clean] = pa.array(cleaned, pa.binary()).cast(pa.string())
            yield append(batch, **columns)

    return step


_LEAKS_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))]
)


def _runs(flags: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def _cut(text: bytes | None, words: Words, t: int, spans: list[list[int]]) -> bytes | None:
    """The text without the bytes from the first to the last word of each run."""
    if not spans:
        return text
    base, lo, parts, at = int(words.text_starts[t]), int(words.bounds[t]), [], 0
    for first, after in spans:
        parts.append(text[at : int(words.starts[lo + first]) - base])
        at = int(words.ends[lo + after - 1]) - base
    return b"".join([*parts, text[at:]])
