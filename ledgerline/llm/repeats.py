"""Windows of fixed length that occur more than once, found through anchors: what both substring operators share.

A window's anchor is the gram in it with the smallest hash, the leftmost of equals. It depends on
the window's content alone, so equal windows have equal anchors at the same place, and it is enough to compare
windows around equal anchors. An anchor and all windows it stands for form a context. The steps:

1. Count anchors by gram hash; a gram that occurs once has no repeated window.
2. Of the rest, collapse equal contexts. Copies of a text or passage shrink to one here, before any text moves.
3. Fetch the bytes of one context each, where a gram has different ones, and compare them within the gram.
4. A gram with more than HOT different contexts is not compared in one task: each of its windows
   becomes a row, and equal ones are counted with map-side combining.

What a step leaves is stored in the shared folder, and what it shuffled is let go, so a lost
executor costs one step and the disk holds about one copy of the texts at a time.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import NOT_SPACE, Words, arrow_pass, as_bytes, checkpointed, window_hashes

CHUNK = 1 << 19  # windows looked at together
HOT = 20_000  # different contexts of one gram that a task compares at most
_LOW = np.uint64((1 << 20) - 1)


class ByteUnits:
    """The bytes of several texts."""

    def __init__(self, texts: list[bytes], gram: int):
        self.buffer, self.gram = b"".join(texts) + bytes(8 + gram), gram
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.loads = np.ndarray((len(self.buffer) - 7,), dtype="<u8", buffer=self.buffer, strides=(1,))

    def grams(self, lo: int, hi: int) -> np.ndarray:
        out = np.zeros(hi - lo, dtype=np.uint64)
        for k in range(0, self.gram, 8):
            value = self.loads[lo + k : hi + k]
            if self.gram - k < 8:
                value = value & np.uint64((1 << 8 * (self.gram - k)) - 1)
            out = (out ^ value) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(32)
        return out * np.uint64(0xD6E8FEB86659FD93)

    def slices(self, firsts: np.ndarray, afters: np.ndarray) -> list[bytes]:
        buffer = self.buffer
        return [buffer[s:e] for s, e in zip(firsts.tolist(), afters.tolist())]


class WordUnits:
    """The words of several texts; a slice is words joined by one space."""

    def __init__(self, texts: list[bytes], gram: int):
        self.words = Words([b" ".join(t.split()) for t in texts], NOT_SPACE)
        self.bounds = self.words.bounds
        self.hashed = window_hashes(self.words.hashes(), gram)

    def grams(self, lo: int, hi: int) -> np.ndarray:
        return self.hashed[lo:hi]

    def slices(self, firsts: np.ndarray, afters: np.ndarray) -> list[bytes]:
        buffer = self.words.buffer
        return [buffer[s:e] for s, e in zip(self.words.starts[firsts].tolist(), self.words.ends[afters - 1].tolist())]


def anchors(units, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of (first window, number of windows, units before the anchor, gram hash) of all anchors."""
    span = length - gram + 1
    for lo in range(0, int(units.bounds[-1]) - length + 1, CHUNK):
        hi = min(lo + CHUNK, int(units.bounds[-1]) - length + 1)
        grams = units.grams(lo, hi + span - 1)
        least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        done = 1
        while done * 2 <= span:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < span:
            least = np.minimum(least[: done - span], least[span - done :])
        at = (least & _LOW).astype(np.int64)
        starts = np.arange(lo, hi)
        inside = starts + length <= units.bounds[np.searchsorted(units.bounds, starts, side="right")]
        cuts = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]) | (inside[1:] != inside[:-1])) + 1, [hi - lo]])
        first, count = cuts[:-1], np.diff(cuts)
        first, count = first[inside[first]], count[inside[first]]
        yield first + lo, count, at[first] - first, grams[at[first]]


@dataclass(frozen=True)
class Search:
    """What to look for. `units` cuts texts; windows have `length` units and anchors `gram` units.

    `whole` and `shared` are SQL conditions: that all windows of a member (doc) of a context (n members, smallest doc
    `least`) count as repeated; and that a window of a context (`least`) does, which is found in `found` contexts of
    smallest doc `least_found`. `compare` is the step that marks such windows among contexts of equal gram.
    """

    units: type
    length: int
    gram: int
    whole: str
    shared: str
    compare: Callable
    hot: int = HOT

    def __post_init__(self):
        if not 1 <= self.gram <= self.length or self.length - self.gram > 254:
            raise ValueError("a window must hold its gram, and at most 255 of them")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a 128-bit key of id and text; rows that agree in both share it, and their result."""
    return docs.withColumns({"_k1": F.expr("xxhash64(doc_id, text)"), "_k2": F.expr("xxhash64('k', text, doc_id)")})


def once(rows: DataFrame) -> DataFrame:
    """Keyed rows with `_times`: of rows that share a key one, with their number. Only texts that repeat so are moved for it."""
    counts = rows.groupBy("_k1", "_k2").agg(F.count("*").alias("_times")).where("_times > 1")
    counts = checkpointed(counts)
    if counts.isEmpty():
        return rows.withColumn("_times", F.lit(1).cast("long"))
    joined = rows.join(counts, ["_k1", "_k2"], "left")
    single = joined.where("_times IS NULL").withColumn("_times", F.lit(1).cast("long"))
    number = F.expr("row_number() OVER (PARTITION BY _k1, _k2 ORDER BY _times)")
    many = joined.where("_times IS NOT NULL").withColumn("_number", number).where("_number = 1").drop("_number")
    return single.unionAll(many)


def release(spark) -> None:
    """Let go of shuffle files that no live frame needs: Spark deletes them once the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _place(start, count, before):
    return start << 16 | count << 8 | before


def _members(rows: DataFrame, search: Search, kind: str) -> DataFrame:
    """(kh, c, k1, k2, doc, times, place): every anchor, with the hash of its context."""

    def step(batches):
        import xxhash

        for batch in batches:
            units = search.units([t or b"" for t in as_bytes(batch["text"])], search.gram)
            for first, count, before, grams in anchors(units, search.length, search.gram):
                owner = np.searchsorted(units.bounds, first, side="right") - 1
                contexts = [xxhash.xxh3_64_intdigest(s) for s in units.slices(first, first + count - 1 + search.length)]
                places = _place(first - units.bounds[owner], count, before)
                columns = [pa.array(grams.view(np.int64)), pa.array(np.array(contexts, dtype=np.uint64).view(np.int64))]
                columns += [batch[c].take(pa.array(owner)) for c in ("_k1", "_k2", "doc", "_times")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(places)], names=["kh", "c", "k1", "k2", "doc", "times", "place"])

    schema = f"kh long, c long, k1 long, k2 long, doc {kind}, times long, place long"
    return arrow_pass(rows.selectExpr("_k1", "_k2", "doc_id AS doc", "_times", "text"), step, schema)


def _fetched(rows: DataFrame, wanted: DataFrame, search: Search, kind: str) -> DataFrame:
    """The bytes of the wanted contexts."""
    lists = wanted.groupBy("k1", "k2").agg(F.expr("collect_list(struct(kh, c, least, place, hot)) AS wanted"))
    joined = rows.join(lists, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2"))).select("text", "wanted")
    names = ["kh", "c", "least", "place", "hot"]

    def step(batches):
        for batch in batches:
            units = search.units([t or b"" for t in as_bytes(batch["text"])], search.gram)
            lists = batch["wanted"]
            flat = lists.flatten()
            places = flat.field("place").to_numpy()
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            first, count = (places >> 16) + units.bounds[owner], places >> 8 & 255
            columns = [flat.field(c) for c in names]
            for lo in range(0, len(first), 4096):
                part = slice(lo, lo + 4096)
                contexts = units.slices(first[part], first[part] + count[part] - 1 + search.length)
                yield pa.RecordBatch.from_arrays([*(v[part] for v in columns), pa.array(contexts, pa.binary())], names=[*names, "context"])

    return arrow_pass(joined, step, f"kh long, c long, least {kind}, place long, hot boolean, context binary")


def _each_window(contexts: DataFrame, search: Search, kind: str) -> DataFrame:
    """A row for every window of the contexts, with its hash."""

    def step(batches):
        import xxhash

        for batch in batches:
            units = search.units(as_bytes(batch["context"]), search.gram)
            count = batch["place"].to_numpy() >> 8 & 255
            for lo in range(0, len(count), 512):
                row = np.repeat(np.arange(lo, lo + len(count[lo : lo + 512])), count[lo : lo + 512])
                at = np.arange(len(row)) - np.repeat(np.cumsum(count[lo : lo + 512]) - count[lo : lo + 512], count[lo : lo + 512])
                windows = units.slices(units.bounds[row] + at, units.bounds[row] + at + search.length)
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in windows), dtype="<i8").reshape(-1, 2)
                out = [batch[c].take(pa.array(row)) for c in ("kh", "c", "least")]
                out += [pa.array(at), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(out, names=["kh", "c", "least", "at", "w1", "w2"])

    return arrow_pass(contexts.select("kh", "c", "least", "place", "context"), step, f"kh long, c long, least {kind}, at long, w1 long, w2 long")


def repeated_windows(rows: DataFrame, search: Search) -> DataFrame:
    """(k1, k2, runs) of keyed rows that have repeated windows; runs are (start, n): n windows from one on.

    The smaller side of each join is stored first, so that both sides come straight from an
    exchange and adaptive execution can split a gram or context with very many rows.
    """
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = once(rows)
    every = _members(rows, search, kind)
    often = checkpointed(every.groupBy("kh").agg(F.sum("times").alias("times")).where("times > 1").select("kh"))
    members = checkpointed(every.join(often, "kh"))
    del every, often
    release(spark)
    contexts = members.groupBy("kh", "c").agg(
        F.expr("sum(times) AS n"), F.expr("min(doc) AS least"), F.expr("min(struct(k1, k2, place)) AS one")
    )
    contexts = checkpointed(contexts)
    variants = checkpointed(contexts.groupBy("kh").agg(F.expr(f"count(*) > {search.hot} AS hot"), F.expr("count(*) AS v")).where("v > 1").drop("v"))
    wanted = contexts.join(variants, "kh").select("kh", "c", "least", "one.*", "hot")
    fetched = checkpointed(_fetched(rows, wanted, search, kind))
    del wanted, variants
    release(spark)
    dealt = fetched.where("NOT hot").repartition("kh").sortWithinPartitions("kh")
    marked = arrow_pass(dealt, search.compare, "kh long, c long, ranges array<long>")
    hot = fetched.where("hot")
    if not hot.isEmpty():
        windows = _each_window(hot, search, kind)
        found = checkpointed(windows.groupBy("w1", "w2").agg(F.expr("count(*) AS found"), F.expr("min(least) AS least_found")).where("found > 1"))
        again = windows.join(found, ["w1", "w2"]).where(search.shared)
        marked = marked.unionAll(again.groupBy("kh", "c").agg(F.expr("collect_list(shiftleft(at, 16) + 1) AS ranges")))
        del windows, found, again
    marked = checkpointed(marked)
    del fetched, dealt, hot
    release(spark)
    verdicts = checkpointed(contexts.join(marked, ["kh", "c"], "left").select("kh", "c", "n", "least", "ranges"))
    del contexts, marked
    start, count = "shiftright(place, 16)", "(shiftright(place, 8) & 255)"
    all_of_them = f"array(named_struct('start', {start}, 'n', {count}))"
    some = f"transform(ranges, r -> named_struct('start', {start} + shiftright(r, 16), 'n', r & 65535))"
    parts = members.join(verdicts, ["kh", "c"]).selectExpr("k1", "k2", f"inline(CASE WHEN {search.whole} THEN {all_of_them} ELSE {some} END)")
    runs = checkpointed(parts.groupBy("k1", "k2").agg(F.expr("collect_list(struct(start, n)) AS runs")))
    del members, verdicts, parts
    release(spark)
    return runs


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, `_row`, so that none clashes with those of the search."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return keyed(docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("_")).alias("_row")))


def with_runs(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text, _row, runs) of carried rows."""
    same = (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2"))
    return rows.join(found, same, "left").select("doc_id", "text", "_row", "runs")


def restored(found: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    """The columns of docs in their order, and the added ones."""
    columns = [F.col(c if c in ("doc_id", "text") else f"_row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*columns, *added)


def covered(size: int, runs: list[dict] | None, length: int) -> np.ndarray:
    """Which of a text's units lie in one of the windows."""
    change = np.zeros(size + 1, dtype=np.int32)
    for run in runs or ():
        change[run["start"]] += 1
        change[run["start"] + run["n"] - 1 + length] -= 1
    return np.cumsum(change[:-1]) > 0


def in_groups(batches, most: int) -> Iterator[pa.Table]:
    """Tables of rows that come sorted by kh, cut only between different kh, of about `most` rows."""
    waiting, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.num_rows
        if size >= most:
            rows = pa.Table.from_batches(waiting)
            kh = rows["kh"].to_numpy()
            cut = int(np.argmax(kh == kh[-1]))
            if cut:
                yield rows.slice(0, cut)
                waiting = rows.slice(cut).to_batches()
                size = len(kh) - cut
    if waiting:
        yield pa.Table.from_batches(waiting)


def ranges_of(rows: pa.Table, marks: np.ndarray, shift: np.ndarray) -> pa.RecordBatch:
    """Marked windows of each row as ranges (from << 16 | n), counted from the row's first window."""
    edges = np.diff(np.pad(marks.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    values = (begin - shift[row]) << 16 | (end - begin)
    sizes = np.bincount(row, minlength=len(marks))
    kept = np.flatnonzero(sizes)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[kept])]), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int64)))
    columns = [pa.array(rows[c].to_numpy()[kept]) for c in ("kh", "c")]
    return pa.RecordBatch.from_arrays([*columns, lists], names=["kh", "c", "ranges"])
