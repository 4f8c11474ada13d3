"""Repeated word windows, by level-wise doubling: only what repeats at one length is tried at twice that length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import NOT_SPACE, Words, append, arrow_pass, as_bytes, extended, without
from ledgerline.llm.repeats import HOT, Search, WordUnits, carried, covered, in_groups, ranges_of, repeated_windows, restored, with_runs

LENGTH = 50
GRAM = 7  # first level
TOGETHER = 4_000  # contexts of about 90 words in memory at once: some 40 MB
_MIX = np.uint64(0x9FB21C651E98DF25)


def _doubled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left * _MIX) ^ (right + np.uint64(0xD6E8FEB86659FD93))
    out ^= out >> np.uint64(31)
    return out * _MIX


def _repeated(group: np.ndarray, values: np.ndarray, alive: np.ndarray):
    """Class numbers of the living cells: cells of one group and column with equal values share one. Classes of one are dropped."""
    row, column = np.nonzero(alive)
    keys = _doubled(group[row] + column.astype(np.uint64), values[row, column])
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    kept = times[number] > 1
    return row[kept], column[kept], number[kept]


def smaller_elsewhere(group: np.ndarray, words: np.ndarray, inside: np.ndarray, owner: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which windows of `length` words also begin in a string of the same group with a smaller owner, for each string and column.

    `words` holds word hashes, a row for each string; equal windows stand in the same column. Length doubles from
    `gram` up to `length`; a window is a candidate if both its halves repeated.
    """
    size = gram
    width = words.shape[1]
    values, alive = words, inside
    for k in range(1, gram):
        values = _doubled(values[:, :-1], words[:, k:])
        alive = alive[:, :-1] & inside[:, k:]
    first_values = values
    while True:
        row, column, number = _repeated(group, values, alive)
        alive = np.zeros(alive.shape, dtype=bool)
        alive[row, column] = True
        if size == length or not len(row):
            break
        step = min(size, length - size)
        values = _doubled(values[:, : values.shape[1] - step], values[:, step:])
        alive = alive[:, : alive.shape[1] - step] & alive[:, step:]
        size += step
    out = np.zeros((len(words), width - length + 1), dtype=bool)
    if len(row):
        # the class's first by owner; a class is taken apart if the hashes of its grams disagree
        order = np.lexsort((owner[row], number))
        row, column, number = row[order], column[order], number[order]
        heads = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1])
        head = np.repeat(row[heads], np.diff(np.append(heads, len(row))))
        same = np.ones(len(row), dtype=bool)
        for at in [*range(0, length - gram, gram), length - gram]:
            same &= first_values[row, column + at] == first_values[head, column + at]
        if not same.all():
            raise ValueError("two different windows have the same hash")
        smaller = owner[head] < owner[row]
        out[row[smaller], column[smaller]] = True
    return out


def _compare(length: int, gram: int):
    before_most = length - gram

    def step(batches):
        for rows in in_groups(batches, TOGETHER):
            found = Words(as_bytes(rows["context"].combine_chunks()), NOT_SPACE)
            sizes, first = np.diff(found.bounds), before_most - (rows["place"].to_numpy() & 255)
            shape = (len(sizes), 2 * before_most + gram)
            row = np.repeat(np.arange(len(sizes)), sizes)
            column = np.arange(len(row)) - np.repeat(found.bounds[:-1] - first, sizes)
            words, inside = np.zeros(shape, dtype=np.uint64), np.zeros(shape, dtype=bool)
            words[row, column], inside[row, column] = found.hashes(), True
            owner = np.unique(rows["least"].to_numpy(), return_inverse=True)[1]
            marks = smaller_elsewhere(rows["kh"].to_numpy().view(np.uint64), words, inside, owner, length, gram)
            yield ranges_of(rows, marks, first)

    return step


def remove_later_copies(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Add n_words, n_removed, spans (word numbers of maximal removed runs) and kept (text) to docs (doc_id, text, ...).

    A word goes if a window of `length` consecutive words covers it that also begins in a document with a smaller
    doc_id. Words are taken unchanged between white space; windows are judged on the texts as given; kept words are
    joined by one space. All windows count; they are compared by their words' 64-bit hashes.

    A null or empty text has no words and keeps an empty text; rows with one doc_id are one document, which removes nothing
    from itself; a null doc_id neither loses words nor takes any; an empty table stays empty.
    Input columns with the names above are replaced, all others stay.
    """
    added = ("n_words", "n_removed", "spans", "kept")
    docs = without(docs, *added)
    rows = carried(docs)
    search = Search(WordUnits, length, gram, "doc > least", "least_found < least", _compare(length, gram), hot)
    found = repeated_windows(rows.where("doc_id IS NOT NULL").select("doc_id", "text", "_k1", "_k2"), search)
    joined = with_runs(rows, found)

    def step(batches):
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, runs in zip(as_bytes(batch["text"]), batch["runs"].to_pylist()):
                words = (text or b"").split()
                gone = covered(len(words), runs, length)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2).tolist()
                for lo, hi in reversed(edges):
                    del words[lo:hi]
                sizes.append(len(gone))
                removed.append(int(gone.sum()))
                spans.append(edges)
                kept.append(b" ".join(words))
            yield append(
                batch.drop_columns(["runs"]),
                n_words=pa.array(sizes, pa.int64()),
                n_removed=pa.array(removed, pa.int64()),
                spans=pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                kept=pa.array(kept, pa.binary()).cast(pa.string()),
            )

    long, pairs = T.LongType(), T.ArrayType(T.ArrayType(T.LongType()))
    fields = [("n_words", long), ("n_removed", long), ("spans", pairs), ("kept", T.StringType())]
    found = arrow_pass(joined, step, extended(joined.drop("runs"), *[T.StructField(*f) for f in fields]))
    return restored(found, docs, *added)
