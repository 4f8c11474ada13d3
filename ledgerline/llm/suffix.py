"""Repeated byte strings, by building the sorted order of a collection of texts one column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import append, arrow_pass, as_bytes, extended, without
from ledgerline.llm.repeats import HOT, ByteUnits, Search, carried, covered, in_groups, ranges_of, repeated_windows, restored, with_runs

LENGTH = 200
GRAM = 16
TOGETHER = 40_000  # contexts whose columns are in memory at once
OUTSIDE = 0xFF  # never occurs in UTF-8


def column_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Which strings share `length` symbols from a column on with another string, for each column.

    `symbols` has a row for each column and an entry for each string; OUTSIDE matches nothing. Columns are inserted from the last to the first,
    one symbol for each string in a round. The rows of the collection's Burrows-Wheeler transform
    that belong to the current column are the symbols about to be inserted, in the order of the suffixes
    behind them; sorting them stably by symbol gives the order of the longer suffixes, and a common prefix grows
    by one, from the smallest prefix between the two places in the previous round.
    """
    columns, count = symbols.shape
    shared = np.zeros((columns - length + 1, count), dtype=bool)
    order = np.arange(count)
    common = np.zeros(count, dtype=np.uint8)  # with the string before, at most `length`
    levels = max(1, int(count).bit_length())
    table = np.zeros((levels, count), dtype=np.uint8)
    log = np.zeros(count + 1, dtype=np.int64)
    for k in range(1, levels):
        log[1 << k :] = k
    for column in range(columns - 1, -1, -1):
        transform = symbols[column][order]
        moved = np.argsort(transform, kind="stable")
        table[0] = common
        for k in range(1, levels):
            half = 1 << (k - 1)
            table[k] = table[k - 1]
            np.minimum(table[k - 1, : count - half], table[k - 1, half:], out=table[k, : count - half])
        order, transform = order[moved], transform[moved]
        before, here = moved[:-1], moved[1:]
        same = np.flatnonzero((transform[1:] == transform[:-1]) & (transform[1:] != OUTSIDE))
        before, here = before[same], here[same]
        level = log[here - before]
        least = np.minimum(table[level, before + 1], table[level, here - (1 << level) + 1])
        common = np.zeros(count, dtype=np.uint8)
        common[same + 1] = np.minimum(least, length - 1) + 1
        if column < len(shared):
            long = np.flatnonzero(common >= length)
            shared[column, order[long]] = True
            shared[column, order[long - 1]] = True
    return shared


def _compare(length: int, gram: int):
    before_most = length - gram

    def step(batches):
        for rows in in_groups(batches, TOGETHER):
            places, contexts = rows["place"].to_numpy(), as_bytes(rows["context"].combine_chunks())
            # all anchors stand in the same column, so equal windows begin in the same column
            first = before_most - (places & 255)
            symbols = np.full((len(contexts), before_most + length), OUTSIDE, dtype=np.uint8)
            for k, (at, context) in enumerate(zip(first.tolist(), contexts)):
                symbols[k, at : at + len(context)] = np.frombuffer(context, dtype=np.uint8)
            shared = column_order(np.ascontiguousarray(symbols.T), length)
            yield ranges_of(rows, shared.T, first)

    return step


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Add n_bytes, n_removed, spans (first and after of maximal removed runs, in bytes) and kept (binary) to docs (doc_id, text, ...).

    A byte goes if it lies in a string of `length` <= 255 bytes that also starts anywhere else, in the same
    document or another; overlaps count, and matches never cross documents. Strings are
    judged on the texts as given, and all of them are found. Surroundings that are equal as a whole are known by 128 bits
    of hashes, different ones are compared on bytes, and on 128-bit hashes for passages with more than `hot` of them.

    A null or empty text has no bytes; texts under `length` bytes stay whole; rows that repeat id and text are
    occurrences of each other; a null doc_id is as good as any; an empty table stays empty. Input columns
    with the names above are replaced, all others stay.
    """
    added = ("n_bytes", "n_removed", "spans", "kept")
    docs = without(docs, *added)
    rows = carried(docs)
    search = Search(ByteUnits, length, gram, "n > 1", "found > 1", _compare(length, gram), hot)
    found = repeated_windows(rows.select("doc_id", "text", "_k1", "_k2"), search)
    joined = with_runs(rows, found)

    def step(batches):
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, runs in zip(as_bytes(batch["text"]), batch["runs"].to_pylist()):
                data = np.frombuffer(text or b"", dtype=np.uint8)
                gone = covered(len(data), runs, length)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(edges.reshape(-1, 2).tolist())
                kept.append(data[~gone].tobytes())
            yield append(
                batch.drop_columns(["runs"]),
                n_bytes=pa.array(sizes, pa.int64()),
                n_removed=pa.array(removed, pa.int64()),
                spans=pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                kept=pa.array(kept, pa.binary()),
            )

    long, pairs = T.LongType(), T.ArrayType(T.ArrayType(T.LongType()))
    fields = [("n_bytes", long), ("n_removed", long), ("spans", pairs), ("kept", T.BinaryType())]
    found = arrow_pass(joined, step, extended(joined.drop("runs"), *[T.StructField(*f) for f in fields]))
    return restored(found, docs, *added)
