"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import shared_dir, ship_package

BATCH_BYTES = 2 << 20  # text handed to a Python worker at once; one longer text comes alone
TASK_BYTES = 64 << 20  # of written files that a task reads
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# fixed values: the white space that separates words
SPACE_BYTES = (0x20, *range(0x09, 0x0E))

U64 = np.uint64
_MIX1, _MIX2 = U64(0x9FB21C651E98DF25), U64(0xD6E8FEB86659FD93)
_ROLL = U64(0x9E3779B97F4A7C15)
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_LONG_WORD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def share(distinct: int, wanted: int) -> int:
    """Bound for a hash modulo 1,000,000,007 that lets about four times the wanted number of so many different values through."""
    return min(1_000_000_007, 4 * wanted * 1_000_000_007 // max(distinct, 1))


def spread(files: DataFrame, column: str, size: str) -> DataFrame:
    """A list of files dealt by ranges of a column over so many tasks that each reads about TASK_BYTES; adaptive execution keeps them apart."""
    found = files.agg(F.sum(size), F.count("*")).first()
    parallel = 2 * files.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil((found[0] or 0) / TASK_BYTES), min(found[1], parallel), 1)
    return files.repartitionByRange(tasks, column)


def arrow_pass(rows: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with batches bounded in bytes, for a step defined in this package."""
    spark = rows.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return rows.mapInArrow(step, schema)


def checkpointed(rows: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, which outlives any executor."""
    shared_dir(rows.sparkSession)
    return rows.checkpoint()


def without(rows: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names a result is about to use (names compare as Spark does)."""
    taken = {n.lower() for n in names}
    return rows.select(*[f"`{c}`" for c in rows.columns if c.lower() not in taken])


def unused(rows: DataFrame, name: str) -> str:
    """A name like this one that no column has, for a column to be dropped again."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extended(rows: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*rows.schema.fields, *fields])


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def byte_class(*inside: int) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(inside)] = True
    return out


NOT_SPACE = ~byte_class(*SPACE_BYTES)


class Words:
    """The words of several texts: their place in one buffer, a 64-bit hash each, and the words of each text.

    `is_word` says for each byte whether it belongs to a word; a line feed never does.
    Words of text t are those with numbers bounds[t] to bounds[t + 1].
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        self.buffer = b"\n" + b"\n".join(texts) + b"\n" + bytes(8)
        data = np.frombuffer(self.buffer, dtype=np.uint8)[:-8]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate([[1], 1 + np.cumsum(sizes)])
        inside = is_word[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.text_starts)

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, words, side="right") - 1

    def word(self, k: int) -> bytes:
        return self.buffer[self.starts[k] : self.ends[k]]

    def phrase(self, first: int, after: int) -> bytes:
        return b" ".join(self.buffer[s:e] for s, e in zip(self.starts[first:after], self.ends[first:after]))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buffer, self.starts, self.ends)


def span_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of a buffer that goes on for 8 bytes after the last one."""
    loads = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
    size = ends - starts
    out = size.astype(np.uint64) * _MIX2
    rest, at, left = None, starts, size
    while len(at):
        value = loads[at] & MASKS[np.minimum(left, 8)]
        mixed = ((out if rest is None else out[rest]) ^ value) * _MIX1
        mixed ^= mixed >> U64(29)
        if rest is None:
            out, more = mixed, np.flatnonzero((left > 8) & (size <= _LONG_WORD))
            rest = more
        else:
            out[rest] = mixed
            more = np.flatnonzero(left > 8)
            rest = rest[more]
        at, left = at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG_WORD):
        import xxhash

        out[k] = xxhash.xxh3_64_intdigest(buffer[starts[k] : ends[k]])
    out *= _MIX2
    return out ^ (out >> U64(32))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive values."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = words[:count].copy()
    for k in range(1, n):
        out *= _ROLL
        out += words[k : k + count]
    out ^= out >> U64(31)
    return out


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def open_folder(place: str):
    """A file system that every executor reaches, and the path of `place` in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(place)
