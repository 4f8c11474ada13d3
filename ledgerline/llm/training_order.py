"""Training-order materialisation: every sequence gets a slot by a keyed permutation and goes to a fixed-stride shard."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pass, checkpointed, open_folder, spread
from ledgerline.llm.tokens import VOCABULARY, encoder
from ledgerline.session import shared_dir

SIZE = 1024  # tokens of a sequence
END = 50256  # the vocabulary's end-of-text id, after each document
SHARD_SEQUENCES = 4096
ROUNDS = 4
# fixed layout of a record: slot, first document, that document's tokens before the sequence, tokens in it; then the ids
HEADER = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("doc_start", "<i8"), ("n_tokens", "<i4")])
NO_DOC = -(1 << 63)


def feistel(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. count - 1: a balanced Feistel network over the next power
    of four, walked again and again until the value is below `count`."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & low
        for turn in range(ROUNDS):
            mixed = (right + np.uint64((key * 2 + 1 + turn * 0x9E3779B97F4A7C15) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & low)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= count]
    return out.astype(np.int64)


class _Stream:
    """The texts of one partition as a stream of ids, each text followed by END, cut every `size` ids."""

    def __init__(self, batches, size: int, vocabulary: str):
        self.batches, self.size, self.vocabulary = batches, size, vocabulary
        self.count, self.crc = 0, 0

    def __iter__(self):
        """(ids, owners): whole sequences, the last one perhaps short; owners are (place, document, its ids before that place)."""
        rest, owners = np.empty(0, np.uint32), []
        for batch in self.batches:
            texts = encoder(self.vocabulary).encode(batch["text"].to_pylist())
            parts, at = [rest], len(rest)
            for doc, ids in zip(batch["doc_id"].to_pylist(), texts):
                owners.append((at, doc, 0))
                parts += [ids, np.array([END], np.uint32)]
                at += len(ids) + 1
            rest = np.concatenate(parts)
            cut = len(rest) // self.size * self.size
            yield self._counted(rest[:cut]), owners
            owners = _after(owners, cut)
            rest = rest[cut:]
        if len(rest):
            yield self._counted(rest), owners

    def _counted(self, ids: np.ndarray) -> np.ndarray:
        self.count, self.crc = self.count + -(-len(ids) // self.size), zlib.crc32(ids.tobytes(), self.crc)
        return ids


def _after(owners: list, cut: int) -> list:
    """The owners of what follows the first `cut` ids."""
    first = max(k for k, (place, _, _) in enumerate(owners) if place <= cut) if owners else 0
    return [(p - cut, doc, before) if p >= cut else (0, doc, before + cut - p) for p, doc, before in owners[first:]]


def part_counts(docs: DataFrame, size: int = SIZE, vocabulary: str = VOCABULARY) -> DataFrame:
    """(part, count, crc): the number of sequences in each partition of docs, and a checksum of its ids."""

    def step(batches):
        stream = _Stream(batches, size, vocabulary)
        for _ in stream:
            pass
        values = (TaskContext.get().partitionId(), stream.count, stream.crc)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["part", "count", "crc"])

    return arrow_pass(docs, step, "part long, count long, crc long")


def placed(docs: DataFrame, parts: dict[int, tuple[int, int, int]], total: int, key: int, size: int, shard_sequences: int, vocabulary: str) -> DataFrame:
    """(shard, slot, doc_id, doc_start, n_tokens, ids) of all sequences; parts: part -> (first number, count, crc)."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def step(batches):
        first, count, crc = shared.value[TaskContext.get().partitionId()]
        stream, done = _Stream(batches, size, vocabulary), 0
        for ids, owners in stream:
            slots = feistel(np.arange(first + done, first + stream.count), total, key)
            done = stream.count
            yield _cut(ids, size, owners, slots, shard_sequences)
        if (stream.count, stream.crc) != (count, crc):
            raise ValueError("the documents were dealt out differently when they were counted; store them as a table first")

    return arrow_pass(docs, step, "shard long, slot long, doc_id long, doc_start long, n_tokens int, ids binary")


def _cut(ids: np.ndarray, size: int, owners: list, slots: np.ndarray, shard_sequences: int) -> pa.RecordBatch:
    starts = np.arange(0, len(ids), size)
    places = np.array([o[0] for o in owners], dtype=np.int64)
    own = np.searchsorted(places, starts, side="right") - 1
    narrow = ids.astype("<u2")
    columns = [
        pa.array(slots // shard_sequences),
        pa.array(slots),
        pa.array([owners[k][1] for k in own], pa.int64()),
        pa.array([owners[k][2] + int(s) - owners[k][0] for k, s in zip(own, starts)], pa.int64()),
        pa.array(np.minimum(size, len(ids) - starts).astype(np.int32)),
        pa.array([narrow[s : s + size].tobytes() for s in starts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "doc_id", "doc_start", "n_tokens", "ids"])


def materialise(
    docs: DataFrame, key: int, size: int = SIZE, shard_sequences: int = SHARD_SEQUENCES, vocabulary: str = VOCABULARY, folder: str | None = None
) -> DataFrame:
    """Write all sequences of docs (doc_id, text, ...) in training order; returns the list of shards.

    Rows (shard, path, first_slot, n_sequences, bytes, crc32). Sequence number i of N, counted over the partitions
    in their order, goes to slot feistel(i); shard s holds slots s * shard_sequences onwards, record after record
    of one length, so slot k is found by arithmetic alone. Needs ids below 65536.

    The texts are made into ids twice, to count the sequences and to place them, which costs less than keeping the
    ids meanwhile. Both passes must see the same partitions in the same order, as a stored table gives them; each
    partition's count and checksum are compared, and the job stops if they differ.

    A null text is empty (END alone), a null doc_id is kept as such, repeated rows are written each,
    an empty table gives no shard; other columns are left out. A shard is written under another name
    and moved into place, so a repeated task changes nothing.
    """
    spark = docs.sparkSession
    docs = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    # three numbers for each task, whatever the size of the tables
    counted = sorted(part_counts(docs, size, vocabulary).collect())
    parts, total = {}, 0
    for part, count, crc in counted:
        parts[part] = total, count, crc
        total += count
    rows = placed(docs, parts, total, key, size, shard_sequences, vocabulary)
    # slots are dense, so ranges of equal width are of equal size and need no sampling
    shards = -(-total // shard_sequences)
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ordered = rows.repartitionById(tasks, F.expr(f"CAST(shard * {tasks} div {max(shards, 1)} AS INT)")).sortWithinPartitions("slot")
    folder = folder or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    return checkpointed(arrow_pass(ordered, _write(folder, size), "shard long, path string, first_slot long, n_sequences long, bytes long, crc32 long"))


def _write(folder: str, size: int):
    record = np.dtype([*HEADER.descr, ("ids", "<u2", (size,))])

    def step(batches):
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        sink = shard = None
        done = []

        def close():
            sink.close()
            files.move(f"{base}/{shard:08d}.{attempt}", f"{base}/{shard:08d}.bin")
            done.append((shard, f"{folder}/{shard:08d}.bin", first, count, count * record.itemsize, crc))

        for batch in batches:
            block = np.zeros(batch.num_rows, dtype=record)
            for name in ("slot", "n_tokens"):
                block[name] = batch[name].to_numpy()
            block["doc_id"] = batch["doc_id"].fill_null(NO_DOC).to_numpy()
            block["doc_start"] = batch["doc_start"].to_numpy()
            for k, ids in enumerate(batch["ids"].to_pylist()):
                block["ids"][k, : len(ids) // 2] = np.frombuffer(ids, "<u2")
            shards = batch["shard"].to_numpy()
            cuts = np.flatnonzero(np.diff(shards)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)]):
                if lo == hi:
                    continue
                if int(shards[lo]) != shard:
                    if sink:
                        close()
                    shard, first, count, crc = int(shards[lo]), int(block["slot"][lo]), 0, 0
                    sink = files.open_output_stream(f"{base}/{shard:08d}.{attempt}")
                raw = block[lo:hi].tobytes()
                sink.write(raw)
                count, crc = count + hi - lo, zlib.crc32(raw, crc)
        if sink:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], pa.string() if k == 1 else pa.int64()) for k in range(6)],
            names=["shard", "path", "first_slot", "n_sequences", "bytes", "crc32"],
        )

    return step


def read_shards(shards: DataFrame, size: int = SIZE, from_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, doc_start, n_tokens, ids) in order within each shard, from a slot onwards.

    A reader that stopped goes on with `from_slot`: earlier shards are not opened, the first one is
    entered in the middle. Header and length of each record are checked.
    """
    record = np.dtype([*HEADER.descr, ("ids", "<u2", (size,))])

    def step(batches):
        for batch in batches:
            for shard, path, first, count in zip(*(batch[c].to_pylist() for c in ("shard", "path", "first_slot", "n_sequences"))):
                files, at = open_folder(path)
                with files.open_input_file(at) as source:
                    skip = max(0, from_slot - first)
                    source.seek(skip * record.itemsize)
                    for lo in range(skip, count, 512):
                        raw = source.read(min(512, count - lo) * record.itemsize)
                        whole = len(raw) == min(512, count - lo) * record.itemsize
                        block = np.frombuffer(raw if whole else b"", dtype=record)
                        if not whole or not (block["slot"] == np.arange(first + lo, first + lo + len(block))).all():
                            raise ValueError(f"{path}: damaged at record {lo} or after")
                        docs = block["doc_id"]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(block["slot"]),
                                pa.array(np.full(len(block), shard)),
                                pa.array(np.arange(lo, lo + len(block)) * record.itemsize),
                                pa.array(docs, mask=docs == NO_DOC),
                                pa.array(block["doc_start"]),
                                pa.array(block["n_tokens"].astype(np.int64)),
                                pa.array([b[:n].astype("<u4").tobytes() for b, n in zip(block["ids"], block["n_tokens"])], pa.binary()),
                            ],
                            names=["slot", "shard", "byte_offset", "doc_id", "doc_start", "n_tokens", "ids"],
                        )

    wanted = shards.where(f"first_slot + n_sequences > {from_slot}L")
    schema = "slot long, shard long, byte_offset long, doc_id long, doc_start long, n_tokens long, ids binary"
    return arrow_pass(spread(wanted, "shard", "bytes"), step, schema)
