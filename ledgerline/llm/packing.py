"""Bounded-space online packing of documents into token sequences."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pass, checkpointed
from ledgerline.llm.tokens import VOCABULARY, encoder

SIZE = 1024  # tokens of a sequence
WINDOWS = 64  # open at once in a partition
LEAST_CUT = 16  # a gap of fewer tokens is padded rather than filled with a cut-off piece
END = 0  # the token after each document
FAN_IN = 1024  # leftovers that meet in one task: at most this many times SIZE tokens
_PART, _OPEN = 1 << 32, (1 << 32) - 1


def pack(docs: DataFrame, size: int = SIZE, windows: int = WINDOWS, vocabulary: str = VOCABULARY, derive: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset) of all documents of docs (doc_id, text, ...).

    A document is its token ids and one END. Whole sequences are cut off it first; what is left goes into
    the fullest of `windows` open windows that still has room. If none has, the fullest is emitted: filled
    with the head of the document, or padded if fewer than LEAST_CUT tokens are missing. What is open at the end
    of a partition is joined, and the remainders (under one sequence a partition) are merged over all
    partitions, FAN_IN at a time. The very last one is cut into powers of two, which need no padding.

    `derive` lists SQL expressions over the piece and its `ids` (binary, little-endian 32-bit) to return
    besides the columns above. A null text counts as empty, hence as END alone. Repeated rows are documents of
    their own; a null doc_id is kept; an empty table has no pieces. Other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    out = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    left = f"sequence_id % {_PART}L = {_OPEN}L"

    def derived(pieces: DataFrame) -> DataFrame:
        return pieces.selectExpr(*out, f"IF({left}, ids, NULL) AS _ids", *derive)

    pieces = checkpointed(derived(arrow_pass(docs.select("doc_id", "text"), _place(size, windows, vocabulary), schema)))
    done, level, number = [pieces.where(f"NOT ({left})")], 1, f"shiftright(sequence_id, 32) & {(1 << 24) - 1}L"
    while True:
        open_ends = pieces.where(left).selectExpr(*out, "_ids AS ids")
        most = open_ends.selectExpr(f"max({number}) AS n").first()["n"]
        if most is None:
            break
        groups = most // FAN_IN + 1
        dealt = open_ends.withColumn("_group", F.expr(f"({number}) div {FAN_IN}")).repartition(int(min(groups, 4096)), "_group")
        pieces = checkpointed(derived(arrow_pass(dealt, _merge(size, level, groups == 1), schema)))
        done.append(pieces.where(f"NOT ({left})"))
        level += 1
    result = done[0]
    for more in done[1:]:
        result = result.unionAll(more)
    return result.drop("_ids")


class _Rows:
    """Pieces on their way out, as columns."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.columns = kind, [[] for _ in range(7)]

    def add(self, piece, sequence: int, offset: int) -> None:
        doc, start, total, ids = piece
        for column, value in zip(self.columns, (doc, start, len(ids), total, sequence, offset, ids.tobytes())):
            column.append(value)

    def sequence(self, pieces, sequence: int) -> None:
        offset = 0
        for piece in pieces:
            self.add(piece, sequence, offset)
            offset += len(piece[3])

    def flush(self) -> pa.RecordBatch:
        kinds = [self.kind, *[pa.int64()] * 5, pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds)], names=names)
        self.columns = [[] for _ in range(7)]
        return batch


def _split(piece, at: int):
    doc, start, total, ids = piece
    return (doc, start, total, ids[:at]), (doc, start + at, total, ids[at:])


def _joined(pieces, size: int):
    """Pieces one after another, cut into full sequences; and what remains."""
    full, current, used = [], [], 0
    for piece in pieces:
        while used + len(piece[3]) >= size:
            head, piece = _split(piece, size - used)
            full.append([*current, head])
            current, used = [], 0
        if len(piece[3]):
            current.append(piece)
            used += len(piece[3])
    return full, current


def _place(size: int, windows: int, vocabulary: str):
    def step(batches):
        first, count, rows = TaskContext.get().partitionId() * _PART, 0, None
        contents: dict[int, list] = {}  # of the open windows, by slot
        by_room: list[tuple[int, int]] = []  # (tokens that still fit, slot), ascending
        free = list(range(windows))
        for batch in batches:
            rows = rows or _Rows(batch["doc_id"].type)
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoder(vocabulary).encode(batch["text"].to_pylist())):
                ids = np.append(ids, END).astype("<u4")
                piece = (doc, 0, len(ids), ids)
                while len(piece[3]):
                    if len(piece[3]) >= size:
                        head, piece = _split(piece, size)
                        rows.sequence([head], first + count)
                        count += 1
                        continue
                    at = bisect_left(by_room, (len(piece[3]), -1))
                    if at == len(by_room) and not free:
                        room, slot = by_room.pop(0)
                        if room >= LEAST_CUT:
                            head, piece = _split(piece, room)
                            contents[slot].append(head)
                        rows.sequence(contents.pop(slot), first + count)
                        count += 1
                        free.append(slot)
                        continue
                    room, slot = by_room.pop(at) if at < len(by_room) else (size, free.pop())
                    contents.setdefault(slot, []).append(piece)
                    room -= len(piece[3])
                    if room:
                        insort(by_room, (room, slot))
                    else:
                        rows.sequence(contents.pop(slot), first + count)
                        count += 1
                        free.append(slot)
                    break
            yield rows.flush()
        if contents:
            full, rest = _joined([p for _, slot in by_room for p in contents[slot]], size)
            for pieces in full:
                rows.sequence(pieces, first + count)
                count += 1
            rows.sequence(rest, first + _OPEN)
            yield rows.flush()

    return step


def _merge(size: int, level: int, last: bool):
    def step(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).sort_by([("_group", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        rows, groups = _Rows(table["doc_id"].type), table["_group"].to_pylist()
        columns = [table[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
        pieces = [(doc, start, total, np.frombuffer(ids, "<u4")) for doc, start, total, ids in zip(*columns)]
        for group in sorted(set(groups)):
            full, rest = _joined([p for p, g in zip(pieces, groups) if g == group], size)
            first = (level << 56) + group * _PART
            if last:
                full, rest = full + _powers(rest), []
            for n, sequence in enumerate(full):
                rows.sequence(sequence, first + n)
            rows.sequence(rest, first + _OPEN)
        yield rows.flush()

    return step


def _powers(pieces):
    """Sequences whose lengths are the powers of two in the number of tokens."""
    total, out = sum(len(p[3]) for p in pieces), []
    for power in reversed(range(total.bit_length())):
        if total >> power & 1:
            part, room = [], 1 << power
            while room:
                piece = pieces.pop(0)
                if len(piece[3]) > room:
                    piece, rest = _split(piece, room)
                    pieces.insert(0, rest)
                part.append(piece)
                room -= len(piece[3])
            out.append(part)
    return out
