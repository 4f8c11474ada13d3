"""Token ids of whole texts under a published byte-level vocabulary, in bulk.

The words of a block of text are cut out and made distinct by array operations; only
distinct words go through the vocabulary's merges, and their ids are copied to every place.
A text with characters for which the cutting rule is not plain (see `_PLAIN`) is encoded whole.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache
from itertools import chain

import numpy as np

from ledgerline.llm.common import MASKS, byte_class, span_hashes

VOCABULARY = "byte_bpe_50k"
BLOCK_BYTES = 2 << 20
CACHED_WORDS = 400_000  # about 30 MB

# White space other than these four, and letters and digits beyond the Latin ones, take the slow way.
_PLAIN = re.compile("[^\t\n\r -~À-ÖØ-öø-ɏ]")
_SPECIAL = "<|endoftext|>"
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, dtype=np.int8)
_CLASS[byte_class(0x20, 0x09, 0x0A, 0x0D)] = _SPACE
_CLASS[byte_class(*range(0x30, 0x3A))] = _DIGIT
_CLASS[byte_class(*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100))] = _LETTER


class Encoder:
    """Ids as the vocabulary's own tokenizer gives them without added special tokens."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        merges = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.merge = merges._core_bpe.encode_single_piece
        self.known = _Known()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """A uint32 array per text; null counts as empty."""
        out: list[np.ndarray | None] = [None] * len(texts)
        block, size = [], 0
        for k, text in enumerate(texts):
            if not text:
                out[k] = np.empty(0, dtype=np.uint32)
            elif _PLAIN.search(text) or _SPECIAL in text:
                out[k] = np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                block.append(k)
                size += len(text)
                if size >= BLOCK_BYTES:
                    self._block(texts, block, out)
                    block, size = [], 0
        if block:
            self._block(texts, block, out)
        return out

    def _block(self, texts, members, out) -> None:
        raw = [texts[k].encode() for k in members]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        buffer = b"".join(raw) + bytes(8)
        starts = _word_starts(np.frombuffer(buffer, dtype=np.uint8)[:-8], bounds)
        ends = np.append(starts[1:], bounds[-1])
        ids, counts = self._ids(buffer, starts, ends)
        after = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        for k, lo, hi in zip(members, after[:-1], after[1:]):
            out[k] = ids[lo:hi]

    def _ids(self, buffer, starts, ends):
        import pandas as pd

        code, distinct = pd.factorize(span_hashes(buffer, starts, ends))
        first = np.empty(len(distinct), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        places, sizes = self.known.ids_of(buffer, distinct, starts[first], ends[first], self.merge)
        counts = sizes[code]
        place = np.repeat(places[code] - (np.cumsum(counts) - counts), counts)
        return self.known.flat[place + np.arange(len(place))], counts


class _Known:
    """Ids of the words met so far, as arrays sorted by the hash of the word.

    A word counts as known only if hash, length and first 8 bytes agree. Beyond CACHED_WORDS
    no more words are kept, and the ids of a block's other words are made again.
    """

    def __init__(self):
        self.hashes, self.heads = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.lengths, self.places, self.sizes = (np.empty(0, np.int64) for _ in range(3))
        self.flat, self.kept = np.empty(0, np.uint32), 0

    def ids_of(self, buffer, hashes, starts, ends, merge):
        """Where each word's ids stand in `flat`, and how many they are."""
        self.flat = self.flat[: self.kept]
        loads = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
        lengths, heads = ends - starts, loads[starts] & MASKS[np.minimum(ends - starts, 8)]
        places, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        missing = np.arange(len(hashes))
        at = np.searchsorted(self.hashes, hashes)
        if len(self.hashes):
            near = np.minimum(at, len(self.hashes) - 1)
            same = (self.hashes[near] == hashes) & (self.heads[near] == heads) & (self.lengths[near] == lengths)
            places[same], sizes[same] = self.places[near[same]], self.sizes[near[same]]
            missing = missing[~same]
        made = [merge(buffer[s:e]) for s, e in zip(starts[missing].tolist(), ends[missing].tolist())]
        sizes[missing] = list(map(len, made))
        places[missing] = len(self.flat) + np.cumsum(sizes[missing]) - sizes[missing]
        self.flat = np.concatenate([self.flat, np.array(list(chain.from_iterable(made)), dtype=np.uint32)])
        if len(self.hashes) < CACHED_WORDS:
            order = missing[np.argsort(hashes[missing])]
            into = at[order]
            for name, new in (("hashes", hashes), ("heads", heads), ("lengths", lengths), ("places", places), ("sizes", sizes)):
                setattr(self, name, np.insert(getattr(self, name), into, new[order]))
            self.kept = len(self.flat)
        return places, sizes


@cache
def encoder(name: str = VOCABULARY) -> Encoder:
    return Encoder(name)


def _word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the words of the cutting rule begin.

    Runs of letters, digits, other signs, or white space; a blank before a run of another class
    belongs to that run, and so does not the rest of the white space before it; a contraction
    after an apostrophe that begins a run is a word of its own.
    """
    n = len(data)
    kind = _CLASS[data]
    new_text = np.zeros(n + 1, dtype=bool)
    new_text[bounds] = True
    start = np.empty(n + 1, dtype=bool)
    start[0] = start[n] = True
    start[1:n] = kind[1:] != kind[:-1]
    start |= new_text
    # the last white space before another run in the same text begins a word
    runs = np.flatnonzero(start[:n] & (kind != _SPACE) & ~new_text[:n])
    runs = runs[kind[runs - 1] == _SPACE]
    start[runs - 1] = True
    # and is the first letter of that word if it is a blank
    joined = runs[data[runs - 1] == 0x20]
    start[joined] = False
    quotes = np.flatnonzero((data == 0x27) & start[:n])
    for tail in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
        at = quotes[quotes + len(tail) < n]
        for k, byte in enumerate(tail, 1):
            at = at[(data[at + k] == byte) & ~new_text[at + k]]
        start[at + 1] = False
        start[at + 1 + len(tail)] = True
    return np.flatnonzero(start[:n])
