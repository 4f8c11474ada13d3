"""Packing and training order: exact round trips against the vocabulary's own tokenizer."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from ledgerline.llm.packing import pack  # noqa: E402
from ledgerline.llm.tokens import encoder  # noqa: E402
from ledgerline.llm.training_order import END, feistel, materialise, read_shards  # noqa: E402


def reference(texts):
    return [x.ids for x in encoder().whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def corpus(spark, n=300):
    rnd = random.Random(7)
    words = ["alpha", "Ströme", "it's", "we'll", "42", "--", "\n\n", "x" * 30, "été", "日本", "<|endoftext|>", "  ", "#!"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 60, 400, 3000])))) for k in range(n)]
    rows += [(n, None), (n, None), (None, "no id"), (n + 1, ""), (n + 2, "no id")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, ids string, offset int")
    return frame.repartition(5), rows


def test_tokens_equal_the_tokenizer():
    rnd = random.Random(3)
    signs = list("ab Z09  \n\t'sstmdrevell.,-é") + ["'s", "'re", "'ll ", " '", "\r\n", "ö", "<|endoftext|>", "日", "\x1c", "\xa0", "×"]
    texts = ["".join(rnd.choice(signs[: 26 if k % 3 else None]) for _ in range(rnd.randint(0, 40))) for k in range(4000)]
    assert [g.tolist() for g in encoder().encode(texts)] == reference(texts)


def test_packing_holds_every_id_once(spark):
    docs, rows = corpus(spark)
    pieces = pack(docs, derive=("ids", "crc32(ids) AS crc")).collect()
    want = sorted((repr(d), tuple(ids) + (0,)) for (d, _), ids in zip(rows, reference([t for _, t in rows])))
    docs_of, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert p["length"] == len(ids) > 0 and p["crc"] == zlib.crc32(p["ids"])
        docs_of.setdefault((repr(p["doc_id"]), p["doc_tokens"]), []).append((p["start"], tuple(ids)))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    got = []
    for (doc, total), parts in docs_of.items():
        parts.sort()
        ids = sum((ids for _, ids in parts), ())
        copies = len(ids) // total
        got += [(doc, ids[::copies] if total == 1 else ids)] * copies if copies > 1 else [(doc, ids)]
    assert sorted(got) == want
    padding = used = 0
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        length = sum(n for _, n in parts)
        assert length <= 1024
        used += length
        padding += 0 if length & (length - 1) == 0 else 1024 - length
    assert padding < 0.01 * used
    assert pack(docs.limit(0)).count() == 0


def test_feistel_is_a_permutation():
    for count in (1, 2, 5, 1000, 4097):
        out = feistel(np.arange(count), count, 99)
        assert sorted(out.tolist()) == list(range(count))
    assert feistel(np.arange(50), 50, 1).tolist() != feistel(np.arange(50), 50, 2).tolist()


def test_training_order_round_trip(spark):
    docs, rows = corpus(spark, 120)
    shards = materialise(docs, key=5, size=64, shard_sequences=37)
    got = sorted(read_shards(shards, size=64).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in got] == list(range(len(got)))
    assert all(r["shard"] == r["slot"] // 37 and r["byte_offset"] == (r["slot"] % 37) * (28 + 128) for r in got)
    # every document's ids stand in the sequences, from where the header says
    ids = sorted(i for r in got for i in np.frombuffer(r["ids"], "<u4").tolist())
    texts = reference([t for _, t in rows])
    assert ids == sorted([i for t in texts for i in t] + [END] * len(texts))
    by_doc = {d: t + [END] for (d, _), t in zip(rows, texts)}
    for r in got:
        part = np.frombuffer(r["ids"], "<u4").tolist()
        own = by_doc[r["doc_id"]][r["doc_start"] :][:64]
        assert part[: len(own)] == own
    later = read_shards(shards, size=64, from_slot=50).collect()
    assert sorted(r["slot"] for r in later) == list(range(50, len(got)))
    for shard in shards.collect():
        assert os.path.getsize(shard["path"].removeprefix("file:")) == shard["bytes"]
    assert materialise(docs.limit(0), key=5).count() == 0
