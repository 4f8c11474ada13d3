"""Substring operators against brute force over all windows."""

from __future__ import annotations

import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.substring import remove_later_copies
from ledgerline.llm.suffix import column_order, remove_repeats


def brute_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = defaultdict(int)
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] += 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out.append((len(t), sum(gone), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def brute_words(rows, length):
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, words):
        for k in range(len(w) - length + 1):
            if doc is not None:
                key = tuple(w[k : k + length])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if doc is not None and least[tuple(w[k : k + length])] < doc:
                gone[k : k + length] = [True] * length
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rnd.randint(10, 60)) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = [rnd.choice([text(rnd.randint(0, 30)), rnd.choice(passages), rnd.choice(passages)[rnd.randint(0, 30) :]]) for _ in range(rnd.randint(1, 5))]
        rows.append((k, rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (101, None), (102, ""), (None, rows[5][1]), (103, "ab " * 200), (104, " \t\n"), (105, rows[3][1])]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    data = [(d, t, "x", 1, 2) for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, kept string, k1 int, N_Removed int").repartition(4)


@pytest.mark.parametrize("seed,length,gram,hot", [(1, 40, 6, 10**6), (2, 40, 16, 1), (3, 25, 25, 0), (4, 33, 5, 3)])
def test_bytes_equal_brute_force(spark, seed, length, gram, hot):
    rows = corpus(seed)
    got = remove_repeats(frame(spark, rows), length, gram, hot).collect()
    want = sorted((str(r), *w) for r, w in zip(rows, brute_bytes(rows, length)))
    assert sorted((str((g["doc_id"], g["text"])), g["n_bytes"], g["n_removed"], bytes(g["kept"])) for g in got) == want
    for g in got:
        assert sum(b - a for a, b in g["spans"]) == g["n_removed"]
        assert all(b < c for (_, b), (c, _) in zip(g["spans"], g["spans"][1:]))


@pytest.mark.parametrize("seed,length,gram,hot", [(1, 8, 2, 10**6), (2, 11, 3, 1), (3, 5, 5, 0), (4, 13, 3, 10**6)])
def test_words_equal_brute_force(spark, seed, length, gram, hot):
    rows = corpus(seed)
    got = remove_later_copies(frame(spark, rows), length, gram, hot).collect()
    want = sorted((str(r), *w) for r, w in zip(rows, brute_words(rows, length)))
    assert sorted((str((g["doc_id"], g["text"])), g["n_words"], g["n_removed"], g["kept"]) for g in got) == want


def test_empty_tables(spark):
    empty = frame(spark, corpus(1)).limit(0)
    assert remove_repeats(empty, 40, 6).count() == 0
    assert remove_later_copies(empty, 8, 2).count() == 0


def test_chunks_of_long_texts(spark, monkeypatch):
    from ledgerline.llm import repeats

    rnd = random.Random(9)
    block = bytes(rnd.choice(b"abcdefgh") for _ in range(3000)).decode()
    units = repeats.ByteUnits([(block + block[:500]).encode(), block[200:900].encode()], 8)
    whole = [np.concatenate(x) for x in zip(*repeats.anchors(units, 50, 8))]
    monkeypatch.setattr(repeats, "CHUNK", 100)
    parts = [np.concatenate(x) for x in zip(*repeats.anchors(units, 50, 8))]
    spread = lambda a: sorted((int(f) + k, int(f + b)) for f, n, b in zip(*a[:3]) for k in range(n))
    assert spread(whole) == spread(parts)
    assert len(spread(whole)) == (3500 - 49) + (700 - 49)


def test_column_order_by_definition():
    rnd = np.random.default_rng(5)
    symbols = rnd.integers(97, 99, (30, 40)).astype(np.uint8)
    symbols[:, 7] = symbols[:, 3]
    symbols[rnd.random(symbols.shape) < 0.02] = 0xFF
    got = column_order(symbols, 6)
    for c in range(25):
        keys = [bytes(symbols[c : c + 6, s]) for s in range(40)]
        assert [got[c, s] for s in range(40)] == [b"\xff" not in k and keys.count(k) > 1 for k in keys]


@pytest.mark.parametrize("ids", [lambda k: None, lambda k: 7, lambda k: k])
def test_very_many_equal_rows_cost_no_more_than_their_number(spark, ids):
    rnd = random.Random(5)
    text = " ".join(str(rnd.randrange(10**5)) for _ in range(450))
    docs = spark.createDataFrame([(ids(k), text, "x", k) for k in range(1000)], "doc_id long, text string, runs string, _k1 int")
    begun = time.time()
    spread = remove_repeats(docs).select("runs", "_k1", "n_removed", "n_bytes").collect()
    assert {r["n_removed"] for r in spread} == {len(text)} and sorted(r["_k1"] for r in spread) == list(range(1000))
    kept = [r["n_removed"] for r in remove_later_copies(docs).collect()]
    assert sorted(kept) == ([0] + [450] * 999 if ids(0) == 0 else [0] * 1000)
    assert time.time() - begun < 60


def test_registered_sizes_against_brute_force(spark):
    rnd = random.Random(9)
    words = [f"w{k}" for k in range(40)]
    shared = [" ".join(rnd.choice(words) for _ in range(n)) for n in (49, 50, 51, 60, 130)]
    texts = [" ".join(rnd.choice(shared + [rnd.choice(words)] * 8) for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, places = {}, {}
    for doc, text in enumerate(texts):
        split = text.split()
        for k in range(len(split) - 49):
            seen.setdefault(tuple(split[k : k + 50]), doc)
        for k in range(len(text) - 199):
            places.setdefault(text[k : k + 200], []).append((doc, k))
    words_gone, bytes_gone = {}, {}
    for doc, text in enumerate(texts):
        split = text.split()
        for k in range(len(split) - 49):
            if seen[tuple(split[k : k + 50])] < doc:
                words_gone.setdefault(doc, set()).update(range(k, k + 50))
    for found in places.values():
        if len(found) > 1:
            for doc, k in found:
                bytes_gone.setdefault(doc, set()).update(range(k, k + 200))
    for r in remove_later_copies(docs).collect():
        gone = words_gone.get(r["doc_id"], ())
        assert r["kept"] == " ".join(w for k, w in enumerate(texts[r["doc_id"]].split()) if k not in gone)
    for r in remove_repeats(docs).collect():
        gone = bytes_gone.get(r["doc_id"], ())
        assert r["kept"].decode() == "".join(c for k, c in enumerate(texts[r["doc_id"]]) if k not in gone)
    assert words_gone and bytes_gone
