"""Near vectors, hard negatives and the manifest against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from ledgerline.llm import caps  # noqa: E402
from ledgerline.llm.manifest import COLUMNS, folded, manifest, proof, tampered_leaf  # noqa: E402
from ledgerline.llm.negatives import enough_primes, exact_products, hard_negatives  # noqa: E402
from ledgerline.llm.queries import QUERIES  # noqa: E402

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, [], [None, 1.0], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0], [1e30] * 24, [1e-30] * 24]


def vectors(seed, n, dim, groups, copies):
    """(id, embedding, label) rows with chains of near vectors, equal rows and odd ones."""
    rnd = np.random.default_rng(seed)
    x = [rnd.standard_normal(dim) for _ in range(n)]
    for _ in range(groups):
        centre = rnd.standard_normal(dim)
        for _ in range(copies):
            centre = centre / np.linalg.norm(centre) + rnd.standard_normal(dim) * rnd.choice([0.005, 0.02, 0.03])
            x.append(centre * rnd.choice([1.0, 3.0]))
    rows = [(k, v.astype(np.float32).tolist(), k % 3) for k, v in enumerate(x)]
    rows += [(k + len(x), v, label) for k, (v, label) in enumerate([(v, label) for v in ODD for label in (0, None)])]
    rows += [rows[5], rows[5], (None, rows[6][1], rows[6][2]), (9000, rows[n][1], 0), (9001, rows[n][1], 0), (9002, rows[n][1], None)]
    random.Random(seed).shuffle(rows)
    return rows


def frame(spark, rows):
    made = spark.createDataFrame(rows, "id long, embedding array<float>, label int")
    return made.withColumns({"class": F.lit(1), "V": F.lit(2), "n": F.lit("x"), "caps": F.lit(None).cast("int"), "Cap": F.lit(0)})


def sound(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def links_of(rows, threshold=0.98):
    """Sorted (id, n_links, component_id), by comparing all pairs."""
    unit = []
    for _, v, label in rows:
        v = np.array(v, dtype=float) if sound(v) and label is not None and any(v) else None
        unit.append(None if v is None else v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()))
    near = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                near[a].append(b)
                near[b].append(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            todo += [b for b in near[todo.pop()] if b not in seen and not seen.add(b)]
        out.append((i, len(near[k]), min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("dim", [24, 3, 64])
def test_near_vectors_equal_all_pairs(spark, dim):
    rows = vectors(dim, 150, dim, 12, 15)
    assert sorted(map(tuple, caps.near_vectors(frame(spark, rows)).collect()), key=str) == links_of(rows)


def test_near_vectors_in_a_group_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(caps, "GROUP", 16)
    rows = vectors(3, 20, 32, 2, 60)
    assert sorted(map(tuple, caps.near_vectors(frame(spark, rows)).collect()), key=str) == links_of(rows)
    assert caps.near_vectors(frame(spark, [])).collect() == []


def test_list_decoding_spells_out_all_directions_over_the_cap():
    x = np.random.default_rng(1).standard_normal((50, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    words = 9
    turn, books = caps._code(20, words)
    parts = [p @ b.T for p, b in zip(np.split(x @ turn, caps.PARTS, axis=1), books)]
    every = parts[0]
    for p in parts[1:]:
        every = (every[:, :, None] + p[:, None, :]).reshape(len(x), -1)
    for cap in (0.3, 0.5, 2.0):
        row, direction = caps.list_decode(x, words, cap)
        for k in range(len(x)):
            bound = min(cap, np.sort(every[k])[-caps.LEAST])
            assert sorted(direction[row == k]) == np.flatnonzero(every[k] >= bound - 1e-12).tolist()


def test_products_from_residues_are_exact():
    rnd = random.Random(2)
    for size in (3, 2000, 2**20, 2**27):
        a, b = ([[rnd.randint(-size, size) for _ in range(70)] for _ in range(n)] for n in (4, 9))
        most = max(sum(x * x for x in row) for row in a + b)
        assert most < 2**62
        want = [[sum(p * q for p, q in zip(r, s)) for s in b] for r in a]
        assert exact_products(np.array(a), np.array(b), enough_primes(most)).tolist() == want


def negatives_of(rows, positives=5, negatives=10):
    """Sorted result rows, by scoring every anchor with all rows."""
    floors = [(k, i, [int(np.floor(256 * x)) for x in map(float, v)], label) for k, (i, v, label, _) in enumerate(rows) if sound(v) and label is not None]
    floors = [x for x in floors if sum(y * y for y in x[2]) < 2**62]
    out = []
    order = lambda x: (-x[0], x[1] is not None, x[1] or 0)
    for k, i, v, label in floors:
        if rows[k][3]:
            scored = [(sum(a * b for a, b in zip(v, w)), j, other) for m, j, w, other in floors if m != k]
            for score, j, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
                reach = [s for s in scored if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score]
                out += [(i, j, rank + 1, s[1], score, s[0]) for rank, s in enumerate(sorted(reach, key=order)[:negatives])]
    return sorted(out, key=str)


def test_hard_negatives_equal_a_full_search(spark, monkeypatch):
    from ledgerline.llm import negatives

    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 8)
    monkeypatch.setattr(negatives, "TASK_SCORES", 256)
    for seed, dim, scale in ((1, 24, 1), (2, 64, 1), (3, 80, 3000)):
        rows = [(i, None if v is None else [None if x is None else x * scale for x in v], label) for i, v, label in vectors(seed, 150, dim, 4, 30)]
        rows = [(*row, row[0] is None or row[0] % 10 == 0) for row in rows]
        made = spark.createDataFrame(rows, "id long, embedding array<float>, label int, anchor boolean")
        made = made.withColumns({"key": F.lit(1), "block": F.lit(2), "V": F.lit("x"), "cell": F.lit(None).cast("int")})
        rows = [tuple(r) for r in made.select("id", "embedding", "label", "anchor").collect()]
        assert sorted(map(tuple, hard_negatives(made).collect()), key=str) == negatives_of(rows)
    assert hard_negatives(made.limit(0)).collect() == []
    assert hard_negatives(made.withColumn("anchor", F.lit(False))).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(hashes):
    """The root of some hashes, and for each the (left, right) siblings of every level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for path, i in zip(paths, at):
            low = i // 8 * 8
            path.append(("".join(hashes[low:i]), "".join(hashes[i + 1 : low + 8])))
        at = [i // 8 for i in at]
        hashes = [sha("".join(hashes[k : k + 8])) for k in range(0, len(hashes), 8)]
    return hashes[0], paths


def manifest_of(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    inner = {}
    for k in keys:
        own = sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner[k] = (own, *plain_tree([leaf(r) for r in own]))
    root, tops = plain_tree([inner[k][1] for k in keys]) if keys else (None, [])
    out = []
    for k, top in zip(keys, tops):
        own, subroot, paths = inner[k]
        for row, path in zip(own, paths):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].translate(UPPER))
            fold = leaf(changed)
            for before, after in path + top:
                fold = sha(before + fold + after)
            digest = sha("".join(b + a for b, a in path + top))
            out.append((row[0], leaf(row), subroot, root, digest, fold, fold == root))
    return sorted(out, key=str)


def manifest_rows(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = made.withColumns({"tree": F.lit(1), "leaf": F.lit("a"), "Rank": F.lit(2), "node": F.lit(3), "id": F.lit(0), "path": F.lit(None).cast("int")})
    return manifest(made.repartition(5), other=tampered_leaf())


@pytest.mark.parametrize("n, langs", [(0, 1), (1, 1), (2, 1), (9, 2), (700, 3), (90, 70)])
def test_manifest_equals_plain_python(spark, n, langs):
    rnd = random.Random(n)
    names = [None, "", *(f"é{k}" if k % 2 else f"Z{k}" for k in range(langs))][:langs] if langs > 1 else ["en"]
    texts = [None, "", "Some Text", "no capitals", "ÄÖ É " * 40, "A" * 50_000]
    rows = [(rnd.choice([None, k, k, k, k, 10**15 + k]), rnd.choice([None, "web"]), rnd.choice(names), rnd.choice([None, k]), rnd.choice(texts)) for k in range(n)]
    rows += rows[:3] * 2 if n > 5 else []
    found = manifest_rows(spark, rows).selectExpr("doc_id", "leaf", "subroot", "root", f"{proof('path')} AS p", f"{folded('path', 'coalesce(other, leaf)')} AS f")
    got = [(*r, r["f"] == r["root"]) for r in found.collect()]
    assert sorted(got, key=str) == manifest_of(rows)


def test_manifest_over_several_rounds_of_blocks(spark):
    rows = [(k, "s", "en" if k % 400 else "de", k, f"Text {k}") for k in range(9000)]
    found = manifest_rows(spark, rows).selectExpr("doc_id", "leaf", "subroot", "root", f"{proof('path')} AS p", f"{folded('path', 'coalesce(other, leaf)')} AS f")
    got = [(*r, r["f"] == r["root"]) for r in found.collect()]
    assert sorted(got, key=str) == manifest_of(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_queries_of_vectors_and_manifest_match_brute_force(spark, tmp_path):
    rows = [(i, v, label) for i, v, label in vectors(8, 400, 24, 6, 20) if i is not None]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    docs = [(k, "web", ["en", None, "de"][k % 3], k, f"Text {k}") for k in range(100)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {n: sorted((tuple(r) for r in QUERIES[n][0](spark, str(tmp_path)).collect()), key=str) for n in ("op11_caps", "op12_negatives", "op13_manifest")}
    assert got["op11_caps"] == sorted([(i, n, c, i == c) for i, n, c in links_of(rows)], key=str)
    relabelled = [(i, v, (label + 1) % 10 if i % 7 == 0 and label is not None else label, i % 100 == 0) for i, v, label in rows]
    assert got["op12_negatives"] == negatives_of(relabelled)
    assert got["op13_manifest"] == manifest_of(docs)
    assert COLUMNS == ("doc_id", "source", "lang", "n_chars", "text")
