"""Queries without SQL, and the whole pipeline, on small tables against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import xxhash

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from ledgerline.llm.language import fit_languages  # noqa: E402
from ledgerline.llm.queries import QUERIES  # noqa: E402
from ledgerline.llm.secrets import SIGNS, fit_ratios, labelled_samples  # noqa: E402
from ledgerline.llm.tokens import encoder  # noqa: E402

WORDS = {
    "en": "the house and water of this good day with people who would often speak about their garden under morning light while children were playing",
    "de": "das haus und wasser dieser gute tag mit leuten die oft über ihren garten sprechen während kinder draußen unter bäumen spielten und lachten",
    "fr": "la maison et cette eau du bon jour avec des gens qui parlent souvent de leur jardin sous une lumière pendant que les enfants jouaient",
    "es": "la casa y el agua de este buen día con gente que habla siempre de su jardín bajo aquella luz mientras los niños jugaban fuera",
}
WORDS = {lang: words.split() for lang, words in WORDS.items()}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, Leaks int, _masked string, hit boolean"


def prose(rnd, lang, n):
    words = [rnd.choice(WORDS[lang]) for _ in range(n)]
    lines = [" ".join(words[k : k + 12]) for k in range(0, n, 12)]
    return ".\n".join(lines)


def corpus(seed):
    """(doc_id, text, lang) rows, and (item_id, text) rows."""
    rnd = random.Random(seed)
    key = lambda n: "".join(rnd.choice(SIGNS[:62]) for _ in range(n))
    items = [(f"i{k}", prose(rnd, "en", rnd.choice([4, 12, 30])).upper()) for k in range(8)] + [("none", None), (None, "the house and"), ("x", "")]
    texts = [(prose(rnd, lang, rnd.choice([20, 60, 150, 400])), lang) for lang in sorted(WORDS) * 14]
    texts += [(prose(rnd, "de", 30_000), None), ("day " * 300, "en"), ("#| " * 150 + prose(rnd, "en", 20), "en"), (prose(rnd, "en", 40).upper() * 3, "en")]
    for k in range(0, 40, 4):
        words = texts[k][0].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        texts.append((" ".join(words), texts[k][1]))
    texts += [texts[9], texts[9], (texts[9][0].upper(), None)]
    texts += [(f"{prose(rnd, 'en', 40)} {text} {prose(rnd, 'en', 40)}", "en") for _, text in items[:6]]
    texts += [(f"my {text}", "en") for _, text in items[:3]]
    secret = [f'password = "{key(9)}"', f"token: {key(4)}", "AKIA" + key(20).upper(), hashlib.sha256(key(3).encode()).hexdigest(), f"id {key(40)}", "secret=a1b2c3d4 token=abcdefgh"]
    texts += [(f"{prose(rnd, 'es', 60)} {s} {prose(rnd, 'es', 60)}", "es") for s in secret]
    texts += [(None, "en"), ("", "de"), ("12 -- 3", None), (" \n\t", None)]
    rows = [(k, text, lang) for k, (text, lang) in enumerate(texts)]
    rows += [rows[5], rows[5], (6, prose(rnd, "fr", 90), "fr"), (None, rows[7][1], "fr"), (None, None, None)]
    rnd.shuffle(rows)
    return rows, items


def frame(spark, rows):
    data = [(d, t, lang, "s", None if t is None else len(t), 1, "x", True) for d, t, lang in rows]
    return spark.createDataFrame(data, COLUMNS).repartition(3)


def written(spark, folder, rows, items):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ---- languages


def judged(model, text):
    """(language, probability) by summing over all segmentations of each word."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    total = np.zeros(len(model.languages))
    for word, times in Counter(spaced(text.lower())).items():
        marked = "▁" + word
        for k in range(len(model.languages)):

            @lru_cache(None)
            def rest(at, marked=marked, k=k):
                if at == len(marked):
                    return 1.0
                out = 0.0
                for end in range(at + 1, len(marked) + 1):
                    piece = model.pieces.get(marked[at:end])
                    p = model.probability[piece, k] if piece is not None else 1e-6 if end == at + 1 else 0.0
                    out += p * rest(end) if p else 0.0
                return out

            total[k] += times * math.log(rest(0))
    best = int(np.argmax(total))
    return model.languages[best], float(1 / np.exp(total - total[best]).sum())


# ---- near copies


def fingerprint(text):
    words = spaced(ascii_lower(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """A group number for each fingerprint, by flooding."""
    out, number = {}, 0
    for start in fps:
        if start in out:
            continue
        number, open_ = number + 1, [start]
        while open_:
            one = open_.pop()
            out[one] = number
            open_ += [f for f in fps if f not in out and (f ^ one).bit_count() <= 3]
    return out


def one_of_each(rows):
    """One row of each group, and all rows without an id."""
    fps = {text: fingerprint(text) for _, text, _ in rows}
    group = groups(set(fps.values()))
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            number = group[fps[text]]
            least[number] = min(doc, least.get(number, doc))
    kept, used = [], set()
    for doc, text, lang in rows:
        number = group[fps[text]]
        if doc is None or (doc == least[number] and number not in used):
            kept.append((doc, text, lang))
            used.add(number if doc is not None else None)
    return kept


# ---- benchmark passages


def decontaminated(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = set()
    for item, text in items:
        words = word.findall(ascii_lower(text))
        grams |= {tuple(words[k : k + 10]) for k in range(max(len(words) - 9, 1))} if words and item else set()
    out = []
    for doc, text, lang in rows:
        found = list(word.finditer(ascii_lower(text)))
        words, hit = [m[0] for m in found], set()
        for size in {len(g) for g in grams}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in grams:
                    hit.update(range(k, k + size))
        if hit and 2 * len(hit) >= len(words):
            continue
        gone = set()
        for k in hit:
            gone.update(range(found[k].start(), found[k].end()))
            if k + 1 in hit:
                gone.update(range(found[k].end(), found[k + 1].start()))
        out.append((doc, text if text is None else "".join(c for k, c in enumerate(text) if k not in gone), lang))
    return out


# ---- secrets

PATTERNS = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def likely_random(token, ratios):
    codes = [SIGNS.index(c) for c in token]
    tables = [ratios[k : k + len(SIGNS) ** 2] for k in range(0, len(ratios), len(SIGNS) ** 2)]
    ratio = max(sum(table[a * len(SIGNS) + b] for a, b in zip(codes, codes[1:])) for table in tables)
    return ratio >= 12 and ratio >= 0.7 * len(token)


def secret_spans(text, ratios):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    base = list(found)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        if likely_random(m[0], ratios) and all(end <= m.start() or m.end() <= start for start, _, end, _ in base):
            found.append((m.start(), 3, m.end(), "random"))
    return sorted(found)


def without_secrets(text, spans):
    if text is None:
        return None
    runs = []
    for start, _, end, _ in spans:
        if runs and start < runs[-1][1]:
            runs[-1][1] = max(end, runs[-1][1])
        else:
            runs.append([start, end])
    for start, end in reversed(runs):
        text = text[:start] + "[SECRET]" + text[end:]
    return text


def test_secrets_query(spark, tmp_path):
    rows, items = corpus(3)
    got = QUERIES["op6_secrets"][0](spark, written(spark, tmp_path, rows, items)).collect()
    ratios = fit_ratios(labelled_samples(frame(spark, rows).select("doc_id", "text")))
    line = lambda spans: ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
    want, kinds = [], Counter()
    for doc, text, _ in rows:
        spans = secret_spans(text, ratios)
        kinds.update(s[3] for s in spans)
        base = [s for s in spans if s[1] < 3]
        counts = [sum(s[1] == k for s in base) for k in range(3)]
        want.append((str(doc), *counts, hashlib.sha256(line(base).encode()).hexdigest(), line(spans)))
    assert set(kinds) == {"assign", "access", "hex", "random"}
    assert sorted((str(g[0]), *g[1:]) for g in got) == sorted(want)


def test_language_query(spark, tmp_path):
    rows, items = corpus(4)
    got = QUERIES["op7_language"][0](spark, written(spark, tmp_path, rows, items)).collect()
    learn = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1]
    model = fit_languages(frame(spark, learn).select("text", "lang"))
    want = {}
    for doc, text, lang in rows:
        want.setdefault(doc, []).append(judged(model, text))
    assert len(got) == len(rows)
    for g in got:
        assert g["held_out"] == (None if g["doc_id"] is None else zlib.crc32(str(g["doc_id"]).encode()) % 3 == 1)
        assert any(g["lang_pred"] == lang and g["score"] == pytest.approx(score) for lang, score in want[g["doc_id"]])
    label = {d: lang for d, t, lang in rows if lang and t and len(t) > 100 and d not in (5, 6)}
    unseen = [g["lang_pred"] == label[g["doc_id"]] for g in got if g["held_out"] and g["doc_id"] in label]
    assert len(unseen) > 10 and sum(unseen) >= 0.95 * len(unseen)


def char_classes(text):
    def number(c):
        if ord(c) > 127:
            return 7
        tests = (c.isupper(), c.islower(), c.isdigit(), c in " \t", c in "\n\r", c in ".,;:!?'\"-()")
        return tests.index(True) if True in tests else 6

    counts = Counter(map(number, text))
    return [counts[k] for k in range(8)]


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt(max((half(p, q) + half(q, p)) / 2, 0))


def test_quality_query(spark, tmp_path):
    rows, items = corpus(5)
    got = QUERIES["op8_quality"][0](spark, written(spark, tmp_path, rows, items)).collect()
    classes, common = {}, {}
    for _, text, lang in rows:
        if lang and text:
            classes[lang] = np.add(classes.get(lang, 0), char_classes(text))
            common.setdefault(lang, Counter()).update(spaced(ascii_lower(text)))
    want = []
    for doc, text, lang in rows:
        own, words = [lang] if lang in classes else sorted(classes), spaced(ascii_lower(text))
        by_char = by_word = None
        if len(text or "") >= 200:
            by_char = min(distance(char_classes(text), classes[x]) for x in own)
        if len(words) >= 50:
            found = []
            for x in own:
                top = sorted(common[x], key=lambda w: (-common[x][w], w.encode()))[:100]
                p, q = [words.count(w) for w in top], [common[x][w] for w in top]
                found.append(distance([*p, len(words) - sum(p)], [*q, common[x].total() - sum(q)]))
            by_word = min(found)
        far = (by_char or 0) > 0.28 or (by_word or 0) > 0.53
        want.append((str(doc), len(words), round(by_char or 0, 9), round(by_word or 0, 9), far))
    assert sorted((str(g["doc_id"]), g["n_words"], round(g["char_js"] or 0, 9), round(g["word_js"] or 0, 9)) for g in got) == sorted(w[:4] for w in want)
    verdict = {w[:4]: w[4] for w in want}
    for g in got:
        far = verdict[str(g["doc_id"]), g["n_words"], round(g["char_js"] or 0, 9), round(g["word_js"] or 0, 9)]
        assert g["kept"] == (not g["base_failed"] and not far)
    assert len({(g["base_failed"], g["kept"]) for g in got}) == 3


def test_pipeline_equals_plain_python(spark, tmp_path):
    rows, items = corpus(6)
    got = corpus_pipeline.run(spark, written(spark, tmp_path, rows, items)).collect()
    model = fit_languages(frame(spark, rows).select("text", "lang"))
    verdicts = [judged(model, text) for _, text, _ in rows]
    known = [row for row, (lang, score) in zip(rows, verdicts) if lang != "und" and score >= 0.5]
    single = one_of_each(known)
    clean = decontaminated(single, items)
    ratios = fit_ratios(labelled_samples(frame(spark, clean)))
    masked = [(doc, without_secrets(text, secret_spans(text, ratios))) for doc, text, _ in clean]
    assert len(rows) > len(known) > len(single) > len(clean) > 40 and any("[SECRET]" in text for _, text in masked)
    ids = [x.ids for x in encoder().whole.encode_batch([text for _, text in masked], add_special_tokens=False)]
    want = sorted((repr(doc), (*own, 0)) for (doc, _), own in zip(masked, ids))
    parts, sequences = {}, {}
    for p in got:
        parts.setdefault((repr(p["doc_id"]), p["doc_tokens"]), []).append((p["start"], tuple(np.frombuffer(p["ids"], "<u4").tolist())))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert len({(doc, len(own)) for doc, own in want}) == len(want)
    assert sorted((key[0], sum((own for _, own in sorted(parts[key])), ())) for key in parts) == want
    for own in sequences.values():
        own.sort()
        assert [at for at, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_pipeline_stages_on_empty_tables(spark, tmp_path):
    rows, items = corpus(7)
    assert corpus_pipeline.run(spark, written(spark, tmp_path, rows[:0], items[:0])).count() == 0


def test_repeated_ids_keep_one_row_of_each_group(spark):
    rows, _ = corpus(8)
    docs = frame(spark, [r for r in rows if r[1]])
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["lang"]) for r in kept.collect()))) == sorted(map(repr, one_of_each([r for r in rows if r[1]])))
