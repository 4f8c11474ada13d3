"""Quality rules: plain counts, and the distance of a text's histograms from those of its language."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import LOWER, append, arrow_pass, as_bytes, byte_class, extended, without

# fixed values: signs counted as symbols
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
COMMON_WORDS = 100  # most frequent words of a language that its word histogram tells apart
CHAR_DISTANCE = 0.28
WORD_DISTANCE = 0.53
GUARD_CHARS = 200  # shorter texts are not judged by their characters
GUARD_WORDS = 50  # nor those with fewer words by their words
FLUSH_WORDS = 200_000

# Classes of the first byte of a character: capital, small, digit, blank, line end, mark of a sentence, other sign, beyond ASCII.
_CLASSES = 8
_CLASS = np.full(256, 6, dtype=np.int64)
for _number, _bytes in enumerate((range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), b"\x20\x09", b"\n\r", b".,;:!?'\"-()")):
    _CLASS[byte_class(*_bytes)] = _number
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = _CLASSES  # goes on with a character: not counted

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines equal to an earlier one, words in 3-word windows found twice or more."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    chars = sum(map(len, words)) - len(text) + len(text.decode())  # all white space has one byte
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else []
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, after = Counter(windows), 0
        for k, window in enumerate(windows):
            if times[window] > 1:
                repeated += k + 3 - max(k, after)
                after = k + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=_CLASSES + 1)[:_CLASSES]


def references(docs: DataFrame, common: int = COMMON_WORDS) -> dict[str, tuple[np.ndarray, dict[bytes, int], np.ndarray]]:
    """By language: class histogram, the number of each common word, and word histogram (the last: all other words).

    Counted over all texts of docs (text, lang); rows without a language or text are not used. The driver gets
    `common` words and a few numbers for each language.
    """

    def step(batches):
        found: Counter = Counter()

        def flush():
            keys = list(found)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.binary()), pa.array(found.values(), pa.int64())],
                names=["lang", "kind", "word", "n"],
            )
            found.clear()
            return out

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), as_bytes(batch["text"])):
                for number, n in enumerate(_class_counts(text).tolist()):
                    found[lang, number, b""] += n
                words = Counter(text.translate(LOWER).split())
                found[lang, -1, b""] += words.total()
                for word, n in words.items():
                    found[lang, -2, word] += n
            if len(found) > FLUSH_WORDS:
                yield flush()
        if found:
            yield flush()

    known = docs.where("lang IS NOT NULL AND text <> ''").select("lang", "text")
    counts = arrow_pass(known, step, "lang string, kind int, word binary, n long").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("place", F.expr("row_number() OVER (PARTITION BY lang, kind ORDER BY n DESC, word)"))
    rows = ranked.where(f"place <= {common}").orderBy("lang", "kind", "place").collect()
    out = {}
    for lang in sorted({r["lang"] for r in rows}):
        own = [r for r in rows if r["lang"] == lang]
        classes, words = np.zeros(_CLASSES), [(bytes(r["word"]), r["n"]) for r in own if r["kind"] == -2]
        for r in own:
            if r["kind"] >= 0:
                classes[r["kind"]] = r["n"]
        total = next(r["n"] for r in own if r["kind"] == -1)
        numbers = np.array([n for _, n in words] + [total - sum(n for _, n in words)], dtype=float)
        out[lang] = classes / max(classes.sum(), 1), {w: k for k, (w, _) in enumerate(words)}, numbers / max(numbers.sum(), 1)
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (root of the divergence in bits): 0 for equal histograms, 1 for disjoint ones."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / middle), 0) + np.where(q > 0, q * np.log2(q / middle), 0)
    return float(np.sqrt(max(parts.sum() / 2, 0.0)))


def judge(
    docs: DataFrame, refs: dict | None = None, char_distance: float = CHAR_DISTANCE, word_distance: float = WORD_DISTANCE
) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_js, word_js, base_failed, kept to docs (text, lang, ...).

    base_failed: under LEAST_WORDS words, or more than MOST_REPEATED percent in repeated windows. kept: not base_failed,
    and neither distance above its limit. char_js and word_js are distances to the references of the
    row's language; without one (null or never counted), to the nearest language. They are null,
    and do not count against a text, where it has fewer than GUARD_CHARS characters or GUARD_WORDS words,
    or where there is no reference.

    A null text counts as empty; whole texts count, however long; repeated rows are judged alike.
    Input columns with the names above are replaced. Without `refs` they are taken from docs itself.
    """
    refs = references(docs) if refs is None else refs
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def distances(text: bytes, lang: str | None, n_words: int):
        known = shared.value
        own = [known[lang]] if lang in known else list(known.values())
        chars = _class_counts(text)
        by_char = by_word = None
        if own and chars.sum() >= GUARD_CHARS:
            by_char = min(js_distance(chars / chars.sum(), classes) for classes, _, _ in own)
        if own and n_words >= GUARD_WORDS:
            words, found = Counter(text.translate(LOWER).split()), []
            for _, numbers, reference in own:
                histogram = np.zeros(len(reference))
                for word, k in numbers.items():
                    histogram[k] = words.get(word, 0)
                histogram[-1] = n_words - histogram.sum()
                found.append(js_distance(histogram / n_words, reference))
            by_word = min(found)
        return by_char, by_word

    def step(batches):
        for batch in batches:
            rows = []
            for text, lang in zip(as_bytes(batch["text"]), batch["lang"].to_pylist()):
                counts = base_counts(text)
                rows.append((*counts, *distances(text or b"", lang, counts[0])))
            kinds = [pa.int64()] * 5 + [pa.float64()] * 2
            columns = list(zip(*rows)) or [()] * 7
            yield append(batch, **{name: pa.array(c, k) for name, c, k in zip((*COUNTS, "char_js", "word_js"), columns, kinds)})

    docs = without(docs, *COUNTS, "char_js", "word_js", "base_failed", "kept")
    fields = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in ("char_js", "word_js")]
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    near = f"coalesce(char_js, 0D) <= {char_distance}D AND coalesce(word_js, 0D) <= {word_distance}D"
    return arrow_pass(docs, step, extended(docs, *fields)).selectExpr("*", f"{failed} AS base_failed", f"NOT ({failed}) AND {near} AS kept")
