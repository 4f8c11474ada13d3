"""Language identification with unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import MASKS, NOT_SPACE, Words, append, arrow_pass, extended, share, without

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_ROWS = 800  # labelled texts to learn from, spread evenly over the languages
SAMPLE_CHARS = 20_000  # only texts of at most this length are drawn for the sample
ROUNDS = 3  # of expectation and maximisation
SMOOTHING = 0.1
UNKNOWN = 1e-6  # probability of a character outside the vocabulary
CACHED_WORDS = 500_000  # 24 bytes, and 8 for each language
SHORT = 40  # words up to this length are summed many at once; products of so many probabilities do not underflow
AT_ONCE = 4096
UND = "und"

_ROLL = np.uint64(0x9E3779B97F4A7C15)
_LETTER = regex.compile(r"\p{L}")
_MARK = "▁"  # begins the first piece of a word in the vocabulary


def vocabulary(name: str = VOCABULARY) -> list[str]:
    """The pieces of a published vocabulary, in its order; control and byte pieces left out."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    kept = (k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)))
    return [model.id_to_piece(k) for k in kept]


class PieceModel:
    """Probabilities of pieces, a column for each language.

    Probability of a word: the sum over all ways to write it as pieces (forward algorithm).
    A character outside the vocabulary is a piece of its own, with a fixed probability.
    """

    def __init__(self, languages: list[str], pieces: dict[str, int], probability: np.ndarray):
        self.languages, self.pieces = languages, pieces
        self.probability = np.vstack([probability, np.full(len(languages), UNKNOWN)])
        self.longest = max(map(len, pieces), default=1)
        self.by_length = {}
        for length in range(1, self.longest + 1):
            own = [p for p in pieces if len(p) == length]
            if own:
                hashes = np.array([_piece_hash(p) for p in own], dtype=np.uint64)
                order = np.argsort(hashes)
                self.by_length[length] = hashes[order], np.array([pieces[p] for p in own])[order]
        self.known, self.values = np.empty(0, dtype=np.uint64), np.empty((0, len(languages)))
        self.heads, self.sizes = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

    @classmethod
    def fit(cls, counts: dict[str, dict[str, int]], names: Iterable[str], rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> PieceModel:
        """Learn from word counts by language, by expectation and maximisation over the pieces that occur."""
        languages, names = sorted(counts), set(names)
        longest = max(map(len, names), default=1)
        # a long word, such as a sentence in a script without blanks, is learned from in parts
        column, parts = {lang: k for k, lang in enumerate(languages)}, {}
        for lang, own in counts.items():
            for word, times in own.items():
                marked = _MARK + word
                for at in range(0, len(marked), SHORT):
                    parts.setdefault(marked[at : at + SHORT], np.zeros(len(languages)))[column[lang]] += times
        words = sorted(parts)
        weight = np.array([parts[w] for w in words], dtype=float)
        found: dict[str, int] = {}
        for marked in words:
            for i in range(len(marked)):
                for j in range(i + 1, min(len(marked), i + longest) + 1):
                    if marked[i:j] in names:
                        found.setdefault(marked[i:j], len(found))
        model = cls(languages, found, np.full((len(found), len(languages)), 1 / (len(found) or 1)))
        for _ in range(rounds):
            expected = np.full((len(found) + 1, len(languages)), smoothing)
            for lo in range(0, len(words), AT_ONCE):
                model._expect(words[lo : lo + AT_ONCE], weight[lo : lo + AT_ONCE], expected)
            model.probability[:-1] = expected[:-1] / expected[:-1].sum(axis=0)
        return model

    def _edges(self, marked: list[str]) -> np.ndarray:
        """(end, word, begin, piece) of every piece in every word, by end and word; the last number of a piece is an unknown character.

        Pieces are found by a rolling hash of all substrings of one length at a time.
        """
        signs = np.frombuffer("".join(marked).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        size = np.array([len(w) for w in marked])
        word = np.repeat(np.arange(len(marked)), size)
        begin = np.arange(len(signs)) - np.repeat(np.cumsum(size) - size, size)
        room, hashes, parts = size[word] - begin, np.zeros(len(signs), dtype=np.uint64), []
        for length in range(1, min(self.longest, int(size.max())) + 1):
            hashes = hashes[: len(signs) - length + 1] * _ROLL + signs[length - 1 :]
            known, numbers = self.by_length.get(length, (np.zeros(1, np.uint64), np.zeros(1, np.int64)))
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            match = (known[near] == hashes) & (room[: len(hashes)] >= length)
            piece = numbers[near]
            if length == 1:
                piece = np.where(match, piece, len(self.pieces))
                match = np.ones(len(match), dtype=bool)
            at = np.flatnonzero(match)
            parts.append(np.stack([begin[at] + length, word[at], begin[at], piece[at]], axis=1))
        edges = np.concatenate(parts)
        return edges[np.argsort(edges[:, 0] * len(marked) + edges[:, 1], kind="stable")]

    def _forward(self, marked: list[str], edges: np.ndarray) -> np.ndarray:
        """Summed probability of each beginning of each word."""
        size = np.array([len(w) for w in marked])
        ahead = np.zeros((len(marked), size.max() + 1, len(self.languages)))
        ahead[:, 0] = 1
        cuts = np.searchsorted(edges[:, 0], np.arange(1, size.max() + 2))
        for end, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:]), 1):
            _, word, begin, piece = edges[lo:hi].T
            firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            ahead[word[firsts], end] = np.add.reduceat(ahead[word, begin] * self.probability[piece], firsts, axis=0)
        return ahead

    def _expect(self, marked: list[str], weight: np.ndarray, expected: np.ndarray) -> None:
        edges = self._edges(marked)
        ahead = self._forward(marked, edges)
        size = np.array([len(w) for w in marked])
        back = np.zeros(ahead.shape)
        back[np.arange(len(marked)), size] = 1
        cuts = np.searchsorted(edges[:, 0], np.arange(1, size.max() + 2))
        for end in range(size.max(), 0, -1):
            _, word, begin, piece = edges[cuts[end - 1] : cuts[end]].T
            np.add.at(back, (word, begin), self.probability[piece] * back[word, end])
        end, word, begin, piece = edges.T
        share = ahead[word, begin] * self.probability[piece] * back[word, end] / ahead[word, size[word]]
        np.add.at(expected, piece, share * weight[word])

    def words(self, words: list[str]) -> np.ndarray:
        """Log probabilities of words in each language."""
        out = np.empty((len(words), len(self.languages)))
        short = [k for k, w in enumerate(words) if len(w) < SHORT]
        short.sort(key=lambda k: len(words[k]))
        for lo in range(0, len(short), AT_ONCE):
            members = short[lo : lo + AT_ONCE]
            marked = [_MARK + words[k] for k in members]
            ahead = self._forward(marked, self._edges(marked))
            out[members] = np.log(ahead[np.arange(len(marked)), [len(w) for w in marked]])
        for k, word in enumerate(words):
            if len(word) >= SHORT:
                out[k] = self._long(_MARK + word)
        return out

    def _long(self, marked: str) -> np.ndarray:
        """The same for one long word; only the last places are kept, and the scale apart."""
        recent, scale = [np.ones(len(self.languages))], np.zeros(len(self.languages))
        for end in range(1, len(marked) + 1):
            total = np.zeros(len(self.languages))
            for back, ahead in enumerate(reversed(recent), 1):
                piece = self.pieces.get(marked[end - back : end])
                if piece is not None or back == 1:
                    total = total + ahead * self.probability[len(self.pieces) if piece is None else piece]
            recent = [*recent[-self.longest + 1 :], total] if self.longest > 1 else [total]
            if end % 16 == 0:
                most = np.max(recent, axis=0)
                scale += np.log(most)
                recent = [r / most for r in recent]
        return np.log(recent[-1]) + scale

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each whole text, and its probability among the languages."""
        judged = [k for k, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        out = [(UND, 0.0)] * len(texts)
        if judged:
            found = Words([texts[k].lower().encode() for k in judged], NOT_SPACE)
            logs = self._logs(found)
            for k, lo, hi in zip(judged, found.bounds[:-1], found.bounds[1:]):
                total = logs[lo:hi].sum(axis=0)
                best = int(np.argmax(total))
                out[k] = self.languages[best], float(1 / np.exp(total - total[best]).sum())
        return out

    def _logs(self, found: Words) -> np.ndarray:
        """Log probabilities of all words; those met before are looked up by hash, length and first 8 bytes."""
        import pandas as pd

        code, distinct = pd.factorize(found.hashes())
        first = np.empty(len(distinct), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        loads = np.ndarray((len(found.buffer) - 7,), dtype="<u8", buffer=found.buffer, strides=(1,))
        sizes = found.ends[first] - found.starts[first]
        heads = loads[found.starts[first]] & MASKS[np.minimum(sizes, 8)]
        at = np.searchsorted(self.known, distinct)
        values, new = np.empty((len(distinct), len(self.languages))), np.ones(len(distinct), dtype=bool)
        if len(self.known):
            near = np.minimum(at, len(self.known) - 1)
            new = (self.known[near] != distinct) | (self.heads[near] != heads) | (self.sizes[near] != sizes)
            values[~new] = self.values[near[~new]]
        new = np.flatnonzero(new)
        values[new] = self.words([found.word(k).decode() for k in first[new]])
        if len(self.known) < CACHED_WORDS:
            new = new[np.argsort(distinct[new])]
            for name, more in (("known", distinct), ("heads", heads), ("sizes", sizes), ("values", values)):
                setattr(self, name, np.insert(getattr(self, name), at[new], more[new], axis=0))
        return values[code]

    def __getstate__(self):
        return self.languages, self.pieces, self.probability[:-1]

    def __setstate__(self, state):
        self.__init__(*state)


def _piece_hash(piece: str) -> int:
    out = 0
    for sign in piece:
        out = (out * int(_ROLL) + ord(sign)) % 2**64
    return out


def fit_languages(
    labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, names: Iterable[str] | None = None
) -> PieceModel:
    """Learn from labelled texts (text, lang): a bounded sample of the distinct ones, evenly over the languages, by hash of the text.

    Rows without text or label are not used. Every language has texts in the sample, however often its rows repeat. The driver gets
    the distinct words of at most `sample_rows` texts of at most `sample_chars` characters each.
    """
    rows = labelled.where(f"lang IS NOT NULL AND length(text) BETWEEN 1 AND {sample_chars}").selectExpr("lang", "text", "xxhash64(text) AS h")
    counted = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    shares = F.create_map(*[F.lit(x) for lang, n in counted.items() for x in (lang, share(n, sample_rows))]) if counted else F.create_map()
    few = rows.where(F.expr("pmod(h, 1000000007)") < F.try_element_at(shares, "lang")) if counted else rows
    ranked = few.select("lang", "h").distinct().withColumn("turn", F.expr("row_number() OVER (PARTITION BY lang ORDER BY h)"))
    drawn = [r["h"] for r in ranked.where(f"turn <= {sample_rows}").orderBy("turn", "lang").limit(sample_rows).collect()]
    sample = rows.where(F.col("h").isin(drawn)).dropDuplicates(["lang", "h"])
    words = sample.selectExpr("lang", r"explode(split(lower(text), '\\s+')) AS word").where("word <> ''")
    counts: dict[str, dict[str, int]] = {}
    for row in words.groupBy("lang", "word").count().collect():
        counts.setdefault(row["lang"], {})[row["word"]] = row["count"]
    return PieceModel.fit(counts, vocabulary() if names is None else names)


def identify(docs: DataFrame, model: PieceModel) -> DataFrame:
    """Add lang_pred (a learned language, or `und`) and score (0 to 1) to each row of docs (text, ...).

    A text is `und`, with score 0, if it is null, has no letter, or nothing was learned. Whole texts
    count, however long. Equal likelihoods go to the language that comes first by name. Repeated
    rows are judged alike; input columns named lang_pred or score are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        judge = shared.value
        for batch in batches:
            found = judge.texts(batch["text"].to_pylist())
            yield append(batch, lang_pred=pa.array([f[0] for f in found], pa.string()), score=pa.array([f[1] for f in found], pa.float64()))

    docs = without(docs, "lang_pred", "score")
    return arrow_pass(docs, step, extended(docs, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())))
