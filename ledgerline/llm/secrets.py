"""Secret scans: fixed patterns, and tokens that look more like random strings than like identifiers.

Everything is a column expression; only the fitted table of log-likelihood ratios, of a fixed
size, passes through the driver.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import share, unused, without
from ledgerline.llm.language import vocabulary

# fixed values: the patterns, in the order in which kinds are listed
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more; the same spans as all AKIA[A-Z0-9]+ of that length
HEX = r"[0-9a-f]{24,}"

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
# what ordinary names are learned from: shorter than a token that is scanned, so an unmarked secret is none of them
NAME = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9+/_=-]{5,18}(?![A-Za-z0-9+/_=-])"
SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# alphabets of random strings, a narrower one before a wider one it is part of
ALPHABETS = ("0-9a-f", "0-9A-F", "0-9A-Z", "0-9a-z", "A-Za-z0-9+/_=-")
LEAST_RATIO = 12.0  # nats by which a random model must be likelier
SIGN_RATIO = 0.7  # and nats for each sign, so that a long name does not gather them
SMOOTHING = 0.5
SAMPLE_DOCS = 500  # texts that labelled samples are taken from
RANDOM_STRINGS = 2000
MASK = "[SECRET]"

_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
_NONE = f"CAST(array() AS array<{_SPAN}>)"
_NONE_FOUND = "CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string,found:string,long:int>>)"
CHUNK = 128  # list entries added up together


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(numbers: Column) -> Column:
    """The sum of all numbers before each one; taken in chunks, as every number added to a list copies the list."""

    def of(chunks):
        def grown(items, first):
            return F.aggregate(items, F.array(first), lambda done, x: F.array_append(done, F.element_at(done, -1) + x))

        firsts = grown(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda total, x: total + x)), F.lit(0))
        sums = F.zip_with(chunks, F.slice(firsts, 1, F.size(chunks)), lambda c, first: F.slice(grown(c, first), 1, F.size(c)))
        return F.flatten(sums)

    def cut(items):
        chunks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
        return F.transform(chunks, lambda c: F.slice(items, c * CHUNK + 1, F.lit(CHUNK)))

    return _let(numbers, lambda items: _let(cut(items), of))


def _spans(text: str, pattern: str, kind: str, rank: int, group: int = 0, least: int = 1) -> Column:
    """Spans of all matches of a pattern whose group has a length, with the matched text: places follow from the lengths of what lies between."""
    text = F.col(text)
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.zip_with(F.slice(parts, 1, F.size(found)), F.arrays_zip(found.alias("found"), values.alias("value")), _piece)

    def placed(pieces):
        steps = F.transform(pieces, lambda p: p["gap"] + F.length(p["found"]))

        def one(p, before):
            begin = before + p["gap"]
            names = (begin.alias("start"), F.lit(rank).alias("rank"), (begin + F.length(p["found"])).alias("end"), F.lit(kind).alias("kind"))
            return F.struct(*names, p["found"].alias("found"), p["long"].alias("long"))

        return F.zip_with(pieces, _running(steps), one)

    spans = F.filter(_let(pieces, placed), lambda s: s["long"] >= least)
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(_NONE_FOUND))


def _piece(part: Column, match: Column) -> Column:
    return F.struct(F.length(part).alias("gap"), match["found"].alias("found"), F.length(match["value"]).alias("long"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))


def _clear(tokens: Column, spans: Column) -> Column:
    """Tokens, which follow one another, that overlap none of the spans.

    A token overlaps as many spans as begin before its end, less those that end by its start; both numbers come from
    sorting the ends in question together and counting along.
    """

    def before(of_token: str, of_span: str, token_first: bool) -> Column:
        asked = F.transform(tokens, lambda t: F.struct(t[of_token].alias("at"), F.lit(0 if token_first else 1).alias("turn"), F.lit(0).alias("n")))
        marks = F.transform(spans, lambda s: F.struct(s[of_span].alias("at"), F.lit(1 if token_first else 0).alias("turn"), F.lit(1).alias("n")))

        def counted(events):
            sums = _running(F.transform(events, lambda e: e["n"]))
            both = F.zip_with(events, sums, lambda e, n: F.struct(e["n"].alias("span"), n.alias("before")))
            return F.transform(F.filter(both, lambda x: x["span"] == 0), lambda x: x["before"])

        return _let(F.array_sort(F.concat(asked, marks)), counted)

    overlaps = F.zip_with(before("end", "start", True), before("start", "end", False), lambda a, b: a - b)
    judged = F.zip_with(tokens, overlaps, lambda t, n: F.struct(t.alias("token"), n.alias("n")))
    return F.transform(F.filter(judged, lambda x: x["n"] == 0), lambda x: x["token"])


def base_spans(text: str = "text") -> Column:
    """(start, rank, end, kind) of the pattern matches, sorted by start and order of kinds; code points, end exclusive."""
    kinds = [
        _spans(text, ASSIGN, "assign", 0, group=2, least=ASSIGN_LEAST),
        _spans(text, ACCESS, "access", 1),
        _spans(text, HEX, "hex", 2),
    ]
    return F.array_sort(F.concat(*map(_plain, kinds)))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, random_strings: int = RANDOM_STRINGS) -> DataFrame:
    """(token, secret): strings the patterns call secret and digests written in every alphabet, against ordinary words and identifiers of 6 to 19 signs.

    From at most `sample_docs` different texts, drawn by hash from all distinct ones.
    """
    texts = docs.selectExpr("text", "xxhash64(text) AS h").where("text IS NOT NULL")
    distinct = texts.agg(F.approx_count_distinct("h")).first()[0]
    few = texts.where(F.expr("pmod(h, 1000000007)") < share(distinct, sample_docs))
    drawn = [r["h"] for r in few.select("h").distinct().orderBy("h").limit(sample_docs).collect()]
    sample = texts.where(F.col("h").isin(drawn)).dropDuplicates(["h"]).select("text")
    pattern = F.lit(rf"{ASSIGN}|{ACCESS}|{HEX}")
    hits = sample.select(F.explode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("hit"))
    hits = hits.select(F.regexp_extract("hit", r"([A-Za-z0-9+/_=-]+)$", 1).alias("token")).where("length(token) >= 16")
    plain = F.regexp_replace("text", pattern, F.lit(" "))
    ordinary = sample.select(F.explode(F.regexp_extract_all(plain, F.lit(NAME), F.lit(0))).alias("token"))
    digests = docs.sparkSession.range(random_strings).selectExpr("sha2(CAST(id AS STRING), 256) AS digest")
    letters = digests.selectExpr("digest", f"concat({', '.join(f'conv(substring(digest, {k}, 12), 16, 36)' for k in (1, 14, 27, 40, 53))}) AS letters")
    written = "array(digest, upper(digest), rtrim('=', base64(unhex(digest))), upper(letters), lower(letters))"
    random = letters.selectExpr(f"explode({written}) AS token")
    return hits.unionAll(random).withColumn("secret", F.lit(True)).unionAll(ordinary.withColumn("secret", F.lit(False)))


def ordinary_pairs() -> Counter:
    """How often each sign follows each other one in the words of a published vocabulary: what is ordinary where a table says little."""
    words = (piece.lstrip("\u2581") for piece in vocabulary())
    return Counter(pair for word in words if len(word) >= 4 and word.isascii() and word.isalpha() for pair in zip(word, word[1:]))


def fit_ratios(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of each sign after each sign, from samples (token, secret): a table for each of ALPHABETS.

    First-order Markov models with additive smoothing: one of random strings for each alphabet, as a string in
    hex says nothing about one in base 64, and one of ordinary names, which also knows the words of a published
    vocabulary. Row and column numbers follow SIGNS.
    """
    alphabet = " ".join(f"WHEN token RLIKE '^[{signs}]+$' THEN {k}" for k, signs in enumerate(ALPHABETS))
    rows = samples.where("token IS NOT NULL AND secret IS NOT NULL")
    rows = rows.select(F.expr(f"IF(secret, CASE {alphabet} END, -1)").alias("model"), F.split("token", "").alias("s"))
    pairs = rows.where("model IS NOT NULL AND size(s) > 1").select(
        "model", F.explode(F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.concat(F.get("s", i - 1), F.get("s", i)))).alias("pair")
    )
    n = len(SIGNS)
    counts = {k: [smoothing] * (n * n) for k in range(-1, len(ALPHABETS))}
    known = [(-1, a + b, times) for (a, b), times in ordinary_pairs().items()]
    for model, pair, times in [*known, *pairs.groupBy("model", "pair").count().where("length(pair) = 2").collect()]:
        a, b = map(SIGNS.find, pair)
        if a >= 0 and b >= 0:
            counts[model][a * n + b] += times
    logs = {}
    for k, table in counts.items():
        totals = [sum(table[a * n : a * n + n]) for a in range(n)]
        logs[k] = [math.log(x / totals[i // n]) for i, x in enumerate(table)]
    return [x - y for k in range(len(ALPHABETS)) for x, y in zip(logs[k], logs[-1])]


def _ratio(token: Column, table: Column) -> Column:
    """Summed log-likelihood ratio of the transitions in a token, for the random model it fits best."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(SIGNS), c) - 1)
    start = F.struct(F.lit(-1).alias("last"), F.array(*[F.lit(0.0)] * len(ALPHABETS)).alias("sums"))

    def add(done, code):
        place = done["last"] * len(SIGNS) + code
        grown = F.array(*[F.get(done["sums"], k) + F.get(table, place + k * len(SIGNS) ** 2) for k in range(len(ALPHABETS))])
        return F.struct(code.alias("last"), F.when(done["last"] >= 0, grown).otherwise(done["sums"]).alias("sums"))

    return F.aggregate(codes, start, add, lambda done: F.array_max(done["sums"]))


def find_secrets(docs: DataFrame, ratios: list[float] | None = None, least_ratio: float = LEAST_RATIO, sign_ratio: float = SIGN_RATIO) -> DataFrame:
    """Add column `secrets`: (start, rank, end, kind) spans of docs (text, ...), by start and then order of kinds.

    Kinds assign, access and hex are pattern matches; `random` are other tokens of 20 signs or more, clear of those,
    for which one of the random models is likelier by `least_ratio` nats, and by `sign_ratio` nats for each sign. Without `ratios`
    they are fitted on docs.

    A null or empty text has no span. Whole texts are scanned, and the work grows little faster than the number of
    spans in one text. Repeated rows are judged alike; an input column named `secrets` is replaced, all others stay.
    """
    ratios = fit_ratios(labelled_samples(docs)) if ratios is None else ratios
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    docs = without(docs, "secrets")
    base, tokens = unused(docs, "_base"), unused(docs, "_tokens")
    marked = docs.withColumn(base, base_spans()).withColumn(tokens, _spans("text", TOKEN, "random", 3))
    clear = F.when((F.size(tokens) > 0) & (F.size(base) > 0), _clear(F.col(tokens), F.col(base))).otherwise(F.col(tokens))
    marked = marked.withColumn(tokens, clear)

    def likely(token, table):
        return _ratio(token["found"], table) >= F.greatest(F.lit(least_ratio), sign_ratio * F.length(token["found"]))

    judged = _let(table, lambda ratios: F.filter(tokens, lambda t: likely(t, ratios)))
    random = F.when(F.size(tokens) > 0, _plain(judged)).otherwise(F.expr(_NONE))
    spans = F.when(F.col("text").isNull(), F.expr(_NONE)).otherwise(F.array_sort(F.concat(base, random)))
    return marked.withColumn("secrets", spans).drop(base, tokens)


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def masked(text: str, spans: str, mask: str = MASK) -> Column:
    """The text with every span, or run of overlapping spans, replaced."""
    whole = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, span):
        gap = F.substring(whole, done["at"] + 1, span["start"] - done["at"])
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def end(done):
        return F.concat(done["out"], F.substring(whole, done["at"] + 1, F.length(whole)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, end)).otherwise(whole)
