"""Corpus pipeline: raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns the columns of documents; the last returns
pieces of sequences. A text is never shortened for a stage's sake, and all rows take part in each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.decontaminate import find_leaks
from ledgerline.llm.dropped import PLACE, stored, without_dropped, write_bitmaps
from ledgerline.llm.language import UND, fit_languages, identify
from ledgerline.llm.packing import pack
from ledgerline.llm.secrets import find_secrets, masked
from ledgerline.llm.simhash import near_duplicates
from ledgerline.session import shared_dir

LEAST_SCORE = 0.5  # a language must be likelier than all others together
MOST_LEAKED = 0.5  # share of hit words from which a document goes as a whole
SHINGLE, MAX_BITS = 3, 3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter or without a clear language; the languages are those labelled in docs."""
    model = fit_languages(docs.select("text", "lang"))
    judged = identify(_carried(docs), model).where(f"lang_pred <> '{UND}' AND score >= {LEAST_SCORE}")
    return _restored(judged, docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest doc_id; rows without an id all stay.

    A row is known by its place in the stored table, so of rows that share an id the first by file and number stays. Only
    ids and places are shuffled; the texts are filtered where they are read.
    """
    docs = stored(docs)
    known = docs.selectExpr(f"IF(doc_id IS NULL, NULL, named_struct('id', doc_id, 'place', {PLACE})) AS doc_id", "text")
    found = near_duplicates(known, SHINGLE, MAX_BITS)
    folder = f"{shared_dir(spark)}/dropped-{uuid.uuid4().hex}"
    write_bitmaps(found.where("doc_id <> component_id").select("doc_id.place.*"), folder)
    return without_dropped(docs, folder)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out of the texts; a document goes if at least half of its words are hit."""
    found = find_leaks(_carried(docs), table(spark, sf_dir, "benchmark"), clean="_clean")
    kept = found.where(f"leaks.n_hit = 0 OR leaks.n_hit < {MOST_LEAKED} * leaks.n_words")
    return _restored(kept, docs, "_clean")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mask."""
    found = find_secrets(_carried(docs))
    return _restored(found.withColumn("_masked", masked("text", "secrets")), docs, "_masked")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    return pack(docs)


def _carried(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that their names cannot clash with a result's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("_doc"), "text")


def _restored(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of docs, with the text of another column; n_chars counts anew where the text has changed."""
    columns = {c: F.col(f"_doc.`{c}`") for c in docs.columns if c != "text"}
    columns["text"] = F.col(text)
    if text != "text" and "n_chars" in columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col(text).eqNullSafe(F.col("text")), columns["n_chars"]).otherwise(length)
    return rows.select(*[columns[c].alias(c) for c in docs.columns])


STAGES = [
    ("language", known_language),
    ("simhash", one_of_near_copies),
    ("decontaminate", without_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each read back from the shared folder before the next."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
