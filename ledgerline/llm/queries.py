"""Registered queries of this subpackage: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import sql
from ledgerline.llm.caps import near_vectors
from ledgerline.llm.common import table
from ledgerline.llm.decontaminate import find_leaks
from ledgerline.llm.language import fit_languages, identify
from ledgerline.llm.manifest import folded, manifest, proof, tampered_leaf
from ledgerline.llm.negatives import hard_negatives
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import judge
from ledgerline.llm.secrets import find_secrets, written
from ledgerline.llm.simhash import near_duplicates
from ledgerline.llm.substring import remove_later_copies
from ledgerline.llm.suffix import remove_repeats
from ledgerline.llm.training_order import materialise, read_shards
from ledgerline.llm.warc import read_archives, roles, write_archives


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return leaks.selectExpr(
        "doc_id",
        "leaks.n_words AS n_words",
        "leaks.n_hit AS n_hit",
        "CAST(size(leaks.items) AS BIGINT) AS n_items",
        "sha2(concat_ws(',', leaks.items), 256) AS items_sha256",
        "leaks.n_hit > 0 AS contaminated",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "n_bytes", "n_removed", "CAST(size(spans) AS BIGINT) AS n_spans", "sha2(kept, 256) AS kept_sha256")


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each sequence, read back from the shards."""
    shards = materialise(table(spark, sf_dir, "documents"), key=20240501)
    return read_shards(shards).selectExpr(
        "slot", "shard", "byte_offset", "doc_id", "doc_start", "n_tokens", "crc32(ids) AS ids_crc32"
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = write_archives(roles(pages))
    return read_archives(archives, pages.schema["page_id"].dataType.simpleString()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = "filter(secrets, s -> s.rank < 3)"
    counts = [f"CAST(size(filter(secrets, s -> s.rank = {k})) AS BIGINT) AS {n}" for k, n in enumerate(("n_assign", "n_access", "n_hex"))]
    digest = F.sha2(written(F.expr(base)), 256).alias("base_sha256")
    return found.select("doc_id", *map(F.expr, counts), digest, written(F.col("secrets")).alias("spans"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1"
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "lang", f"{held_out} AS held_out")
    model = fit_languages(docs.where("NOT held_out").select("text", "lang"))
    return identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_js", "word_js")
    return judged.select("doc_id", *names)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), derive=("crc32(ids) AS ids_crc32",))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_later_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256")


def op11_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "label", "embedding"))
    return found.selectExpr("id AS vec_id", "n_links", "component_id", "id = component_id AS kept")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = "IF(vec_id % 7 = 0, (label + 1) % 10, label) AS label"
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", label, "embedding", "vec_id % 100 = 0 AS anchor")
    return hard_negatives(rows)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents"), other=tampered_leaf())
    hashes = (f"{proof('path')} AS proof_sha256", f"{folded('path', 'coalesce(other, leaf)')} AS folded_root")
    return found.selectExpr("doc_id", "leaf", "subroot", "root", *hashes).selectExpr("*", "folded_root = root AS verified")


QUERIES = {
    "op1_decontaminate": (op1_decontaminate, sql.OP1),
    "op2_simhash": (op2_simhash, None),
    "op3_suffix_array": (op3_suffix_array, None),
    "op4_training_order": (op4_training_order, None),
    "op5_warc": (op5_warc, sql.OP5),
    "op6_secrets": (op6_secrets, None),
    "op7_language": (op7_language, None),
    "op8_quality": (op8_quality, None),
    "op9_packing": (op9_packing, None),
    "op10_substring": (op10_substring, sql.OP10),
    "op11_caps": (op11_caps, sql.OP11),
    "op12_negatives": (op12_negatives, sql.OP12),
    "op13_manifest": (op13_manifest, sql.OP13),
}
