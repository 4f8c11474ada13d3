"""Secret scans: recall for each way to write a random string, and texts with very many matches."""

from __future__ import annotations

import random
import time

import pytest

pytest.importorskip("public_tokenizers")

from ledgerline.llm.secrets import SIGNS, find_secrets, fit_ratios, labelled_samples  # noqa: E402

ALPHABETS = {"hex": SIGNS[52:62] + "abcdef", "HEX": SIGNS[52:62] + "ABCDEF", "upper": SIGNS[:26] + SIGNS[52:62], "lower": SIGNS[26:62], "mixed": SIGNS[:62], "base64": SIGNS[:64]}
NAMES = (
    "AbstractSingletonProxyFactoryBean customer_account_number internationalization orderLineItemQuantity counterrevolutionaries "
    "getElementsByTagNameNS MAX_CONNECTIONS_PER_HOST_LIMIT organization-level-permissions INTERNAL_SERVER_ERROR_MESSAGE "
    "test_that_all_rows_are_returned path/to/some/deeply/nested/file XMLHttpRequestEventTarget"
).split()


@pytest.fixture(scope="module")
def ratios(spark):
    prose = ["the house and water of this good day with people who would often speak " * 5, "das haus und wasser dieser gute tag mit leuten"]
    return fit_ratios(labelled_samples(spark.createDataFrame([(t,) for t in prose], "text string")))


@pytest.mark.parametrize("kind", ALPHABETS)
def test_random_strings_of_every_alphabet_are_found(spark, ratios, kind):
    rnd = random.Random(kind)
    keys = ["".join(rnd.choice(ALPHABETS[kind]) for _ in range(size)) for size in (20, 22, 23) for _ in range(200)]
    docs = spark.createDataFrame([(k, f"id {key}") for k, key in enumerate(keys)], "doc_id long, text string")
    found = find_secrets(docs, ratios).selectExpr("doc_id", "size(secrets) AS n").collect()
    assert sum(r["n"] > 0 for r in found) >= 0.9 * len(keys)


def test_ordinary_names_are_left_alone(spark, ratios):
    docs = spark.createDataFrame([(k, f"see {name} there") for k, name in enumerate(NAMES)], "doc_id long, text string")
    assert [NAMES[r["doc_id"]] for r in find_secrets(docs, ratios).where("size(secrets) > 0").collect()] == []


def test_very_many_matches_in_one_text(spark, ratios):
    rnd = random.Random(4)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(24)) for _ in range(16_000)]
    docs = spark.createDataFrame([(1, " ".join(hexes)), (2, " ".join(f"{h} a_long_but_ordinary_name{'' if k % 3 else '=x'}" for k, h in enumerate(hexes)))], "doc_id long, text string")
    find_secrets(docs.limit(0), ratios).collect()
    begun = time.time()
    got = {r["doc_id"]: r["secrets"] for r in find_secrets(docs, ratios).collect()}
    assert time.time() - begun < 15
    assert [(s["start"], s["end"]) for s in got[1]] == [(25 * k, 25 * k + 24) for k in range(16_000)]
    assert len(got[2]) == 16_000


def test_input_columns_are_given_back(spark, ratios):
    docs = spark.createDataFrame([(1, "a", "b", None)], "doc_id long, _base string, _tokens string, text string")
    assert find_secrets(docs, ratios).columns == ["doc_id", "_base", "_tokens", "text", "secrets"]
    assert find_secrets(docs, ratios).drop("secrets").collect() == docs.collect()
