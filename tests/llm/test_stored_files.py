"""Shards and archives: every record against plain Python, damage, parallel reading; and languages with few texts or long words."""

from __future__ import annotations

import os
import random
import shutil

import numpy as np
import pytest
import zstandard

pytest.importorskip("public_tokenizers")

from ledgerline.llm.language import fit_languages, identify  # noqa: E402
from ledgerline.llm.tokens import encoder  # noqa: E402
from ledgerline.llm.training_order import END, materialise, read_shards  # noqa: E402
from ledgerline.llm.warc import read_archives, roles, write_archives  # noqa: E402

MASK = 2**64 - 1


def slot_of(number, count, key):
    """The keyed permutation for one number, in plain integers."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    low = (1 << half) - 1
    while True:
        left, right = number >> half, number & low
        for turn in range(4):
            mixed = (right + key * 2 + 1 + turn * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & MASK
            mixed = (mixed ^ mixed >> 29) * 0x94D049BB133111EB & MASK
            left, right = right, left ^ ((mixed ^ mixed >> 32) & low)
        number = left << half | right
        if number < count:
            return number


def documents(spark, n=90):
    rnd = random.Random(3)
    words = ["alpha", "it's", "42", "\n\n", "été", "日本", "#!"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 9, 200, 900])))) for k in range(n)] + [(n, None), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), rows


def test_every_record_stands_in_the_slot_of_its_number(spark):
    docs, rows = documents(spark)
    size, key = 32, 7
    stream = [(doc, at, i) for doc, text in rows for at, i in enumerate(encoder().whole.encode(text or "", add_special_tokens=False).ids + [END])]
    cuts = [stream[k : k + size] for k in range(0, len(stream), size)]
    want = sorted((slot_of(k, len(cuts), key), cut[0][0], cut[0][1], len(cut), tuple(i for _, _, i in cut)) for k, cut in enumerate(cuts))
    found = read_shards(materialise(docs, key=key, size=size, shard_sequences=50), size=size)
    assert found.rdd.getNumPartitions() > 1
    got = [(r["slot"], r["doc_id"], r["doc_start"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found.collect()]
    assert sorted(got) == want and len(cuts) > 100


def changed(path, change):
    with open(path, "rb") as source:
        raw = bytearray(source.read())
    with open(path, "wb") as out:
        out.write(change(raw) or raw)


@pytest.mark.parametrize("change", [lambda raw: raw[:-7], lambda raw: raw.__setitem__(0, raw[0] ^ 1), lambda raw: raw[:1]])
def test_damaged_shards_stop_the_read(spark, tmp_path, change):
    docs, _ = documents(spark)
    shards = materialise(docs, key=7, size=32, shard_sequences=50, folder=f"file:{tmp_path}/shards")
    changed(shards.first()["path"].removeprefix("file:"), change)
    with pytest.raises(Exception, match="damaged at record"):
        read_shards(shards, size=32).count()


def pages(spark, n=60):
    rnd = random.Random(4)
    rows = [(k, f"http://host/{k}", "".join(rnd.choice("<p>text ") for _ in range(rnd.choice([0, 50, 900])))) for k in range(n)]
    rows += [(n, "http://host/" + "a" * 200_000, "<p>long address</p>" * 20), (n + 1, None, None), (n + 2, "two\r\nlines", rows[2][2])]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_long_addresses_are_read_back_by_several_tasks(spark):
    frame, rows = pages(spark)
    known = roles(frame)
    written = [write_archives(known.where(f"page_id % 3 = {k}")) for k in range(3)]
    found = read_archives(written[0].unionAll(written[1]).unionAll(written[2]))
    assert found.rdd.getNumPartitions() > 1
    got = {r["page_id"]: r["payload_bytes"] for r in found.collect()}
    assert got == {k: len(html or "") for k, _, html in rows}


def reframed(raw, edit):
    """An archive with its second record edited."""
    size = int.from_bytes(raw[4:8], "little")
    head, dictionary, rest = raw[: 8 + size], bytes(raw[8 : 8 + size]), bytes(raw[8 + size :])
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    held = zstandard.ZstdCompressionDict(dictionary)
    out, number = [], 0
    while rest:
        reader = zstandard.ZstdDecompressor(dict_data=held).decompressobj()
        record, rest = reader.decompress(rest), reader.unused_data
        out.append(zstandard.ZstdCompressor(dict_data=held).compress(edit(record) if number == 1 else record))
        number += 1
    return head + b"".join(out)


DAMAGE = {
    "does not begin with a dictionary frame": lambda raw: b"\x00" * 8 + bytes(raw[8:]),
    "the dictionary frame is cut off": lambda raw: raw[:40],
    "the last frame is cut off": lambda raw: raw[:-9],
    "the length in the header": lambda raw: reframed(raw, lambda r: r[:-4] + b"x\r\n\r\n"),
    "the block has another digest": lambda raw: reframed(raw, lambda r: r[:-5] + bytes([r[-5] ^ 1]) + r[-4:]),
    "is missing": lambda raw: reframed(raw, lambda r: r.replace(b"WARC-Date", b"WARC-Dale", 1)),
    "not a record of this version": lambda raw: reframed(raw, lambda r: b"W" + r),
}


@pytest.mark.parametrize("message", DAMAGE)
def test_damaged_archives_stop_the_read(spark, tmp_path, message):
    frame, _ = pages(spark)
    archives = write_archives(roles(frame), folder=f"file:{tmp_path}/archives")
    assert read_archives(archives).count() == frame.count()
    with open(archives.first()["path"].removeprefix("file:"), "rb") as stored:
        assert stored.read(4) == b"\x5d\x2a\x4d\x18"  # the skippable frame leads, nothing is wrapped around it
    changed(archives.first()["path"].removeprefix("file:"), DAMAGE[message])
    with pytest.raises(Exception, match=message):
        read_archives(archives).count()
    shutil.rmtree(tmp_path / "archives")
    assert not os.path.exists(tmp_path / "archives")


def test_languages_with_few_different_texts_or_without_blanks_are_learned(spark):
    english = ["the house and water of this good day", "people who would often speak about it", "children were playing in the garden", "morning light under the trees"]
    rnd = random.Random(1)
    german = ["das", "haus", "und", "wasser", "dieser", "gute", "tag", "mit", "leuten", "oft", "über", "ihren", "garten"]
    chinese = "我们今天在这里学习中文的时候他说人民生活水平提高了一个国家大学生都有自己的工作"
    rows = [(english[k % 4], "en") for k in range(8000)] + [(" ".join(rnd.choice(german) for _ in range(12)), "de") for _ in range(900)]
    rows += [("".join(rnd.choice(chinese) for _ in range(120)), "zh") for _ in range(50)]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["de", "en", "zh"]
    asked = [("the water in the garden", "en"), ("wasser mit dieser leuten", "de"), ("学习中文的国家" * 30, "zh"), ("大学生", "zh")]
    got = identify(spark.createDataFrame(asked, "text string, lang string"), model).collect()
    assert [r["lang_pred"] for r in got] == [lang for _, lang in asked]
