"""Generations of a log: the same state before, during and after a publish, and no more files with age."""

from __future__ import annotations

import random

from helpers import same

from ledgerline.operators.state import latest_state
from ledgerline.schemas import TRANSACTIONS
from ledgerline.sources.generations import Manifest, version_log
from ledgerline.sources.logs import append_versions, read_log
from ledgerline.streaming.ingest import start
from ledgerline.streaming.state import read_state_table, start_state_table, state_log

ROW = "id string, account_id string, amount string, at string, cdc_op string, _source_ts_ms long, _offset long"
SHOWN = ("id", "account_id", "amount", "cdc_op", "_source_ts_ms", "_offset")


def batch(spark, rng, number):
    rows = []
    for k in range(12):
        tid = rng.randrange(40)
        rows.append((f"t{tid}", f"a{tid % 5}", f"{number}.{k:02d}", f"2024-0{tid % 4 + 1}-15", rng.choice("cuuud"), number // 3, number * 100 + k))
    return spark.createDataFrame(rows, ROW).selectExpr(
        "id", "account_id", "CAST(amount AS DECIMAL(18,2)) AS amount", "CAST(at AS TIMESTAMP) AS created_at", "cdc_op", "_source_ts_ms", "_offset"
    ).coalesce(1)


def state(rows):
    return latest_state(rows).select(*SHOWN)


def test_state_stays_the_same_over_publishes_and_files_do_not_grow(spark, tmp_path):
    rng = random.Random(1)
    path, whole = str(tmp_path / "log"), str(tmp_path / "whole")
    log, opened, readers = version_log(spark, path, TRANSACTIONS), {}, []
    for number in range(24):
        rows = batch(spark, rng, number)
        for target in (path, whole):
            append_versions(rows, target, "w", number)
        if number % 6 == 5:
            want = state(read_log(spark, whole, TRANSACTIONS))
            before, manifest = log.read(), log.manifest()
            assert same(state(before), want)
            readers.append((before, want))
            made = log.publish({"w": number})
            assert made.number == number // 6 + 1 and made.covered == {"w": number}
            assert same(state(log.read()), want)  # after
            assert same(state(before), want)  # begun before, read after: its files are still there
            assert same(state(log.read(manifest)), want)
            opened[number] = len(log.read().inputFiles())
            assert log.publish({"w": number}) is None  # nothing new
    assert len(set(opened.values())) == 1
    assert len({b for _, _, b, _ in log.batches()}) <= 6  # older batches are gone
    append_versions(batch(spark, random.Random(1), 0), path, "w", 0)  # a covered batch that is written once more
    assert same(state(log.read()), state(read_log(spark, whole, TRANSACTIONS)))


def test_only_months_with_news_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "log")
    log = version_log(spark, path, TRANSACTIONS)
    rows = batch(spark, random.Random(3), 0)
    append_versions(rows, path, "w", 0)
    first = log.publish({"w": 0})
    append_versions(rows.where("created_at >= '2024-03-01' AND created_at < '2024-04-01'"), path, "w", 1)
    second = log.publish({"w": 1})
    assert {m for m in first.parts if first.parts[m] != second.parts[m]} == {"202403"}
    assert {int(m) for m in first.parts} >= {202401, 202403}
    seen = log.since("2024-04-20 00:00:00", 86_400 * 30)
    assert all("_part=202401" not in f and "_part=202402" not in f for f in seen.inputFiles())
    assert same(seen.select(*SHOWN), log.read().where("created_at >= '2024-03-21'").select(*SHOWN))


def test_one_of_two_publishers_wins_and_an_unfinished_batch_waits(spark, tmp_path):
    path = str(tmp_path / "log")
    log = version_log(spark, path, TRANSACTIONS)
    assert log.read().isEmpty() and log.manifest() == Manifest() and log.publish() is None
    for number in range(3):
        append_versions(batch(spark, random.Random(number), number), path, "w", number)
    append_versions(batch(spark, random.Random(9), 9), path, "other", 0)
    made = log.publish()  # nobody says which batches are complete: the last of each writer may not be
    assert made.covered == {"w": 1, "other": -1}
    assert not log._claim(Manifest(1, {}, {})) and log.manifest() == made
    assert same(state(log.read()), state(read_log(spark, path, TRANSACTIONS)))


def test_state_table_with_generations(spark, tmp_path):
    schema = "id string, amount int, cdc_op string, _source_ts_ms bigint"
    rng = random.Random(5)
    rows = [(rng.choice("abcdefgh"), rng.randrange(99), rng.choice("cuud"), k) for k in range(60)]
    for k in range(0, 60, 10):
        spark.createDataFrame(rows[k : k + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "versions"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "versions"))
    path = str(tmp_path / "state")
    start_state_table(stream, path, str(tmp_path / "c"), trigger=None, publish_every=2).awaitTermination()
    log = state_log(spark, path, spark.createDataFrame([], schema).schema)
    assert log.manifest().number == 3
    newest = {}
    for tid, amount, op, ts in rows:
        newest[tid] = (tid, amount, op)
    got = {r["id"]: r["amount"] for r in read_state_table(log.read()).collect()}
    assert got == {tid: amount for tid, amount, op in newest.values() if op != "d"}


def test_a_batch_and_a_generation_are_sorted_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "concat('t', id) AS id", "concat('a', id % 900) AS account_id", "CAST(id AS DECIMAL(18,2)) AS amount", "md5(CAST(id AS STRING)) AS description",
        "timestamp_seconds(1704067200 + id) AS created_at", "'c' AS cdc_op", "id AS _source_ts_ms", "id AS _offset",
    )
    path, name = str(tmp_path / "log"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    log, usual = version_log(spark, path, TRANSACTIONS), spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        append_versions(rows.coalesce(1), path, "w", 0)
        batch_files = log.read().inputFiles()
        assert log.publish({"w": 0}).covered == {"w": 0}
        for files in (batch_files, log.read().inputFiles()):
            assert len(files) > 1
            assert max(spark.read.parquet(f).count() for f in files) < 36_000
    finally:
        spark.conf.set(name, usual)
    assert same(log.read().select(*rows.columns), rows)
