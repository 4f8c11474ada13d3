"""Continuous ingest: messages to the typed version log, with a dead-letter folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.typing import split_readable, type_rows
from ledgerline.schemas import TableSpec
from ledgerline.sources.changes import CORRUPT, MAX_BLOCK_ROWS, MAX_CORRUPT, parse_flat, split_corrupt, unwrap_envelope
from ledgerline.sources.logs import append_versions, writer_name

FLUSH = "500 milliseconds"


class TooManyCorruptRecords(RuntimeError):
    """More broken messages in one batch than are tolerated."""


def start(writer, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Start a stream writer continuously, or once over what is available (`trigger=None`)."""
    ready = writer.option("checkpointLocation", checkpoint)
    ready = ready.trigger(processingTime=trigger) if trigger else ready.trigger(availableNow=True)
    return ready.start()


def stream_ingest(
    records: DataFrame,
    table: TableSpec,
    log_path: str,
    dead_letter_path: str,
    checkpoint: str,
    trigger: str | None = FLUSH,
    enveloped: bool = False,
    max_corrupt: int = MAX_CORRUPT,
    remainder: bool = False,
) -> StreamingQuery:
    """Parse, type and append every batch of messages.

    Broken messages, and rows with an unreadable required time, go to the dead-letter
    folder. A batch with more broken messages than `max_corrupt` in every MAX_BLOCK_ROWS
    begun fails after they were stored, so nothing is lost and nothing goes by
    unnoticed. Two counts are the only values the driver reads. `remainder` keeps the
    undeclared fields of flat messages in the log.
    """
    parsed = unwrap_envelope(records, table) if enveloped else parse_flat(records, table, remainder=remainder)
    writer = writer_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, dead = split_corrupt(batch)
            good, unreadable = split_readable(good, table)
            rows, broken = batch.agg(F.count("*"), F.count(CORRUPT)).first()
            dead = dead.unionByName(unreadable)
            if not dead.isEmpty():
                (
                    dead.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("writer", "batch_id")
                    .parquet(dead_letter_path)
                )
            if broken > max_corrupt * -(-rows // MAX_BLOCK_ROWS):
                raise TooManyCorruptRecords(f"{broken} unreadable {table.name} messages in batch {batch_id}")
            append_versions(type_rows(good, table), log_path, writer, batch_id)
        finally:
            batch.unpersist()

    return start(parsed.writeStream.foreachBatch(write), checkpoint, trigger)


def dedup_replays(versions: DataFrame, key: tuple[str, ...] = ("id",), delay: str = "1 hour") -> DataFrame:
    """Drop re-delivered copies of a version that arrive within `delay` of each other.

    A copy has the key, commit time, operation and content of what came before, perhaps at another offset. Changes that
    one source transaction makes to a row share their commit time but differ in content, and all pass. (One that leads back to the very content of
    an earlier change of the same transaction cannot be told from a copy.) Time is the time of arrival, so no row is ever late: an
    old version that arrives for the first time passes, however far behind it is.
    """
    content = [c for c in versions.columns if not c.startswith("_")]
    timed = versions.withColumns(
        {"_arrived_at": F.current_timestamp(), "_content": F.struct(F.xxhash64(*content), F.xxhash64(F.lit("k"), *content))}
    )
    known = [*key, "_source_ts_ms", *[c for c in ("cdc_op",) if c in versions.columns], "_content"]
    unique = timed.withWatermark("_arrived_at", delay).dropDuplicatesWithinWatermark(known)
    return unique.drop("_arrived_at", "_content")
