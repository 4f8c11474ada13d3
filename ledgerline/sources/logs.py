"""Append-only version log and alert log on parquet.

Each micro-batch writes its own partition folders (`writer`, `batch_id`), so a
batch that is run again after a failure replaces its own files and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ledgerline.functions.timing import Instant, before, month_key
from ledgerline.schemas import TableSpec

LOG_LAYOUT = ("yyyymm", "writer", "batch_id")


def writer_name(checkpoint: str) -> str:
    """Stable name of the query owning a checkpoint.

    A query started on a fresh checkpoint counts its batches from 0 again; the
    name keeps those apart from the batches an earlier query wrote.
    """
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def append_versions(rows: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Write typed versions under their creation month, stamped with the ingest time.

    A task sorts what it writes. Where adaptive execution is on, which it is not inside a stream, rows are dealt anew to tasks of its advisory
    size first, as a large part of a compressed file may be far larger in memory.
    """
    columns = sort_columns(rows)
    if columns and rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", *columns)
    (
        rows.withColumn("_ingested_at", F.current_timestamp())
        .withColumn("yyyymm", month_key("created_at"))
        .withColumn("writer", F.lit(writer))
        .withColumn("batch_id", F.lit(batch_id))
        .sortWithinPartitions("yyyymm", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOG_LAYOUT)
        .parquet(path)
    )


def sort_columns(rows: DataFrame) -> list[str]:
    """Row order inside files, so that row-group statistics can skip by account and time."""
    return [c for c in ("account_id", "created_at", "id") if c in rows.columns]


def version_log_sink(
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    table: TableSpec | None = None,
    publish_every: int | None = None,
):
    """`foreachBatch` function that appends a batch of typed rows to the version log.

    With `publish_every`, every so many batches of a `table` a generation is published, so that readers open no more files after
    a year than after a day (:mod:`ledgerline.sources.generations`).
    """
    from ledgerline.sources.generations import version_log

    writer = writer_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_versions(prepare(batch) if prepare else batch, path, writer, batch_id)
        if publish_every and (batch_id + 1) % publish_every == 0:
            version_log(batch.sparkSession, path, table).publish({writer: batch_id})

    return write


def read_log(spark: SparkSession, path: str, table: TableSpec, remainder: bool = False) -> DataFrame:
    """The typed version log; an absent or still empty log reads as no rows. `remainder` adds the variant of undeclared fields."""
    stored = table.state_schema()
    stored = stored.add("_rest", T.VariantType()) if remainder else stored
    schema = stored.add("yyyymm", T.IntegerType()).add("writer", T.StringType()).add("batch_id", T.LongType())
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def log_since(log: DataFrame, as_of: Instant, seconds: int) -> DataFrame:
    """The part of the log that can matter to rows created in the trailing window.

    Safe before deduplication: `created_at` never changes for a row, and a delete
    marker without it carries its own later commit time, so every version of a
    row in the window passes. `created_at >= x` alone does not prune month
    folders, hence the second condition.
    """
    start = before(as_of, seconds)
    return log.where((F.col("yyyymm") >= month_key(start)) & (F.col("created_at") >= start))


def alert_sink(alerts: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Append new cases to the alert log; the same (writer, batch) replaces itself, rule by rule."""
    (
        alerts.withColumn("yyyymm", month_key("created_at"))
        .withColumn("writer", F.concat(F.lit(f"{writer}-"), "rule_code"))
        .withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOG_LAYOUT)
        .parquet(path)
    )
