"""Current state maintained continuously."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.state import VERSION, latest_state
from ledgerline.sources.generations import Log
from ledgerline.sources.logs import writer_name
from ledgerline.streaming.ingest import FLUSH, start


def latest_state_stream(versions: DataFrame, key: Sequence[str] = ("id",), version: str = VERSION) -> DataFrame:
    """Newest version per key as a streaming aggregate (use output mode `update`).

    One state entry per key, partitioned by key over the state store and never
    evicted, as a table's rows are not. Copies and late older versions change
    nothing. Delete markers are kept, so that readers can drop the row.
    """
    ties = [c for c in ("_offset",) if c in versions.columns]
    others = [c for c in versions.columns if c not in key]
    content = [c for c in others if not c.startswith("_")]
    order = F.struct(version, *ties, F.xxhash64(*key, *content))
    newest = versions.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("row"))
    return newest.select(*key, "row.*")


def start_state_table(
    versions: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str] = ("id",),
    version: str = VERSION,
    trigger: str | None = FLUSH,
    publish_every: int | None = None,
) -> StreamingQuery:
    """Keep a folder of changed rows; each batch writes (or rewrites) its own part.

    With `publish_every`, every so many batches the changes so far become a generation with a row for each key.
    """
    writer = writer_name(checkpoint)
    table = state_log(versions.sparkSession, path, versions.schema, key, version)

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("writer", "batch_id")
            .parquet(path)
        )
        if publish_every and (batch_id + 1) % publish_every == 0:
            table.publish({writer: batch_id})

    changed = latest_state_stream(versions, key, version)
    return start(changed.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger)


def state_log(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] = ("id",), version: str = VERSION) -> Log:
    """The folder of a state table, whose generations and tail `read()` gives as changes."""
    return Log(spark, path, schema, key, version)


def read_state_table(changes: DataFrame, key: Sequence[str] = ("id",), version: str = VERSION) -> DataFrame:
    """Current rows of a state folder: the last change of each key, without deletes."""
    return latest_state(changes, key, version).drop("writer", "batch_id")
