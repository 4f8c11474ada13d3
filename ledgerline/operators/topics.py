"""Views of a message topic: newest records, retained counts, consumer lag."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# ---- fixed values: page size of the topic view ----
TAIL_DEFAULT, TAIL_MAX = 50, 500
# ---------------------------------------------------


def topic_tail(records: DataFrame, limit: int = TAIL_DEFAULT) -> DataFrame:
    """The newest `limit` records: the tail of each partition, then the newest overall.

    `value_json` is the value where it is valid JSON; otherwise `value` is shown
    as it is. Every map task passes on at most `limit` records per partition.
    """
    if not 1 <= int(limit) <= TAIL_MAX:
        raise ValueError(f"limit must be 1 to {TAIL_MAX}")
    n = int(limit)
    w = W.partitionBy("topic", "partition").orderBy(F.desc("offset"))
    tails = records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    newest = tails.orderBy(F.desc("timestamp"), F.desc("offset"), "partition").limit(n)
    return newest.select(
        "partition",
        "offset",
        "timestamp",
        "key",
        "value",
        F.get_json_object("value", "$").alias("value_json"),
    )


def topic_stats(records: DataFrame) -> DataFrame:
    """Partitions and retained records (newest - oldest offset + 1, summed) per topic."""
    per_partition = records.groupBy("topic", "partition").agg(
        (F.max("offset") - F.min("offset") + 1).alias("retained")
    )
    return per_partition.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partition_count"), F.sum("retained").alias("message_count")
    )


def log_ends(records: DataFrame) -> DataFrame:
    """Next offset to be written, per topic and partition."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("log_end"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: committed offset, log end, lag; a missing commit reads as 0 with a hint.

    `committed` has (topic, partition, offset), where -1 means none yet.
    """
    done = committed.select("topic", "partition", F.col("offset").alias("committed"))
    current = F.when(F.coalesce("committed", F.lit(-1)) < 0, F.lit(0)).otherwise(F.col("committed"))
    return (
        ends.join(done, ["topic", "partition"], "left")
        .withColumn("current", current.cast("bigint"))
        .select(
            "topic",
            "partition",
            "current",
            "log_end",
            (F.col("log_end") - F.col("current")).alias("lag"),
            F.when(F.col("committed").isNull(), F.lit("no committed offsets")).alias("hint"),
        )
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.groupBy("topic").agg(F.sum("lag").alias("total_lag"))


def committed_offsets(spark: SparkSession, progress: dict) -> DataFrame:
    """(topic, partition, offset) a streaming query has read, from its last progress report.

    The report holds one number per topic partition.
    """
    rows = []
    for source in progress.get("sources", []):
        reached = source.get("endOffset") or {}
        reached = json.loads(reached) if isinstance(reached, str) else reached
        for topic, partitions in reached.items():
            rows += [(topic, int(number), int(offset)) for number, offset in partitions.items()]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint")
