"""Change messages: reading a topic, parsing, unwrapping, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import TOPIC_RECORD, TableSpec

CORRUPT = "_corrupt_record"
REST = "_rest"  # what a message holds beyond the declared columns
EMPTY = "(empty message)"
# ---- fixed values: broken messages tolerated in so many messages ----
MAX_CORRUPT = 10
MAX_BLOCK_ROWS = 65_536
# ---------------------------------------------------------------------
POSITION = ("partition", "offset")


def cdc_source(
    spark: SparkSession,
    table: TableSpec,
    location: str,
    fmt: str = "kafka",
    topic_prefix: str = "public",
    options: dict[str, str] | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """One topic as a stream of (topic, partition, offset, timestamp, key, value).

    `location` is the broker list for Kafka, or a folder of files: `records` are
    JSON lines of whole topic records, with their offsets; any other format is
    text lines of message values alone. Those have no place in a topic; a hash of
    the line stands in for the offset, so that equal versions at least always
    resolve the same way. All start from the earliest record on the first run and
    continue from the checkpoint afterwards. `max_offsets` bounds a Kafka batch.
    """
    opts = options or {}
    topic = f"{topic_prefix}.{table.name}"
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .options(**({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {}))
            .options(**opts)
            .load()
        )
        return raw.select(
            "topic",
            "partition",
            "offset",
            "timestamp",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
    if fmt == "records":
        return spark.readStream.schema(TOPIC_RECORD).options(**opts).json(location)
    lines = spark.readStream.format("text").options(**opts).load(location)
    return lines.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("value").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.when(F.col("value") != "", F.col("value")).alias("value"),
    )


def parse_flat(records: DataFrame, table: TableSpec, value: str = "value", remainder: bool = False) -> DataFrame:
    """Flat change messages as declared columns; undeclared JSON fields are ignored.

    Adds `_corrupt_record` (the text of a message that is not valid JSON) and
    `_partition` and `_offset` where the records have them. With `remainder` the undeclared fields are
    kept in a VARIANT column `_rest`, which is null where there are none;
    :func:`ledgerline.operators.typing.promote` makes columns of them once a schema declares them.
    """
    schema = table.wire_schema().add(CORRUPT, T.StringType())
    return exploded(records, schema, value, [undeclared(table, value)] if remainder else [])


def undeclared(table: TableSpec, value: str) -> Column:
    """The fields of a JSON text that a table does not declare, as one variant object."""
    names = ", ".join(f"'{c}'" for c in table.wire_schema().names)
    fields = f"try_cast(try_parse_json({value}) AS MAP<STRING, VARIANT>)"
    others = f"map_filter({fields}, (name, x) -> NOT array_contains(array({names}), name))"
    return F.expr(f"transform(array({others}), m -> IF(size(m) > 0, to_variant_object(m), NULL))[0]").alias(REST)


def exploded(records: DataFrame, schema: T.StructType, value: str, more: Sequence[Column] = ()) -> DataFrame:
    """The fields of each JSON value as columns; records without a value are dropped.

    `inline` parses every message once: a later filter on a field stays above it,
    where through a plain projection it would be pushed down and parse again.
    """
    # an empty text would parse to a row of NULLs; it is a broken message like any other
    text = F.when(F.trim(value) == "", F.lit(EMPTY)).otherwise(F.col(value))
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keep = [F.col(c).alias(f"_{c}") for c in POSITION if c in records.columns]
    return records.select(*keep, *more, F.inline(F.when(F.col(value).isNotNull(), F.array(parsed))))


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, dead letters): the broken messages are kept, not lost."""
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    dead = parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, dead


def drop_unknown_fields(records: DataFrame, table: TableSpec) -> DataFrame:
    """Readable rows restricted to the declared columns, whatever else a message holds."""
    good, _ = split_corrupt(parse_flat(records, table))
    return good


def unwrap_envelope(records: DataFrame, table: TableSpec, value: str = "value") -> DataFrame:
    """Change envelopes as flat rows, in the layout of :func:`parse_flat`.

    The after-image is taken, or for a delete the before-image marked as deleted;
    null values (log tombstones) are dropped. The envelope may or may not sit
    under a `payload` field.
    """
    image = table.row_schema()
    body = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField(
                "source",
                T.StructType([T.StructField("table", T.StringType()), T.StructField("ts_ms", T.LongType())]),
            ),
            T.StructField("op", T.StringType()),
        ]
    )
    schema = T.StructType([*body.fields, T.StructField("payload", body), T.StructField(CORRUPT, T.StringType())])
    rows = exploded(records, schema, value)
    keep = [f"_{c}" for c in POSITION if f"_{c}" in rows.columns]

    def pick(name: str) -> Column:
        return F.coalesce(F.col(f"payload.{name}"), F.col(name))

    flat = rows.select(
        pick("op").alias("__op"),
        pick("source.table").alias("__table"),
        pick("source.ts_ms").alias("__source_ts_ms"),
        F.when(pick("op") == "d", pick("before")).otherwise(pick("after")).alias("row"),
        CORRUPT,
        *keep,
    )
    return flat.select(
        "row.*",
        F.when(F.col("__op") == "d", "true").otherwise("false").alias("__deleted"),
        "__op",
        "__table",
        "__source_ts_ms",
        CORRUPT,
        *keep,
    )


def snapshot_as_log(snapshot: DataFrame, log: DataFrame, snapshot_ts_ms: int | Column) -> DataFrame:
    """Existing rows as versions with operation `r`, followed by the changes."""
    version = snapshot_ts_ms if isinstance(snapshot_ts_ms, Column) else F.lit(snapshot_ts_ms)
    first = snapshot.withColumn("cdc_op", F.lit("r")).withColumn("_source_ts_ms", version.cast("bigint"))
    return first.unionByName(log, allowMissingColumns=True)
