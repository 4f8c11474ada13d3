"""Dashboard series kept up to date from changes: what a row no longer says is taken back.

A change of a row subtracts what its last version contributed and adds what the new one does. A row's last contribution is
kept in state keyed by buckets of rows, so copies and versions that come late change nothing, and a delete takes everything back. Batches write signed
sums by minute; the series is their total.
"""

from __future__ import annotations

import pickle

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ledgerline.operators.state import DELETE
from ledgerline.session import DEFAULTS, ship_package
from ledgerline.sources.logs import writer_name
from ledgerline.streaming.ingest import FLUSH, start

DELTA = "minute_us bigint, txn_count bigint, cents bigint, failed_count bigint, flagged_count bigint"
_NAMES = [c.split()[0] for c in DELTA.split(", ")]
_CONTRIBUTION = ["id", "ts", "place", "op", "minute_us", "cents", "failed", "flagged"]
BUCKETS = 8192  # keys of the state: rows are dealt to them by a hash of their id
_STORE = "spark.sql.streaming.stateStore.providerClass"


class Retraction(StatefulProcessor):
    """The last contributions of a bucket of rows, each by its place in the order of versions, packed into one value."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        packed = self.last.get()
        last = pickle.loads(packed[0]) if packed else {}
        before: dict = {}  # of the rows that changed, what was last before this batch
        for frame in rows:
            columns = [frame[c].tolist() for c in _CONTRIBUTION]
            for row_id, ts, place, op, *amounts in zip(*columns, strict=True):
                old = last.get(row_id)
                if old is None or (ts, place) > old[:2]:
                    before.setdefault(row_id, old)
                    last[row_id] = (ts, place, op != DELETE, *amounts)
        out = []
        for row_id, old in before.items():
            for entry, sign in ((old, -1), (last[row_id], 1)):
                if entry and entry[2]:
                    out.append((entry[3], sign, sign * entry[4], sign * entry[5], sign * entry[6]))
        if before:
            self.last.update((pickle.dumps(last),))
        if out:
            yield pd.DataFrame(out, columns=_NAMES)

    def close(self) -> None:
        pass


def volume_deltas(versions: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Signed contributions by minute of a stream of typed versions, which need no order (output mode `update`).

    Of versions that tie in time and place, the first to come counts. Versions without a time are left out. A key of the state is one of
    `buckets` groups of rows, a number that has to stay the same under a checkpoint: a call of Python for every row would cost far more than its sums.
    """
    spark = versions.sparkSession
    ship_package(spark)
    if "RocksDB" not in spark.conf.get(_STORE):
        spark.conf.set(_STORE, DEFAULTS[_STORE])
    rows = versions.where("id IS NOT NULL AND created_at IS NOT NULL AND _source_ts_ms IS NOT NULL").selectExpr(
        f"CAST(pmod(xxhash64(id), {buckets}) AS INT) AS bucket",
        "id",
        "_source_ts_ms AS ts",
        "coalesce(_offset, 0L) AS place",
        "cdc_op AS op",
        "unix_micros(date_trunc('minute', created_at)) AS minute_us",
        "CAST(coalesce(amount, 0) * 100 AS BIGINT) AS cents",
        "CAST(coalesce(status = 'failed', false) AS INT) AS failed",
        "CAST(coalesce(status = 'flagged', false) AS INT) AS flagged",
    )
    return rows.groupBy("bucket").transformWithStateInPandas(Retraction(), DELTA, "update", "None")


def start_volume_view(versions: DataFrame, path: str, checkpoint: str, trigger: str | None = FLUSH) -> StreamingQuery:
    """Keep the signed sums of a series under a path; a batch that is run again replaces its own."""
    writer = writer_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("minute_us").agg(*[F.sum(c).alias(c) for c in _NAMES[1:]])
        changed = sums.where(" OR ".join(f"{c} <> 0" for c in _NAMES[1:]))
        (
            changed.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("writer", "batch_id")
            .parquet(path)
        )

    return start(volume_deltas(versions).writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger)


def read_volume_view(spark: SparkSession, path: str) -> DataFrame:
    """The series as :func:`ledgerline.operators.dashboards.volume_per_minute` gives it, from the stored sums."""
    sums = spark.read.schema(DELTA).parquet(path).groupBy("minute_us").agg(*[F.sum(c).alias(c) for c in _NAMES[1:]])
    amount = "CAST(CAST(cents AS DECIMAL(38,0)) / 100 AS DOUBLE) AS total_amount"
    shown = sums.where("txn_count > 0").selectExpr("timestamp_micros(minute_us) AS minute", "txn_count", amount, "failed_count", "flagged_count")
    return shown.orderBy("minute")
