"""Current state from a version log, and the counts used to reconcile both.

The newest version per key is taken with `row_number() = 1`. Spark keeps only
the best row per key of every map task before the exchange, so a key with very
many versions does not gather in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.schemas import TableSpec

VERSION = "_source_ts_ms"
DELETE = "d"
ROWS_PER_FILE = 5_000_000


def version_order(log: DataFrame, version: str = VERSION, tie: Sequence[str] | None = None) -> list[Column]:
    """Columns whose order decides which version is newest, without ambiguity.

    Version first, then the position in the topic. A log without positions resolves
    equal versions by a hash of the row, which has to read every column. With
    `tie` given, those columns take the place of both.
    """
    if tie is not None:
        return [F.col(version), *map(F.col, tie)]
    if "_offset" in log.columns:
        return [F.col(version), *[F.col(c) for c in ("_offset", "_partition") if c in log.columns]]
    content = [c for c in log.columns if not c.startswith("_") and c not in ("yyyymm", "writer", "batch_id")]
    return [F.col(version), F.xxhash64(*content)]


def latest_versions(
    log: DataFrame,
    key: Sequence[str] = ("id",),
    version: str = VERSION,
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version per key, delete markers included."""
    w = W.partitionBy(*key).orderBy(*[c.desc_nulls_last() for c in version_order(log, version, tie)])
    return log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_state(
    log: DataFrame,
    key: Sequence[str] = ("id",),
    version: str = VERSION,
    keep_deleted: bool = False,
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """Current rows: newest version per key, without the deleted ones.

    Deletes are removed after the choice; removing them earlier would bring a
    deleted row back in its previous version.
    """
    newest = latest_versions(log, key, version, tie)
    return newest if keep_deleted else newest.where(F.col("cdc_op") != DELETE)


def deleted_rows(
    log: DataFrame, key: Sequence[str] = ("id",), version: str = VERSION, tie: Sequence[str] | None = None
) -> DataFrame:
    """Keys whose newest version is a delete marker."""
    return latest_versions(log, key, version, tie).where(F.col("cdc_op") == DELETE)


def row_versions(log: DataFrame, condition: Column, version: str = VERSION) -> DataFrame:
    """Every stored version of the selected rows in version order."""
    return log.where(condition).orderBy(*version_order(log, version))


def multi_version_ids(log: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """One row: how many keys have several stored versions, and how many keys there are."""
    per_key = log.groupBy(*key).agg(F.count(F.lit(1)).alias("versions"))
    return per_key.agg(
        F.count_if(F.col("versions") > 1).alias("multi_version_keys"),
        F.count(F.lit(1)).alias("total_keys"),
    )


def raw_vs_final_counts(
    log: DataFrame, key: Sequence[str] = ("id",), version: str = VERSION, tie: Sequence[str] | None = None
) -> DataFrame:
    """One row: stored versions and current rows, from one aggregate over the log.

    Per key it needs only the number of versions and the operation of the newest,
    so nothing but a few small values per key and map task is exchanged.
    """
    newest = F.max_by("cdc_op", F.struct(*version_order(log, version, tie)))
    per_key = log.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), newest.alias("op"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.count_if(F.col("op") != DELETE).alias("final_rows"),
    )


def counted(rows: DataFrame, table: str, column: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(column)).select(F.lit(table).alias("table_name"), column)


def reconcile_counts(sources: dict[str, DataFrame], states: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows at the source, rows in the current state, and whether they agree.

    Restrict both sides first (for instance to the rows of one test run) for the
    zero-loss form of the check.
    """
    left = right = None
    for name, rows in sources.items():
        part = counted(rows, name, "source_rows")
        left = part if left is None else left.unionByName(part)
    for name, rows in states.items():
        part = counted(rows, name, "state_rows")
        right = part if right is None else right.unionByName(part)
    both = left.join(right, "table_name", "full")
    return both.select(
        "table_name",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("state_rows", F.lit(0)).alias("state_rows"),
        F.coalesce(F.col("source_rows") == F.col("state_rows"), F.lit(False)).alias("matches"),
    )


def arrived_count(
    state: DataFrame, condition: Column | None = None, accounts: DataFrame | None = None, since: Column | None = None
) -> DataFrame:
    """One row: current rows that satisfy the condition, belong to the account set, and
    how many of them were ingested after `since`."""
    rows = state if condition is None else state.where(condition)
    recent = F.count_if(F.col("_ingested_at") > since) if since is not None else F.count(F.lit(1))
    if accounts is None:
        return rows.agg(F.count(F.lit(1)).alias("arrived"), recent.alias("arrived_recently"))
    # one row per account before the join, so a busy account does not load one task
    per_account = rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"), recent.alias("r"))
    kept = per_account.join(accounts.select("account_id").distinct(), "account_id", "left_semi")
    return kept.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("arrived"), F.coalesce(F.sum("r"), F.lit(0)).alias("arrived_recently")
    )


def distinct_types(state: DataFrame) -> DataFrame:
    return state.select("type").distinct()


def compact_log(log: DataFrame, before_month: int, key: Sequence[str] = ("id",), version: str = VERSION) -> DataFrame:
    """Closed months reduced to their newest version per key (delete markers stay); open
    months as they are. `latest_state` of the result equals that of the log."""
    closed = latest_versions(log.where(F.col("yyyymm") < before_month), ["yyyymm", *key], version)
    return closed.unionByName(log.where(F.col("yyyymm") >= before_month))


def rewrite_compacted(log: DataFrame, path: str, before_month: int, table: TableSpec, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the compacted log as a new generation beside the old one.

    Readers are switched to the new folder once it is complete. A month is spread by key
    over tasks of about `rows_per_file` stored versions.
    """
    compacted = compact_log(log, before_month, table.key)
    # one row for each month
    sizes = log.groupBy("yyyymm").agg(F.expr(f"CAST(ceil(count(*) / {rows_per_file}) AS BIGINT)").alias("_files"))
    (
        compacted.join(F.broadcast(sizes), "yyyymm", "left")
        .withColumn("_part", F.pmod(F.xxhash64(*table.key), F.coalesce("_files", F.lit(1))))
        .drop("_files")
        .hint("rebalance", "yyyymm", "_part")  # adaptive execution parts what is still too large for one task
        .drop("_part")
        .sortWithinPartitions("yyyymm", *[c for c in ("account_id", "created_at", "id") if c in log.columns])
        .write.mode("overwrite")
        .partitionBy("yyyymm")
        .parquet(path)
    )


def table_freshness(log: DataFrame) -> DataFrame:
    """One row: stored versions and the newest ingest time."""
    return log.agg(F.count(F.lit(1)).alias("rows"), F.max("_ingested_at").alias("last_ingested_at"))
