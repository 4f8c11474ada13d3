"""Compacted generations of an append-only log, published atomically, and a reader of generation plus tail.

A log grows by one folder a batch (months, `writer`, `batch_id`). A generation holds what all batches up to some point come
to: the newest version of each key, month by month. Its manifest is a small file that names one immutable folder for each month
and, for each writer, the last batch it covers. A new generation rewrites only the months that have new rows and
takes over the folders of all others, so the work follows the news and not the age of the log.

Publishing is the renaming of one file. A reader takes the newest manifest it sees, reads the folders it names and the batches
it does not cover, and so sees either the old or the new generation, with the same state in both. Folders and batches
are removed only when neither the current nor the previous generation needs them, which leaves a reader that began before
a publish the time until the next one.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.timing import Instant, before, month_key
from ledgerline.operators.state import ROWS_PER_FILE, VERSION, latest_versions
from ledgerline.schemas import TableSpec

MONTH = "yyyymm"
MANIFESTS, FOLDERS = "_manifests", "_generations"  # Spark passes over names that begin so
ALL = "all"  # the only part of a log without months


@dataclass(frozen=True)
class Manifest:
    """A generation: its number, the folder of each month, and the last batch covered of each writer."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    covered: dict[str, int] = field(default_factory=dict)


class Log:
    """A log at a path, with or without month folders above those of writer and batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] = ("id",), version: str = VERSION):
        self.spark, self.path, self.key, self.version = spark, path.rstrip("/"), tuple(key), version
        self.months = MONTH in schema.names
        inside = [f for f in schema.fields if f.name not in (MONTH, "writer", "batch_id")]
        month = [T.StructField(MONTH, T.IntegerType())] if self.months else []
        self.schema = T.StructType([*inside, *month, T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())])
        self.jvm = spark.sparkContext._jvm
        self.files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        place = self._path(folder)
        return [s.getPath().getName() for s in self.files.listStatus(place)] if self.files.exists(place) else []

    def _text(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or one by number; without any, generation 0, which is empty."""
        known = [int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in self._names(MANIFESTS)) if m]
        wanted = max(known, default=0) if number is None else number
        return Manifest(**json.loads(self._text(f"{MANIFESTS}/{wanted}.json"))) if wanted in known else Manifest()

    def batches(self) -> list[tuple[str, str, int, str]]:
        """(month, writer, batch, folder) of every batch folder there is."""
        out = []
        for month in [n for n in self._names("") if n.startswith(f"{MONTH}=")] if self.months else [""]:
            for writer in [n for n in self._names(month) if n.startswith("writer=")]:
                place = "/".join(x for x in (month, writer) if x)
                for batch in [n for n in self._names(place) if n.startswith("batch_id=")]:
                    out.append((month.partition("=")[2] or ALL, writer.partition("=")[2], int(batch.partition("=")[2]), f"{place}/{batch}"))
        return out

    def tail(self, manifest: Manifest) -> list[tuple[str, str, int, str]]:
        return [b for b in self.batches() if b[2] > manifest.covered.get(b[1], -1)]

    def read(self, manifest: Manifest | None = None, since_month: int | None = None) -> DataFrame:
        """Stored versions: those of the generation, and of all batches after it. `since_month` leaves older months unopened.

        `latest_state` of the result is the state of the whole log. Versions that a newer one of the same batch range has replaced
        are gone, as a merge leaves them.
        """
        manifest = manifest or self.manifest()
        recent = lambda month: since_month is None or month == ALL or int(month) >= since_month
        held = [folder for month, folder in manifest.parts.items() if recent(month)]
        tail = [folder for month, _, _, folder in self.tail(manifest) if recent(month)]
        rows = self.spark.createDataFrame([], self.schema)
        for base, folders in ((FOLDERS, held), ("", tail)):
            if folders:
                # the folders of a generation lie under one number each: the month is a column of the files there
                rows = rows.unionByName(self._opened(base, folders))
        return rows

    def _opened(self, base: str, folders: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        if not base:
            reader = reader.option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders])

    def since(self, as_of: Instant, seconds: int) -> DataFrame:
        """The versions that can matter to rows created in the trailing window, from the months in question alone."""
        start = before(as_of, seconds)
        month = self.spark.range(1).select(month_key(start)).first()[0]
        return self.read(since_month=month).where(F.col("created_at") >= start)

    def publish(self, complete: dict[str, int] | None = None, rows_per_file: int = ROWS_PER_FILE) -> Manifest | None:
        """Make the next generation of all complete batches and publish it; None if there is nothing new, or another publisher was first.

        `complete` names the last batch known to be stored, by writer. Of other writers the last batch seen may
        still be in writing, so the one before it counts.
        """
        old = self.manifest()
        seen: dict[str, list[int]] = {}
        fresh = self.tail(old)
        for _, writer, batch, _ in fresh:
            seen.setdefault(writer, []).append(batch)
        known = complete or {}
        until = {w: known.get(w, max(found) - 1) for w, found in seen.items()}
        new = [b for b in fresh if b[2] <= until[b[1]]]
        if not new:
            return None
        number, folder = old.number + 1, f"{FOLDERS}/{old.number + 1}-{uuid.uuid4().hex[:8]}"
        months = sorted({month for month, *_ in new})
        held = [old.parts[m] for m in months if m in old.parts]
        rows = self._opened("", [f for *_, f in new])
        rows = rows.unionByName(self._opened(FOLDERS, held)) if held else rows
        part = F.col(MONTH).cast("string") if self.months else F.lit(ALL)
        keys = ((MONTH,) if self.months else ()) + self.key
        newest = latest_versions(rows, keys, self.version).withColumn("_part", part)
        # one number a month: how many files its versions fill
        sizes = rows.groupBy(part.alias("_of")).agg(F.expr(f"CAST(ceil(count(*) / {rows_per_file}) AS INT) AS _files"))
        spread = newest.join(sizes, F.col("_part") == F.col("_of")).withColumn("_file", F.pmod(F.xxhash64(*self.key), F.col("_files")))
        order = [c for c in ("account_id", "created_at", "id") if c in self.schema.names]
        # adaptive execution parts what is still too large for one task to sort
        stored = spread.hint("rebalance", "_part", "_file").drop("_of", "_files", "_file").sortWithinPartitions("_part", *order)
        stored.write.partitionBy("_part").option("parquet.bloom.filter.enabled#id", "true").parquet(f"{self.path}/{folder}")
        parts = {**old.parts, **{m: f"{folder}/_part={m}" for m in months}}
        made = Manifest(number, parts, {**old.covered, **until})
        if not self._claim(made):
            self.files.delete(self._path(folder), True)
            return None
        self.vacuum(old, made)
        return made

    def _claim(self, manifest: Manifest) -> bool:
        """Put a manifest in its place, unless one of its number is there already."""
        temporary = f"{MANIFESTS}/_{uuid.uuid4().hex}"
        stream = self.files.create(self._path(temporary))
        stream.write(bytearray(json.dumps(manifest.__dict__, sort_keys=True).encode()))
        stream.close()
        target = self._path(f"{MANIFESTS}/{manifest.number}.json")
        try:
            done = not self.files.exists(target) and self.files.rename(self._path(temporary), target)
        except Py4JJavaError:
            done = False
        if not done:
            self.files.delete(self._path(temporary), False)
        return done

    def vacuum(self, previous: Manifest, current: Manifest) -> int:
        """Remove what neither of two generations needs: batches the previous one covers, folders neither names, older manifests."""
        gone = [f for _, w, b, f in self.batches() if b <= previous.covered.get(w, -1)]
        used = {f.split("/_part=")[0]: 0 for m in (previous, current) for f in m.parts.values()}
        named = {f for m in (previous, current) for f in m.parts.values()}
        for folder in self._names(FOLDERS):
            place = f"{FOLDERS}/{folder}"
            if place in used:
                gone += [f"{place}/{p}" for p in self._names(place) if p.startswith("_part=") and f"{place}/{p}" not in named]
            elif int(folder.split("-")[0]) < previous.number:
                gone.append(place)
        gone += [f"{MANIFESTS}/{n}" for n in self._names(MANIFESTS) if n.endswith(".json") and int(n[:-5]) < previous.number]
        for name in gone:
            self.files.delete(self._path(name), True)
        return len(gone)


def version_log(spark: SparkSession, path: str, table: TableSpec) -> Log:
    """The version log of a table, as :func:`ledgerline.sources.logs.append_versions` writes it."""
    return Log(spark, path, table.state_schema().add(MONTH, T.IntegerType()), table.key)
