"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the operators rely on. Adaptive execution sizes the reducers, turns a
# join into a broadcast only when the measured size allows it, and splits skewed
# join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # recording the Python line of every column expression doubles the time to build a plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "ledgerline", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the settings above; `extra` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only where that is unset and the session is local (tests) is a fresh
    folder made; a cluster without the setting is an error, because a
    machine-local folder would not be seen by the other machines.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerline-")
    context.setCheckpointDir(folder)
    return folder


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of intermediate results, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed before a job whose tasks run functions of the package (only the ledger);
    the executors need nothing installed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-package-"), "ledgerline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
