"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at any scale; size-dependent ones (memory, shuffle
# partitions) stay with the cluster or the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs a round trip to the JVM for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Scratch tables by application, for clear_scratch.
_scratch: dict[str, list[str]] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "plumbline", master: str | None = None, **conf: object) -> SparkSession:
    """Return a session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python finds it.

    Operators that run Python in tasks call it. Spark serves the archive from the driver
    and copies it to every executor; no executor reads the driver's folder.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="plumbline-ship-")) / "plumbline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path("plumbline") / file.relative_to(package))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or else the context's checkpoint directory.

    A local master, whose driver and executors are one machine, gets a temporary folder
    where both are unset; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def enable_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table that is written and read back."""
    path = f"{shared_folder(spark).rstrip('/')}/plumbline/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Collects the scratch tables made within, for :func:`drop_scratch` once what reads them is written."""
    made: list[str] = []
    known = set(_scratch.get(spark.sparkContext.applicationId, ()))
    try:
        yield made
    finally:
        made += [path for path in _scratch.get(spark.sparkContext.applicationId, ()) if path not in known]


def drop_scratch(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete these scratch tables; no frame that reads one may be run again."""
    registered = _scratch.get(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
        if path in registered:
            registered.remove(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more.

    It does so when the driver collects garbage, which a large heap may put off until the
    executors' disks are full. Call it after a table is settled that took a large shuffle.
    """
    gc.collect()
    spark._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> int:
    """Delete all scratch tables of this application; call it once results are written. Returns their number."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)
