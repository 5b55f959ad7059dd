"""Session settings the operators rely on."""

from __future__ import annotations

import contextlib
import os
import pathlib
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Where none is set, a local
    session gets a temporary one and any other an error: executors could not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if not named and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="logfreight-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, kind: str = "work") -> str:
    """A new folder name beside the checkpoints, on storage all executors share."""
    return f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4()}"


def written_table(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once as a table in the checkpoint folder."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever storage it is, if it is there."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all tables and checkpoints made inside, removed at the end.

    Write or collect results before the end; they are read from that folder.
    """
    before = checkpoint_dir(spark)
    context = spark.sparkContext
    outer = scratch(spark)
    # Spark puts a folder of its own inside the one it is given.
    context.setCheckpointDir(outer)
    try:
        yield outer
    finally:
        context.setCheckpointDir(before)
        remove_folder(spark, outer)


# Spark's own value lets a batch of large packages take 64 MB, several times over in a Python worker.
BATCH_BYTES, SPARKS_OWN = 8 << 20, 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready: UTC, bounded Arrow batches, and this package importable in the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) == f"{SPARKS_OWN}b":
        spark.conf.set(bound, BATCH_BYTES)
    context = spark.sparkContext
    if not getattr(context, "_logfreight_shipped", False):
        root = pathlib.Path(__file__).resolve().parent.parent
        # Executors get the archive; workers on this machine, among them the one that
        # sets up stateful streams, get the folder.
        given = context.environment.get("PYTHONPATH")
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(root), given]))
        base = pathlib.Path(tempfile.mkdtemp(prefix="logfreight-")) / "logfreight"
        context.addPyFile(shutil.make_archive(str(base), "zip", root, "logfreight"))
        context._logfreight_shipped = True
    checkpoint_dir(spark)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("logfreight")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.compress", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)
