"""Session helpers: a session with the settings the library expects, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "devicelens") -> SparkSession:
    """Get or create a session. On a cluster leave ``master`` unset; the submit settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoints that nothing refers to any more are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a
    folder would exist on one machine only.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if not current:
        if not configured:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="devicelens-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, in a folder of this application that goes when the application ends.

    Within :func:`scratch` it goes at the end of the block.
    """
    home = _home(spark)
    return os.path.join(_SCOPES[-1] if _SCOPES else home, f"{label}-{uuid.uuid4().hex}")


_SCOPES: list[str] = []


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _home(spark: SparkSession) -> str:
    """The scratch folder of the application; made, and marked for removal at its end, when first asked for."""
    home = os.path.join(shared_dir(spark), f"scratch-{spark.sparkContext.applicationId}")
    files, where = _file_system(spark, home)
    if not files.exists(where):
        files.mkdirs(where)
        files.deleteOnExit(where)
    return home


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Paths from :func:`scratch_path` inside the block lie in one folder, which is removed at its end, also after an error.

    Results must be written elsewhere, or counted, before the block ends: what still reads a removed path fails.
    """
    folder = os.path.join(_home(spark), f"scope-{uuid.uuid4().hex}")
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        files, where = _file_system(spark, folder)
        files.delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and forget the lineage; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: for data that many jobs will read in part.

    Unlike :func:`cut` the copy is columnar, so later readers take only the columns and row groups they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, n_rows: int) -> Iterator[None]:
    """Within it, planned jobs hand Python at most so many rows at a time: for rows that are large themselves."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n_rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
