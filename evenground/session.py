"""Session helpers: sessions for tests, durable intermediates, size checks."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def local_session(cores: str = "8", app: str = "evenground", partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call-site tracking costs several round trips per column operation
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("EVENGROUND_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session, where driver and executors are one process, may fall
    back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        # the session appends its own unique folder to the one it was given
        return existing.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="evenground-")


def durable(df: DataFrame) -> DataFrame:
    """Write a small intermediate once, so that several results can read it
    and a lost executor does not lead back to the points."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_RECORDS: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name for a table written by a job."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _RECORDS:
        paths.append(path)
    return path


@contextmanager
def recorded_paths() -> Iterator[list[str]]:
    """The folder names given out inside the block."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not paths]


def discard_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written folders that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` after their last reader has been written."""
    for table in tables:
        discard_paths(table.sparkSession, {os.path.dirname(f) for f in table.inputFiles()})


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a wide intermediate as a columnar table and read it back, so that
    each later step reads only the columns it needs."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow table when a count shows that it is small.

    Beyond the bound the table is returned without a hint, and the join
    becomes a shuffle join that adaptive execution may split.  Meant for
    tables that are cheap to count (durable or read from files).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
