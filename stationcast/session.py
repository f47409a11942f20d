"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# What the plans rely on, unless the session was started with other values.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session for a job; what spark-submit was told takes precedence over the settings.

    A master is given for local runs only, and those open no web page.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
    return spark


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stationcast-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that is one process, so one machine, has a temporary folder of its own
    where the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


_OWNED: list[list[str]] = []


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Own what is staged inside, and delete it at the end, after the last write of a job.

    Results that are still to be read must be written inside. Without it, staged tables stay
    in the shared folder for whoever reads the returned frames.
    """
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nobody reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def evenly(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to ``spark.sql.shuffle.partitions`` tasks, which Spark does not merge.

    For rows that cost more than their bytes tell: packed by bytes, a table of few distinct values
    becomes fewer tasks than the cluster runs at once, or one more than it does.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage beyond its files, so a lost executor costs a re-read
    and not a recomputation, and the planner knows its real size: a small staged
    table is broadcast by Spark's own threshold, a large one is shuffled. A ``path`` that
    ``scratch_path`` gave outside of ``staging`` lets the table outlast what is staged inside.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Whether the shuffle files of a query go when it ends; else they stay until the driver happens to
# collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For the write of a table, after which nothing reads the shuffle files again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
