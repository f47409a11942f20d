"""Reading the document tables, and batches of bounded size for code that runs in tasks."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at once inside a task; one longer text makes a batch of its own.
BATCH_BYTES = 2 << 20


# Rows and bytes of the batches that Spark hands to Python: texts and lists of texts are long.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20,
}


def prepare(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it, and bound batches.

    On a cluster whose machines do not see it, ship the package with ``--py-files`` as usual.
    Batch sizes of the session are lowered to ``ARROW`` where they are larger.
    """
    for key, most in ARROW.items():
        held = spark.conf.get(key).removesuffix("b")
        if held.isdecimal() and int(held) > most:
            spark.conf.set(key, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a missing text as the empty one; other columns are dropped."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fold(divisor: int) -> F.Column:
    """Remainder that deals a document to a fold: crc32 of its id, written in decimal."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` (``BATCH_BYTES``) of ``column`` or one row."""
    most = most or BATCH_BYTES
    for batch in batches:
        values = batch.column(column)
        nested = pa.types.is_list(values.type)
        sizes = pc.multiply(pc.list_value_length(values), 4) if nested else pc.binary_length(values)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


@functools.cache
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Return memory that a process has freed to the machine: workers live on after a task."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(_libc(), "malloc_trim", None):
        trim(0)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict],
    schema: str,
    column: str = "text",
    after: Callable[[], None] | None = None,
    most: int | None = None,
) -> DataFrame:
    """Apply ``function`` to slices of the rows; it returns the columns of the result.

    ``after`` is called at the end of each task, ``most`` bounds the bytes of a slice.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for piece in slices(batches, column, most):
                columns = function(piece)
                yield pa.RecordBatch.from_arrays([pa.array(columns[n]) for n in names], names=names)
        finally:
            if after:
                after()
            give_back()

    return df.mapInArrow(run, schema)
