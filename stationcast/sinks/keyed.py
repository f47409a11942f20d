"""Tables laid out for lookups by key: ranges of the key in files of their own, and an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names within the folder of a keyed table.
ROWS = "rows"
INDEX = "index"
SLICE = "slice"


def write_keyed(
    df: DataFrame, path: str, key: str, row_group_bytes: int = 1 << 20, slices: int | None = None
) -> None:
    """Store ``df`` so that rows of some values of ``key`` are found without reading the others.

    Rows are dealt to ranges of the key, sorted there, and each range is a folder ``slice=n``. The
    index has one row per slice: its first and last key and how many rows it has. Inside a file
    small row groups carry the key's bounds and a Bloom filter. Adaptive execution chooses the
    number of ranges by their bytes, unless ``slices`` is given. Equal keys are dealt by the other
    columns, so one with a large share of the rows spreads over neighbouring slices. Rows without
    a key are stored and never found by it. What is there is replaced.
    """
    if SLICE in df.columns:
        raise ValueError(f"a keyed table cannot have a column named {SLICE}")
    spark = df.sparkSession
    others = [F.col(f"`{name}`") for name in df.columns if name != key]
    order = [F.col(f"`{key}`"), F.xxhash64(*others)] if others else [F.col(f"`{key}`")]
    dealt = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    (
        # Led by the slice, the order is what the writer of folders asks for, and is kept.
        dealt.withColumn(SLICE, F.spark_partition_id())
        .sortWithinPartitions(SLICE, *order)
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .partitionBy(SLICE)
        .parquet(f"{path}/{ROWS}")
    )
    stored = read_rows(spark, path, df.schema)
    bounds = stored.groupBy(SLICE).agg(
        F.min(f"`{key}`").alias("first"), F.max(f"`{key}`").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    # And a row without a slice, so that an empty table has its columns too.
    none = F.lit(None).cast(df.schema[key].dataType)
    head = spark.range(1).select(
        F.lit(None).cast("int").alias(SLICE), none.alias("first"), none.alias("last"), F.lit(0).cast("long").alias("rows")
    )
    index = bounds.unionByName(head).withColumns({"key": F.lit(key), "columns": F.lit(df.schema.json())})
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored rows with their slice."""
    whole = T.StructType([*schema.fields, T.StructField(SLICE, T.IntegerType())])
    return spark.read.schema(whole).parquet(f"{path}/{ROWS}")
