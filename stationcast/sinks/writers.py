"""Writers for tables, documents, messages and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from stationcast.operators.documents import document_messages


def write_table(
    df: DataFrame,
    path: str,
    max_records: int | None = None,
    partition_by: Sequence[str] = (),
    merge_small: bool = False,
) -> None:
    """Snappy Parquet, replacing what is there.

    Every task writes its own part and nothing is shuffled. ``max_records`` cuts the files
    of a task. ``merge_small`` lets adaptive execution even out the parts first: by size,
    not to a number of files. Partition columns bring the rows of a value together first,
    and a value that is too large for one task is split into several files.
    """
    out = df.hint("rebalance", *partition_by) if partition_by or merge_small else df
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object per line; the folder that ``read_documents`` reads."""
    documents.write.mode("overwrite").json(path)


def write_topic(
    documents: DataFrame, servers: str, topic: str, ignore_null_fields: bool = True
) -> None:
    """One message per document, without a key."""
    messages = document_messages(documents, ignore_null_fields)
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
