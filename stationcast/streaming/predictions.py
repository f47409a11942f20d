"""Prediction documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationcast.sources.predictions import parse_documents, read_topic


def stream_messages(
    spark: SparkSession, folder: str, max_files: int | None = None
) -> DataFrame:
    """Text files of JSON messages as a stream with a ``value`` column."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def read_predictions(messages: DataFrame, raw: bool = False) -> DataFrame:
    """Documents from messages, batch or streaming; ``raw`` keeps the JSON text."""
    if raw:
        return messages.select(messages["value"].cast("string").alias("value"))
    return parse_documents(messages)


def stream_predictions(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = 5000
) -> DataFrame:
    """Documents of a topic as a stream, ``max_records`` to a micro-batch."""
    return read_predictions(read_topic(spark, servers, topic, True, max_records))


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything that is available now to Parquet and return the table.

    The checkpoint remembers what was read: a later run with the same one appends only
    newer messages, and a run that broke off continues where it stopped.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
