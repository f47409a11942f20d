"""Prediction documents, from files or from a topic, and the saved model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.schemas import PREDICTION_DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents from a folder. The schema is given, so no pass is spent on inference."""
    return spark.read.schema(PREDICTION_DOCUMENT).json(path)


def parse_documents(messages: DataFrame, column: str = "value") -> DataFrame:
    """Documents from JSON messages, text or bytes; works on batch and streaming frames."""
    text = F.col(column).cast("string")
    return messages.select(F.from_json(text, PREDICTION_DOCUMENT).alias("document")).select(
        "document.*"
    )


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = False,
    max_records: int | None = None,
) -> DataFrame:
    """Messages of a topic from its earliest offset, as a text ``value`` column.

    ``max_records`` limits one micro-batch of a stream, not the result. Needs the
    Kafka connector of the Spark distribution on the class path.
    """
    if max_records and not streaming:
        raise ValueError("max_records limits the micro-batches of a stream; a batch is read whole")
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
