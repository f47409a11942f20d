"""Weather forecast payloads: one JSON document with a list of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.schemas import FORECAST_PAYLOAD


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Payload files, one document each, as flat readings."""
    return flatten_forecast(spark.read.schema(FORECAST_PAYLOAD).json(path, multiLine=True))


def parse_forecast(payloads: DataFrame, column: str = "value") -> DataFrame:
    """Payloads held as JSON text in a column, as flat readings."""
    return flatten_forecast(
        payloads.select(F.from_json(column, FORECAST_PAYLOAD).alias("payload")).select("payload.list")
    )


def flatten_forecast(payloads: DataFrame) -> DataFrame:
    """One row per reading. Of several weather entries the first one counts."""
    return payloads.select(F.explode("list").alias("reading")).select(
        F.col("reading.dt_txt").alias("datetime"),
        F.col("reading.main.humidity").cast("double").alias("humidity"),
        F.col("reading.main.pressure").cast("double").alias("pressure"),
        F.col("reading.main.temp").cast("double").alias("temperature"),
        F.get("reading.weather", F.lit(0))["description"].alias("weather_description"),
        F.col("reading.wind.speed").cast("double").alias("wind_speed"),
    )
