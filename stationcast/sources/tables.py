"""Trip and weather tables: CSV as delivered, Parquet as ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.functions import hour_bucket
from stationcast.schemas import (
    COUNTED_WEATHER,
    MEASURES,
    RAW_TRIP_COLUMNS,
    STATION_COLUMNS,
    require_columns,
)

WEATHER_COLUMNS = ("datetime", *MEASURES[:3], "weather_description", MEASURES[3])


def _read_text_table(spark: SparkSession, path: str) -> DataFrame:
    # The header names the columns and no types are inferred: one pass, all text.
    return spark.read.option("header", True).csv(path)


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the trip CSV as text; columns the library does not know pass through."""
    return require_columns(_read_text_table(spark, path), RAW_TRIP_COLUMNS, "trip CSV")


def select_measure(df: DataFrame, city: str, measure: str) -> DataFrame:
    """The hour column and one city, named after the measure."""
    require_columns(df, ("datetime", city), f"{measure} series")
    return df.select("datetime", F.col(f"`{city}`").alias(measure))


def read_measure(spark: SparkSession, path: str, city: str, measure: str) -> DataFrame:
    return select_measure(_read_text_table(spark, path), city, measure)


def read_measures(spark: SparkSession, paths: dict[str, str], city: str) -> dict[str, DataFrame]:
    """One series per measure, keyed by its name."""
    return {measure: read_measure(spark, path, city, measure) for measure, path in paths.items()}


def trip_columns(trips: DataFrame) -> DataFrame:
    """The trip columns that feature building needs, and the key of the trip's hour."""
    return trips.select(
        "starttime", *STATION_COLUMNS, hour_bucket("starttime").alias("starttime_join")
    )


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return trip_columns(spark.read.parquet(path))


def read_flagged_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips with rider flags, as the ingest job stores them next to the profile."""
    return spark.read.parquet(path)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """The stored station profile as the list of stations; no trip is read for it."""
    profile = spark.read.parquet(path).where(F.col("station").isNotNull())
    return profile.withColumnRenamed("station", "from_station_id").select(*STATION_COLUMNS)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """The weather table, plain or counted; a counted one has its numbers of rows too."""
    table = spark.read.parquet(path)
    return table.select(*WEATHER_COLUMNS, *[name for name in COUNTED_WEATHER if name in table.columns])
