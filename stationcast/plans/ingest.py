"""From delivered text tables to the trip and weather tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions import normalize_value
from stationcast.operators.stations import attach_profile, station_profile, usertype_flags
from stationcast.operators.weather import (
    HISTORIC_SPELLING,
    align_series,
    classify_weather,
    count_readings,
    expand_readings,
)
from stationcast.schemas import MEASURES, RAW_TRIP_COLUMNS, require_columns
from stationcast.session import stage

def ingest_trips(trips: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Trips with rider flags and the profile of their station.

    The profile is a small table of its own. It is stored before it is joined, so the
    planner knows its size: below Spark's threshold the trips are not shuffled.
    """
    flagged = usertype_flags(require_columns(trips, RAW_TRIP_COLUMNS, "trips"))
    if profile is None:
        profile = stage(station_profile(flagged), "profile")
    return attach_profile(flagged, profile)


def weather_categories(descriptions: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """The description series in its historic spelling as a series of categories."""
    spelled = descriptions.withColumn(
        "weather_description", normalize_value("weather_description", HISTORIC_SPELLING)
    )
    return classify_weather(spelled, vocabulary).select(
        "datetime", F.col("weather_condition").alias("weather_description")
    )


def ingest_weather(
    series: dict[str, DataFrame], vocabulary: DataFrame | None = None
) -> DataFrame:
    """Five series, each with ``datetime`` and its measure, as one table by hour.

    ``weather_description`` holds the category in the result.
    """
    return align_series(
        [
            series["humidity"],
            series["pressure"],
            series["temperature"],
            weather_categories(series["weather_description"], vocabulary),
            series["wind_speed"],
        ]
    )


def ingest_counted_weather(
    series: dict[str, DataFrame], vocabulary: DataFrame | None = None
) -> DataFrame:
    """The weather table with multiplicities instead of repeated rows: one row per hour and category.

    Each measure is a list of its distinct readings of the hour with their number of rows;
    ``category_rows`` is that of the category, and ``rows`` says how many rows of the plain table
    the row stands for. However often an hour is repeated in the series, it is written once per
    category, and a list is as long as the hour has distinct readings.
    """
    categories = (
        weather_categories(series["weather_description"], vocabulary)
        .groupBy("datetime", "weather_description")
        .agg(F.count(F.lit(1)).alias("category_rows"))
    )
    aligned = align_series([*[count_readings(series[name], name) for name in MEASURES], categories])
    rows = F.col("category_rows")
    for name in MEASURES:
        rows = rows * F.aggregate(name, F.lit(0).cast("long"), lambda n, pair: n + pair["rows"])
    return aligned.withColumn("rows", rows)


def plain_weather(counted: DataFrame) -> DataFrame:
    """The rows of :func:`ingest_weather` from the counted ones."""
    expanded = expand_readings(counted, list(MEASURES))
    return expanded.select("datetime", *MEASURES[:3], "weather_description", MEASURES[3])
