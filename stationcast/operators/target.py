"""Row-level steps from trips and weather to the grouped target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.functions import number, stable_round, wall_clock
from stationcast.operators.frequency import most_frequent_per_group
from stationcast.schemas import (
    CALENDAR_COLUMNS,
    MEASURES,
    SLOT_KEYS,
    STATION_ATTRIBUTES,
    STATION_COLUMNS,
    TRAINING_COLUMNS,
)


def join_hourly_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Add the readings of its hour to every trip; trips without readings drop out.

    ``starttime`` becomes a timestamp and the station a whole number. Stored weather has a
    known size, so Spark's threshold decides whether it is broadcast.
    """
    joined = trips.join(weather, F.col("starttime_join") == F.col("datetime"))
    return joined.select(
        wall_clock("starttime").alias("starttime"),
        number("from_station_id", "int").alias("from_station_id"),
        *STATION_ATTRIBUTES,
        "humidity",
        "pressure",
        "temperature",
        "weather_description",
        "wind_speed",
    )


def _target_in_one_pass(df: DataFrame) -> DataFrame:
    keys = [*STATION_COLUMNS, "date", "part_time", *CALENDAR_COLUMNS]
    tally = (
        df.dropna(subset=list(SLOT_KEYS))
        .groupBy(*keys, "weather_description")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            *[F.sum(number(name)).alias(f"{name}_sum") for name in MEASURES],
            *[F.count(number(name)).alias(f"{name}_count") for name in MEASURES],
        )
    )
    votes = F.sum("trips").over(Window.partitionBy(*SLOT_KEYS, "weather_description"))
    first = F.min(F.struct(-F.col("votes"), "weather_description"))
    judged = (
        tally.repartition(*SLOT_KEYS)
        .withColumn("votes", votes)
        .withColumn("first", first.over(Window.partitionBy(*SLOT_KEYS)))
        .withColumn("weather_description_mf", F.col("first.weather_description"))
    )
    means = [
        stable_round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")), 1).alias(name)
        for name in MEASURES
    ]
    groups = judged.groupBy(*keys, "weather_description_mf").agg(
        *means, F.sum("trips").alias("bicycle_rentals")
    )
    return groups.select(*TRAINING_COLUMNS)


def modal_weather(df: DataFrame) -> DataFrame:
    """Most frequent weather of each date, station and part of the day."""
    modal = most_frequent_per_group(
        df, keys=[*SLOT_KEYS, *CALENDAR_COLUMNS], values=["weather_description"]
    )
    return modal.select(
        F.col("date").alias("date_mf"),
        F.col("weather_description").alias("weather_description_mf"),
        F.col("part_time").alias("part_time_mf"),
        F.col("from_station_id").alias("from_station_id_mf"),
    )


def target_frame(df: DataFrame, modal: DataFrame | None = None) -> DataFrame:
    """Mean readings and number of rentals per date, station and part of the day.

    Without ``modal`` the detail is read once: it is grouped by slot and weather with sums
    and counts, and both the modal weather and the means come from these groups. With it,
    the modal weather is joined to the finished groups, as it depends on their keys only.
    """
    if modal is None:
        return _target_in_one_pass(df)
    groups = df.groupBy(*STATION_COLUMNS, "date", "part_time", *CALENDAR_COLUMNS).agg(
        *[stable_round(F.avg(number(name)), 1).alias(name) for name in MEASURES],
        F.count("from_station_id").alias("bicycle_rentals"),
    )
    same_slot = (
        (F.col("date") == F.col("date_mf"))
        & (F.col("from_station_id") == F.col("from_station_id_mf"))
        & (F.col("part_time") == F.col("part_time_mf"))
    )
    return groups.join(modal, same_slot).select(*TRAINING_COLUMNS)
