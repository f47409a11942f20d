"""Rider flags and the station profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.functions import (
    hour_bucket,
    membership_flag,
    number,
    stable_round,
    wall_clock,
)
from stationcast.operators.frequency import most_frequent_per_group


def usertype_flags(trips: DataFrame) -> DataFrame:
    """Add ``subscriber`` and ``customer``; any other rider type is 0 in both."""
    return trips.withColumns(
        {
            "subscriber": membership_flag("usertype", "Subscriber"),
            "customer": membership_flag("usertype", "Customer"),
        }
    )


def profile_measures() -> list:
    """Aggregates that describe a station at one pair of coordinates."""
    return [
        stable_round(F.avg(number("dpcapacity_start")), 0).alias("mean_dpcapacity_start"),
        stable_round(F.avg(number("dpcapacity_end")), 0).alias("mean_dpcapacity_end"),
        F.sum("subscriber").alias("sum_subscriber"),
        F.sum("customer").alias("sum_customer"),
    ]


def trip_tally(trips: DataFrame) -> DataFrame:
    """Flagged trips per station, coordinates and hour: all that profile and demand need.

    One pass over the trips with a combining aggregate: however busy a station or an hour
    is, it leaves each task as one row per combination. ``trips`` counts the rows, ``timed``
    those with a readable time.
    """
    counted = trips.select(
        "from_station_id",
        "latitude_start",
        "longitude_start",
        F.coalesce(hour_bucket("starttime"), F.lit("")).alias("starttime_join"),
        wall_clock("starttime").alias("starttime"),
        number("dpcapacity_start").alias("start"),
        number("dpcapacity_end").alias("end"),
        "subscriber",
        "customer",
    )
    # The day and hour by the clock are keys too, should the text key not decide them.
    return counted.groupBy(
        "from_station_id",
        "latitude_start",
        "longitude_start",
        "starttime_join",
        F.col("starttime").cast("date").alias("date"),
        F.hour("starttime").alias("hour"),
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("starttime").alias("timed"),
        *[F.sum(name).alias(f"{name}_sum") for name in ("start", "end", "subscriber", "customer")],
        *[F.count(name).alias(f"{name}_count") for name in ("start", "end")],
    )


def profile_of_tally(tally: DataFrame) -> DataFrame:
    """The station profile from the tally instead of the trips."""
    with_station = F.when(F.col("from_station_id").isNotNull(), F.col("trips")).otherwise(0)
    means = [
        stable_round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")), 0).alias(
            f"mean_dpcapacity_{name}"
        )
        for name in ("start", "end")
    ]
    sums = [F.sum(f"{name}_sum").alias(f"sum_{name}") for name in ("subscriber", "customer")]
    return _profile(tally, [*means, *sums], F.sum(with_station))


def _profile(rows: DataFrame, measures: list, counter: Column) -> DataFrame:
    profile = most_frequent_per_group(
        rows,
        keys=["from_station_id"],
        values=["latitude_start", "longitude_start"],
        measures=measures,
        counter=counter,
    )
    return profile.withColumnsRenamed(
        {
            "from_station_id": "station",
            "latitude_start": "latitude",
            "longitude_start": "longitude",
        }
    ).withColumn("rank", F.lit(1))


def station_profile(trips: DataFrame) -> DataFrame:
    """One row per station: its most frequent coordinates, and capacity and riders there.

    ``trips`` carries the rider flags. Capacities and rider sums cover the trips at the
    winning coordinates only. Trips without a station form a row of their own with
    count 0.
    """
    return _profile(trips, profile_measures(), F.count("from_station_id"))


def attach_profile(trips: DataFrame, profile: DataFrame) -> DataFrame:
    """Add the profile of its station to every trip; trips without a station drop out.

    A stored profile has a known size: below Spark's threshold it is broadcast, beyond it both
    sides are shuffled and adaptive execution splits the partition of a hot station.
    """
    return trips.join(profile, F.col("from_station_id") == F.col("station"))
