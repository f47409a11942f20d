"""What the inner joins leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unmatched_hours(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Hours with trips but without readings, and the trips lost there.

    Trips are counted per hour before the join, so it compares hours and not trips.
    """
    hours = trips.groupBy("starttime_join").agg(F.count(F.lit(1)).alias("trips"))
    known = weather.select("datetime").distinct()
    return hours.join(known, F.col("starttime_join") == F.col("datetime"), "left_anti")


def unmatched_summary(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """One row: all trips, those without a station, and those without readings."""
    hours = trips.groupBy("starttime_join").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("from_station_id").isNull()).alias("without_station"),
    )
    known = weather.select("datetime").distinct()
    return hours.join(known, F.col("starttime_join") == F.col("datetime"), "left").agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"),
        F.coalesce(F.sum("without_station"), F.lit(0)).alias("without_station"),
        F.coalesce(F.sum(F.when(F.col("datetime").isNull(), F.col("trips"))), F.lit(0)).alias(
            "without_weather"
        ),
    )
