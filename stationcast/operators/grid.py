"""Stations by forecast times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions import number, wall_clock
from stationcast.operators.joins import grid_join
from stationcast.schemas import STATION_COLUMNS
from stationcast.session import stage


def station_list(trips: DataFrame) -> DataFrame:
    """The distinct stations among trips that carry their profile."""
    return trips.select(*STATION_COLUMNS).distinct()


def scoring_grid(stations: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row per station and forecast reading, the station as a whole number.

    Repeated station rows count once.

    Times that are written differently but mean the same moment count separately, each
    with all readings of that moment. They are matched on the small forecast side, before
    the stations come in.
    """
    times = forecast.select(wall_clock("datetime").alias("starttime"), "datetime").distinct()
    readings = forecast.withColumn("_moment", wall_clock("datetime"))
    slots = readings.join(
        times.select("starttime"), F.col("_moment") == F.col("starttime")
    ).drop("_moment")
    known = stations.select(*STATION_COLUMNS).distinct()
    grid = grid_join(known, stage(slots, "slots"), list(STATION_COLUMNS))
    return grid.withColumn("from_station_id", number("from_station_id", "int"))
