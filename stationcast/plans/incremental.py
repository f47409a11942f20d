"""Station profile and training frame that grow by batches of trips.

The trips of a batch are counted once, by ``trip_tally``, and only the counts are kept, in a folder
per batch. Counts and sums of several batches add up, so profile, demand and training frame come
from the folders alone and no earlier trip is read again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.operators.stations import profile_of_tally, trip_tally
from stationcast.plans.features import demand_of_tally, frame_of_hours
from stationcast.session import stage

_NAME = re.compile(r"[A-Za-z0-9_-]+")
BATCH = "batch"
# What tells two rows of a tally apart; all other columns are counts and sums.
TALLY_KEYS = ("from_station_id", "latitude_start", "longitude_start", "starttime_join", "date", "hour")


def add_batch(flagged: DataFrame, path: str, batch: str) -> None:
    """Count the trips of a batch and keep the counts under its name.

    ``flagged`` has the rider flags. A batch that comes again replaces its own counts, so it may be
    replayed, corrected, or emptied; a write that fails leaves the others as they are.
    """
    if not _NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, - and _: {batch!r}")
    trip_tally(flagged).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all batches, several rows to a key; they are added up where they are used."""
    return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*").drop(BATCH)


def merge_tallies(tally: DataFrame) -> DataFrame:
    """One row per key, as if all batches had been counted at once."""
    totals = [name for name in tally.columns if name not in TALLY_KEYS]
    return tally.groupBy(*TALLY_KEYS).agg(*[F.sum(name).alias(name) for name in totals])


def compact(spark: SparkSession, path: str, out: str, batch: str) -> None:
    """Write the counts of all batches as the one batch of another folder."""
    merged = merge_tallies(read_batches(spark, path))
    merged.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch}")


def batched_profile(spark: SparkSession, path: str) -> DataFrame:
    """The station profile over all batches."""
    return profile_of_tally(read_batches(spark, path))


def batched_training_frame(
    spark: SparkSession, path: str, weather: DataFrame | dict[str, DataFrame], holidays: DataFrame
) -> DataFrame:
    """The frame to train on over all batches."""
    tally = read_batches(spark, path)
    profile = stage(profile_of_tally(tally), "profile")
    return frame_of_hours(demand_of_tally(tally, profile), weather, holidays)
