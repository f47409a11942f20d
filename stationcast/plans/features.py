"""Training and scoring frames, planned so that detail rows are reduced first.

The row-level operators define the result; the plans here give the same rows with less
data in motion:

* trips are counted per station and hour before any join, in one pass with partial
  aggregation, so neither a busy station nor a busy hour piles up in one task;
* readings are summed per hour and category before the join, so repeated hours do not
  multiply rows; from the five series, even before those are aligned;
* weekday, month and holiday are added to the finished groups, not to their rows;
* the forecast is reduced to parts of days before the stations come in, because modal
  weather and mean readings are the same for every station.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import mul

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.functions import hour_bucket, number, part_of_hour, stable_round, wall_clock
from stationcast.operators.calendar import day_features
from stationcast.operators.joins import grid_join
from stationcast.operators.stations import profile_of_tally, trip_tally
from stationcast.operators.weather import align_series, classify_weather
from stationcast.plans.ingest import weather_categories
from stationcast.schemas import (
    COUNTED_WEATHER,
    MEASURES,
    STATION_ATTRIBUTES,
    STATION_COLUMNS,
    TRAINING_COLUMNS,
)
from stationcast.session import stage

# Totals of a tally of readings.
TOTALS = ("readings", *[f"{name}_{kind}" for name in MEASURES for kind in ("sum", "count")])


def hourly_demand(trips: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Number of trips per station and hour, with the station's attributes.

    ``trips`` either carries the attributes (the ingested table) or is the raw table,
    with the ``profile`` given separately. Trips without a usable station or time cannot
    reach any group and are left out here.
    """
    attributes = list(STATION_ATTRIBUTES) if profile is None else []
    timed = trips.where(F.col("from_station_id").isNotNull()).select(
        "from_station_id",
        *attributes,
        F.coalesce(hour_bucket("starttime"), F.lit("")).alias("starttime_join"),
        wall_clock("starttime").alias("starttime"),
    )
    # The day and hour by the clock are keys too, should the text key not decide them.
    # Missing and unreadable times count 0 and leave afterwards: a filter on the keys
    # would be pushed below the aggregation and work on the text of every trip once more.
    hours = (
        timed.groupBy(
            "from_station_id",
            *attributes,
            "starttime_join",
            F.col("starttime").cast("date").alias("date"),
            F.hour("starttime").alias("hour"),
        )
        .agg(F.count("starttime").alias("trips"))
        .where(F.col("trips") > 0)
    )
    if profile is not None:
        stations = profile.select("station", *STATION_ATTRIBUTES)
        hours = hours.join(stations, F.col("from_station_id") == F.col("station")).drop("station")
    numbered = hours.withColumn("from_station_id", number("from_station_id", "int"))
    return numbered.where(F.col("from_station_id").isNotNull())


def demand_of_tally(tally: DataFrame, profile: DataFrame) -> DataFrame:
    """The same from :func:`trip_tally`, which is read here instead of the trips."""
    hours = (
        tally.where(F.col("from_station_id").isNotNull() & (F.col("timed") > 0))
        .groupBy("from_station_id", "starttime_join", "date", "hour")
        .agg(F.sum("timed").alias("trips"))
    )
    stations = profile.select("station", *STATION_ATTRIBUTES)
    joined = hours.join(stations, F.col("from_station_id") == F.col("station")).drop("station")
    numbered = joined.withColumn("from_station_id", number("from_station_id", "int"))
    return numbered.where(F.col("from_station_id").isNotNull())


def weather_tally(weather: DataFrame, time: str = "datetime") -> DataFrame:
    """Readings per time and category: how many, and sum and count of each measure."""
    totals = [F.count(F.lit(1)).alias("readings")]
    for name in MEASURES:
        totals.append(F.sum(number(name)).alias(f"{name}_sum"))
        totals.append(F.count(number(name)).alias(f"{name}_count"))
    return weather.groupBy(time, "weather_description").agg(*totals)


def series_tally(series: dict[str, DataFrame], vocabulary: DataFrame | None = None) -> DataFrame:
    """The tally of the aligned series, without building their rows.

    A repeated hour multiplies over the series. Here every series is reduced to its hours
    first; a total of one series then counts once for each combination of rows of the
    others. However often an hour is repeated, the joins see it once per category.
    """
    reduced = [
        series[name]
        .groupBy("datetime")
        .agg(
            F.count(F.lit(1)).alias(f"{name}_rows"),
            F.sum(number(name)).alias(f"{name}_sum"),
            F.count(number(name)).alias(f"{name}_count"),
        )
        for name in MEASURES
    ]
    categories = (
        weather_categories(series["weather_description"], vocabulary)
        .groupBy("datetime", "weather_description")
        .agg(F.count(F.lit(1)).alias("category_rows"))
    )
    aligned = align_series([*reduced, categories])

    def combinations(left_out: str | None = None):
        return reduce(mul, [F.col(f"{m}_rows") for m in MEASURES if m != left_out]) * F.col(
            "category_rows"
        )

    return aligned.select(
        "datetime",
        "weather_description",
        combinations().alias("readings"),
        *[
            (F.col(f"{name}_{kind}") * combinations(name)).alias(f"{name}_{kind}")
            for name in MEASURES
            for kind in ("sum", "count")
        ],
    )


def counted_tally(counted: DataFrame) -> DataFrame:
    """The tally from counted weather, without building the rows it stands for."""
    totals = []
    for name in MEASURES:
        weight = F.expr("rows div " + f"aggregate({name}, 0L, (n, x) -> n + x.rows)")
        read = F.transform(name, lambda x: F.struct(number(x["reading"]).alias("value"), x["rows"].alias("rows")))
        known = F.filter(read, lambda x: x["value"].isNotNull())
        total = F.aggregate(known, F.lit(0.0), lambda t, x: t + x["value"] * x["rows"])
        count = F.aggregate(known, F.lit(0).cast("long"), lambda t, x: t + x["rows"])
        totals.append(F.when(F.size(known) > 0, total * weight).alias(f"{name}_sum"))
        totals.append((count * weight).alias(f"{name}_count"))
    return counted.select("datetime", "weather_description", F.col("rows").alias("readings"), *totals)


def demand_frame(
    tally: DataFrame, holidays: DataFrame, station_columns: Sequence[str] = STATION_COLUMNS
) -> DataFrame:
    """Group weighted readings to date, station and part of the day.

    ``tally`` has ``date``, ``hour``, the station columns and the totals of
    :func:`weather_tally`, with no NULL station or date. All steps share one shuffle on
    date, station and part, and one sort. The most frequent weather is decided over all
    rows of such a slot, ties by name, NULL first. What the date alone decides is added
    to the finished groups.
    """
    slot = ["date", *[name for name in station_columns if name == "from_station_id"], "part_time"]
    parts = tally.withColumn("part_time", part_of_hour("hour"))

    votes = F.sum("readings").over(Window.partitionBy(*slot, "weather_description"))
    first = F.min(F.struct(-F.col("votes"), "weather_description")).over(Window.partitionBy(*slot))
    judged = (
        parts.repartition(*slot)
        .withColumn("votes", votes)
        .withColumn("weather_description_mf", first["weather_description"])
    )
    groups = judged.groupBy(
        *station_columns, "date", "part_time", "weather_description_mf"
    ).agg(
        *[
            stable_round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")), 1).alias(name)
            for name in MEASURES
        ],
        F.sum("readings").alias("bicycle_rentals"),
    )
    return day_features(groups, holidays).withColumn("date", F.col("date").cast("string"))


def _weighted(tally: DataFrame, weight: str) -> DataFrame:
    """Multiply all totals by a column of the same row."""
    return tally.withColumns({name: F.col(name) * F.col(weight) for name in TOTALS})


def training_frame(
    trips: DataFrame,
    weather: DataFrame | dict[str, DataFrame],
    holidays: DataFrame,
    profile: DataFrame | None = None,
) -> DataFrame:
    """The frame to train on, one row per date, station and part of the day.

    ``trips`` and ``profile`` are as in :func:`hourly_demand`; ``weather`` is the weather
    table or the five series it is made of.
    """
    return frame_of_hours(hourly_demand(trips, profile), weather, holidays)


def training_frame_from_trips(
    flagged: DataFrame, weather: DataFrame | dict[str, DataFrame], holidays: DataFrame
) -> DataFrame:
    """The same from trips with rider flags alone, which are read once.

    They are counted per station, coordinates and hour; this table is stored, and both the
    station profile and the demand come from it.
    """
    tally = stage(trip_tally(flagged), "tally")
    hours = demand_of_tally(tally, profile_of_tally(tally))
    return frame_of_hours(hours, weather, holidays)


def frame_of_hours(
    hours: DataFrame, weather: DataFrame | dict[str, DataFrame], holidays: DataFrame
) -> DataFrame:
    """The frame to train on from demand by station and hour; counted weather goes in as it is."""
    if isinstance(weather, dict):
        readings = series_tally(weather)
    elif set(COUNTED_WEATHER) <= set(weather.columns):
        readings = counted_tally(weather)
    else:
        readings = weather_tally(weather)
    joined = hours.join(readings, F.col("starttime_join") == F.col("datetime"))
    return demand_frame(_weighted(joined, "trips"), holidays).select(*TRAINING_COLUMNS)


def scoring_frame(
    stations: DataFrame,
    forecast: DataFrame,
    holidays: DataFrame,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """The frame to score: every station with every forecast part of a day.

    ``stations`` has the station columns, repeated or not; ``forecast`` is the flat
    forecast. The historic spelling is not normalized here. Times written in several
    ways count once for each spelling.
    """
    classified = classify_weather(forecast, vocabulary).select(
        "datetime", F.col("weather_condition").alias("weather_description"), *MEASURES
    )
    moments = classified.withColumn("starttime", wall_clock("datetime")).dropna(
        subset=["starttime"]
    )
    spellings = (
        moments.select("starttime", "datetime")
        .distinct()
        .groupBy("starttime")
        .agg(F.count(F.lit(1)).alias("spellings"))
    )
    tally = weather_tally(moments, "starttime").join(spellings, "starttime")
    timed = _weighted(tally, "spellings").withColumns(
        {"date": F.col("starttime").cast("date"), "hour": F.hour("starttime")}
    )
    parts = demand_frame(timed, holidays, station_columns=())
    known = (
        stations.select(
            number("from_station_id", "int").alias("from_station_id"), *STATION_ATTRIBUTES
        )
        .where(F.col("from_station_id").isNotNull())
        .distinct()
    )
    parts = stage(parts.drop("bicycle_rentals"), "parts")
    return grid_join(known, parts, list(STATION_COLUMNS)).select(
        *[name for name in TRAINING_COLUMNS if name != "bicycle_rentals"]
    )
