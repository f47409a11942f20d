"""One query per operator, each over the whole tables of a scale factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast import operators as ops
from stationcast import plans, sinks, sources, streaming
from stationcast.catalog import adapters
from stationcast.functions import hour_bucket, keyed_share
from stationcast.plans import model as ml
from stationcast.schemas import SLOT_KEYS, STATION_COLUMNS
from stationcast.session import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_STATION = 7


# Building blocks -------------------------------------------------------------------


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return ops.usertype_flags(adapters.raw_trips(spark, sf))


def _ingested(spark: SparkSession, sf: str) -> DataFrame:
    return plans.ingest_trips(adapters.raw_trips(spark, sf))


def _weather(spark: SparkSession, sf: str) -> DataFrame:
    return plans.ingest_weather(adapters.measure_series(spark, sf))


def _stored_weather(spark: SparkSession, sf: str) -> DataFrame:
    """The weather table as the ingest job leaves it: stored, so joins know its size."""
    return stage(_weather(spark, sf), "weather")


def _detail(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with readings and calendar features, row by row."""
    trips = sources.trip_columns(_ingested(spark, sf))
    joined = ops.join_hourly_weather(trips, _stored_weather(spark, sf))
    return ops.calendar_features(joined, adapters.holidays(spark, sf))


def _forecast(spark: SparkSession, sf: str) -> DataFrame:
    return sources.parse_forecast(adapters.forecast_payloads(spark, sf))


def _stations(spark: SparkSession, sf: str) -> DataFrame:
    """The list of stations as the predict job reads it: from the stored profile."""
    folder = scratch_path(spark, "stations")
    sinks.write_table(ops.station_profile(_flagged(spark, sf)), folder)
    return sources.read_stations(spark, folder)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return ops.prediction_documents(adapters.stand_in_score(scoring_frame(spark, sf)))


def _entries(documents: DataFrame) -> DataFrame:
    """Nested documents as one row per station, date and part of the day."""
    return (
        documents.select(*STATION_COLUMNS, F.explode("dates").alias("day"))
        .select(*STATION_COLUMNS, "day.date", F.explode("day.info").alias("part"))
        .select(*STATION_COLUMNS, "date", "part.*")
    )


# Trips -----------------------------------------------------------------------------


def usertype_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).select("trip_id", "usertype", "subscriber", "customer")


def station_coordinate_groups(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["from_station_id", "latitude_start", "longitude_start"]
    return (
        _flagged(spark, sf)
        .groupBy(*keys)
        .agg(F.count("from_station_id").alias("count"), *ops.stations.profile_measures())
    )


def station_profile(spark: SparkSession, sf: str) -> DataFrame:
    return ops.station_profile(_flagged(spark, sf))


def trips_with_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf)


def station_list(spark: SparkSession, sf: str) -> DataFrame:
    return ops.station_list(_ingested(spark, sf))


def hour_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.raw_trips(spark, sf).select(
        "trip_id", "starttime", hour_bucket("starttime").alias("starttime_join")
    )


# Weather ---------------------------------------------------------------------------


def measure_series(spark: SparkSession, sf: str) -> DataFrame:
    """The five series, written as CSV with two cities and read back for one."""
    paths = {}
    for name, df in adapters.measure_tables(spark, sf).items():
        paths[name] = scratch_path(spark, name)
        sinks.write_csv(df, paths[name])
    series = sources.read_measures(spark, paths, adapters.CITY)
    stacked = [
        df.select("datetime", F.lit(name).alias("measure"), F.col(name).alias("reading"))
        for name, df in series.items()
    ]
    result = stacked[0]
    for df in stacked[1:]:
        result = result.unionByName(df)
    return result


def weather_classified(spark: SparkSession, sf: str) -> DataFrame:
    series = adapters.measure_series(spark, sf)["weather_description"]
    return ops.classify_weather(series)


def weather_aligned(spark: SparkSession, sf: str) -> DataFrame:
    return _weather(spark, sf)


def weather_duplicate_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Humidity and pressure come twice for odd hours; each pair of rows counts."""
    return plans.ingest_weather(adapters.repeated_series(spark, sf))


# Features --------------------------------------------------------------------------


def trips_weather_join(spark: SparkSession, sf: str) -> DataFrame:
    trips = sources.trip_columns(_ingested(spark, sf))
    joined = ops.join_hourly_weather(trips, _stored_weather(spark, sf))
    return joined.withColumn("starttime", F.col("starttime").cast("string"))


def unmatched_trips(spark: SparkSession, sf: str) -> DataFrame:
    trips = sources.trip_columns(_ingested(spark, sf))
    return ops.unmatched_hours(trips, _stored_weather(spark, sf))


def unmatched_summary(spark: SparkSession, sf: str) -> DataFrame:
    trips = adapters.raw_trips(spark, sf).select(
        "from_station_id", hour_bucket("starttime").alias("starttime_join")
    )
    return ops.unmatched_summary(trips, _stored_weather(spark, sf))


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    trips = adapters.raw_trips(spark, sf).select("trip_id", "starttime")
    return ops.calendar_features(trips, adapters.holidays(spark, sf))


def holiday_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Orders placed on each holiday, over all years of the orders table."""
    per_day = (
        adapters.table(spark, sf, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return per_day.join(adapters.holidays(spark, sf), "date").select(
        F.col("date").cast("string").alias("date"), "name", "orders"
    )


def modal_weather(spark: SparkSession, sf: str) -> DataFrame:
    return ops.modal_weather(_detail(spark, sf))


def target_frame(spark: SparkSession, sf: str) -> DataFrame:
    return ops.target_frame(_detail(spark, sf))


def target_frame_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    """The same frame from the ingested trips, counted by hour before the join."""
    return plans.training_frame(
        _ingested(spark, sf), _stored_weather(spark, sf), adapters.holidays(spark, sf)
    )


def training_frame(spark: SparkSession, sf: str) -> DataFrame:
    """From raw trips and series to the frame to train on, without storing the trips."""
    return plans.training_frame_from_trips(
        _flagged(spark, sf), _stored_weather(spark, sf), adapters.holidays(spark, sf)
    )


def training_frame_uneven(spark: SparkSession, sf: str) -> DataFrame:
    """A hot station, missing and unreadable stations, times and capacities."""
    flagged = ops.usertype_flags(adapters.uneven_trips(spark, sf))
    return plans.training_frame_from_trips(
        flagged, _stored_weather(spark, sf), adapters.holidays(spark, sf)
    )


def station_profile_uneven(spark: SparkSession, sf: str) -> DataFrame:
    return ops.station_profile(ops.usertype_flags(adapters.uneven_trips(spark, sf)))


def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar features of the days of almost forty years."""
    days = adapters.calendar_days(spark, sf)
    return ops.calendar_features(days, ops.holiday_calendar(spark, range(1994, 2036)))


def training_frame_repeated_hours(spark: SparkSession, sf: str) -> DataFrame:
    """The training frame from series with repeated hours, without aligning their rows."""
    return plans.training_frame_from_trips(
        _flagged(spark, sf), adapters.repeated_series(spark, sf), adapters.holidays(spark, sf)
    )


# Forecast --------------------------------------------------------------------------


def forecast_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return _forecast(spark, sf)


def scoring_grid(spark: SparkSession, sf: str) -> DataFrame:
    classified = ops.classify_weather(_forecast(spark, sf))
    grid = ops.scoring_grid(_stations(spark, sf), classified)
    return grid.withColumn("starttime", F.col("starttime").cast("string"))


def scoring_frame(spark: SparkSession, sf: str) -> DataFrame:
    return plans.scoring_frame(
        _stations(spark, sf), _forecast(spark, sf), adapters.holidays(spark, sf)
    )


# Documents -------------------------------------------------------------------------


def prediction_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(_documents(spark, sf))


def prediction_messages(spark: SparkSession, sf: str) -> DataFrame:
    return ops.document_messages(_documents(spark, sf))


def prediction_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return ops.lookup_predictions(_documents(spark, sf), LOOKUP_STATION)


def prediction_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Messages written as a batch, then drained as a stream into a table."""
    folder = scratch_path(spark, "messages")
    ops.document_messages(_documents(spark, sf)).write.text(folder)
    stream = streaming.read_predictions(streaming.stream_messages(spark, folder))
    table = streaming.drain(stream, scratch_path(spark, "drained"), scratch_path(spark, "progress"))
    return _entries(table)


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "documents")
    sinks.write_documents(_documents(spark, sf), folder)
    return _entries(sources.read_documents(spark, folder))


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "trips")
    sinks.write_table(_ingested(spark, sf), folder)
    return sources.read_trips(spark, folder)


def weather_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "weather-table")
    sinks.write_table(_weather(spark, sf), folder, max_records=500)
    return sources.read_weather(spark, folder)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "trips-csv")
    sinks.write_csv(adapters.raw_trips(spark, sf), folder)
    return sources.read_trips_csv(spark, folder)


# Model -----------------------------------------------------------------------------


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    frame = training_frame(spark, sf)
    return frame.select(*SLOT_KEYS, (keyed_share(SLOT_KEYS, seed=1) < 70).alias("is_train"))


def imputed_features(spark: SparkSession, sf: str) -> DataFrame:
    frame = stage(training_frame(spark, sf), "frame")
    filled = ml.imputer().fit(frame).transform(frame)
    return filled.select(
        *SLOT_KEYS, *[F.round(f"{name}_input", 6).alias(f"{name}_input") for name in ml.IMPUTED]
    )


def indexed_features(spark: SparkSession, sf: str) -> DataFrame:
    frame = stage(training_frame(spark, sf), "frame")
    numbered = ml.indexer().fit(frame).transform(frame)
    return numbered.select(*SLOT_KEYS, *[f"{name}_indexed" for name in ml.CATEGORIES])


def assembled_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature vector, one column per position."""
    frame = stage(training_frame(spark, sf), "frame")
    for step in (ml.imputer(), ml.indexer()):
        frame = step.fit(frame).transform(frame)
    vectors = ml.assembler().transform(frame).withColumn("v", vector_to_array("features"))
    return vectors.select(
        *[F.col(name).alias(f"key_{name}") for name in SLOT_KEYS],
        *[F.round(F.col("v")[i], 6).alias(f"f{i:02d}") for i in range(len(ml.FEATURES))],
    )


def rental_predictions(spark: SparkSession, sf: str) -> DataFrame:
    train, test = plans.split_frame(stage(training_frame(spark, sf), "frame"), seed=1)
    fitted = plans.fit_model(plans.rental_stages("keep", seed=1), train)
    scored = plans.plain_predictions(fitted, test)
    finite = F.abs("prediction") < float("inf")
    return scored.select(*SLOT_KEYS, ml.LABEL, F.coalesce(finite, F.lit(False)).alias("is_finite"))


def rental_rmse(spark: SparkSession, sf: str) -> DataFrame:
    train, test = plans.split_frame(stage(training_frame(spark, sf), "frame"), seed=1)
    fitted = plans.fit_model(plans.rental_stages("keep", seed=1), train)
    error = plans.evaluate(fitted, test)
    # One number each: the mean of the training rows, and how well it does alone.
    mean = train.agg(F.avg(ml.LABEL)).first()[0]
    constant = plans.rmse(test.withColumn("prediction", F.lit(mean))).first()[0]
    return error.select(
        F.lit(test.count()).cast("bigint").alias("test_rows"),
        F.round(F.lit(constant), 6).alias("rmse_of_mean"),
        (F.col("rmse") < F.lit(constant)).alias("model_is_better"),
    )


def stand_in_rmse(spark: SparkSession, sf: str) -> DataFrame:
    scored = adapters.stand_in_score(training_frame(spark, sf))
    return plans.rmse(scored).select(F.round("rmse", 6).alias("rmse"))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, save, load, and score the forecast with the model in memory and the loaded one."""
    train = stage(training_frame(spark, sf), "frame")
    path = scratch_path(spark, "model")
    fitted = plans.fit_model(plans.rental_stages("keep", seed=1), train)
    sinks.save_model(fitted, path)
    loaded = sources.read_model(path)
    frame = stage(scoring_frame(spark, sf), "forecast-frame")
    again = plans.plain_predictions(
        loaded, plans.plain_predictions(fitted, frame).withColumnRenamed("prediction", "first")
    )
    return again.select(*SLOT_KEYS, F.col("first").eqNullSafe(F.col("prediction")).alias("is_equal"))


REGISTERED: dict[str, Query] = {
    "usertype_flags": usertype_flags,
    "station_coordinate_groups": station_coordinate_groups,
    "station_profile": station_profile,
    "trips_with_profile": trips_with_profile,
    "station_list": station_list,
    "hour_bucket": hour_buckets,
    "measure_series": measure_series,
    "weather_classified": weather_classified,
    "weather_aligned": weather_aligned,
    "weather_duplicate_hours": weather_duplicate_hours,
    "trips_weather_join": trips_weather_join,
    "unmatched_trips": unmatched_trips,
    "unmatched_summary": unmatched_summary,
    "calendar_features": calendar_features,
    "holiday_calendar": holiday_calendar,
    "modal_weather": modal_weather,
    "target_frame": target_frame,
    "target_frame_single_pass": target_frame_single_pass,
    "training_frame": training_frame,
    "training_frame_repeated_hours": training_frame_repeated_hours,
    "forecast_flatten": forecast_flatten,
    "scoring_grid": scoring_grid,
    "scoring_frame": scoring_frame,
    "prediction_documents": prediction_documents,
    "prediction_messages": prediction_messages,
    "prediction_lookup": prediction_lookup,
    "prediction_stream": prediction_stream,
    "json_roundtrip": json_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "weather_roundtrip": weather_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "calendar_days": calendar_days,
    "station_profile_uneven": station_profile_uneven,
    "training_frame_uneven": training_frame_uneven,
    "hash_split": hash_split,
    "imputed_features": imputed_features,
    "indexed_features": indexed_features,
    "assembled_features": assembled_features,
    "stand_in_rmse": stand_in_rmse,
    "rental_predictions": rental_predictions,
    "rental_rmse": rental_rmse,
    "model_roundtrip": model_roundtrip,
}
