"""Queries over tables that are stored, added to, and looked up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast import operators as ops
from stationcast import plans, sinks, sources, streaming
from stationcast.catalog import adapters, queries
from stationcast.schemas import SLOT_KEYS
from stationcast.session import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]


def _keyed_documents(spark: SparkSession, sf: str) -> sources.KeyedTable:
    folder = scratch_path(spark, "keyed")
    sinks.write_keyed(queries._documents(spark, sf), folder, "from_station_id", slices=16)
    return sources.KeyedTable(spark, folder)


def lookup_many(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of a table of stations: the customers in debt, by their numbers."""
    wanted = adapters.table(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    return queries._entries(_keyed_documents(spark, sf).lookup(wanted))


def keyed_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Trips by station, a hot one over several slices, and all of them read again."""
    folder = scratch_path(spark, "keyed")
    trips = adapters.uneven_trips(spark, sf)
    sinks.write_keyed(trips, folder, "from_station_id", slices=12)
    return sources.KeyedTable(spark, folder).read()


def keyed_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The trips of the stations that are numbered as a nation is; a third is at one of them."""
    folder = scratch_path(spark, "keyed")
    sinks.write_keyed(adapters.uneven_trips(spark, sf), folder, "from_station_id", slices=12)
    wanted = adapters.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string"))
    return sources.KeyedTable(spark, folder).lookup(wanted)


def _batches(spark: SparkSession, sf: str) -> str:
    """Trips in three batches; the second is first added with other rows, and the third twice."""
    folder = scratch_path(spark, "batches")
    flagged = ops.usertype_flags(adapters.uneven_trips(spark, sf))
    part = F.col("trip_id").cast("bigint") % 3
    for name, number in (("a", 0), ("b", 0), ("c", 2), ("b", 1), ("c", 2)):
        plans.add_batch(flagged.where(part == number), folder, name)
    return folder


def profile_by_batches(spark: SparkSession, sf: str) -> DataFrame:
    return plans.batched_profile(spark, _batches(spark, sf))


def training_frame_by_batches(spark: SparkSession, sf: str) -> DataFrame:
    folder, merged = _batches(spark, sf), scratch_path(spark, "batches")
    plans.compact(spark, folder, merged, "all")
    return plans.batched_training_frame(
        spark, merged, queries._stored_weather(spark, sf), adapters.holidays(spark, sf)
    )


def _counted_weather(spark: SparkSession, sf: str) -> DataFrame:
    return stage(plans.ingest_counted_weather(adapters.repeated_series(spark, sf)), "weather")


def weather_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the counted weather stands for, per hour and category."""
    counted = _counted_weather(spark, sf)
    return counted.select("datetime", "weather_description", "rows")


def weather_expanded(spark: SparkSession, sf: str) -> DataFrame:
    return plans.plain_weather(_counted_weather(spark, sf))


def training_frame_counted_weather(spark: SparkSession, sf: str) -> DataFrame:
    return plans.training_frame_from_trips(
        queries._flagged(spark, sf), _counted_weather(spark, sf), adapters.holidays(spark, sf)
    )


def orders_by_station(spark: SparkSession, sf: str) -> DataFrame:
    """Every station with every day of orders, in a grid of several cells; how they fall together."""
    stations = stage(queries._stations(spark, sf).select("from_station_id").distinct(), "known")
    days = adapters.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    pairs = ops.grid_join(stations, stage(days, "days"), ["from_station_id"], pairs_per_cell=1 << 14)
    same = F.col("from_station_id").try_cast("int") % 31 + 1 == F.dayofmonth("day")
    return pairs.groupBy("from_station_id").agg(
        F.count(F.lit(1)).alias("days"), F.count_if(same).alias("matching"), F.min("day").cast("string").alias("first_day")
    )


def tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The saved trees walked by joins, against the model's own predictions."""
    frame = stage(queries.training_frame(spark, sf), "frame")
    fitted = plans.fit_model(plans.rental_stages("keep", seed=1), frame)
    path = scratch_path(spark, "model")
    sinks.save_model(fitted, path)
    scored = fitted.transform(frame).select(
        *SLOT_KEYS, F.col("prediction").alias("by_model"), vector_to_array("features").alias("features")
    )
    walked = plans.score_by_joins(
        scored, stage(plans.read_trees(spark, path), "trees"), plans.tree_depth(spark, path)
    )
    near = F.abs(F.col("prediction") - F.col("by_model")) <= 1e-9
    return walked.select(*SLOT_KEYS, near.alias("is_equal"))


def bad_values(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger of the scan that stores the trips, as the ingest job makes it."""
    ledger = ops.Ledger()
    stage(ops.usertype_flags(ledger.watch(adapters.uneven_trips(spark, sf))), "trips")
    return ledger.rows(spark)


def latest_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of documents in files out of order, one of them twice, and a drain in between."""
    documents = stage(queries._documents(spark, sf), "documents")
    folder, table, progress = (scratch_path(spark, n) for n in ("messages", "latest", "progress"))
    station = F.col("from_station_id")
    runs = {
        3: documents.where(station % 2 == 0),
        1: documents.withColumn("sum_customer", F.lit(-1).cast("long")),
        2: documents.withColumn("sum_customer", F.col("sum_customer") + 1).where(station % 5 != 0),
    }
    for number, run in enumerate((3, 1, 2, 1)):
        streaming.run_messages(runs[run], run).write.text(f"{folder}/{number}")
        if number:
            messages = streaming.stream_messages(spark, f"{folder}/*", max_files=3)
            changes = streaming.drain(streaming.newer_documents(messages), table, progress)
    return streaming.latest_documents(changes).select("from_station_id", "sum_customer", "run")


def calendar_days_movable(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar features of almost forty years in a region with movable feasts."""
    days = adapters.calendar_days(spark, sf)
    return ops.calendar_features(days, ops.holiday_calendar(spark, range(1994, 2036), ops.GERMANY))


STORED: dict[str, Query] = {
    "lookup_many": lookup_many,
    "keyed_roundtrip": keyed_roundtrip,
    "keyed_trips": keyed_trips,
    "profile_by_batches": profile_by_batches,
    "training_frame_by_batches": training_frame_by_batches,
    "weather_counted": weather_counted,
    "weather_expanded": weather_expanded,
    "training_frame_counted_weather": training_frame_counted_weather,
    "orders_by_station": orders_by_station,
    "tree_scores": tree_scores,
    "bad_values": bad_values,
    "latest_documents": latest_documents,
    "calendar_days_movable": calendar_days_movable,
}
