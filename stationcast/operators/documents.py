"""Nested prediction documents and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.schemas import STATION_COLUMNS


def whole_rentals(prediction: str | Column = "prediction") -> Column:
    """The prediction without its fraction, cut toward zero; NULL if it is not a number."""
    column = F.col(prediction) if isinstance(prediction, str) else prediction
    return column.try_cast("int")


def prediction_documents(predictions: DataFrame) -> DataFrame:
    """One document per station: its dates, and the parts of the day of each date.

    Rows are dealt by station once, which serves both levels of nesting. A document has
    at most four entries per forecast date, and lists are sorted by date and part.
    """
    entry = F.struct(
        "part_time",
        whole_rentals().alias("bicycle_rentals"),
        "weather_description_mf",
        "week_days",
        "holiday",
        "humidity",
        "pressure",
        "temperature",
        "wind_speed",
    )
    by_date = (
        predictions.repartition(*STATION_COLUMNS)
        .groupBy(*STATION_COLUMNS, "date")
        .agg(F.array_sort(F.collect_list(entry)).alias("info"))
    )
    return by_date.groupBy(*STATION_COLUMNS).agg(
        F.array_sort(F.collect_list(F.struct("date", "info"))).alias("dates")
    )


def document_messages(documents: DataFrame, ignore_null_fields: bool = True) -> DataFrame:
    """Each row as one JSON text in ``value``; NULL fields are left out by default."""
    options = {"ignoreNullFields": str(ignore_null_fields).lower()}
    return documents.select(F.to_json(F.struct("*"), options).alias("value"))


def lookup_predictions(documents: DataFrame, station: int | str | None = None) -> DataFrame:
    """All documents as JSON, or those of one station."""
    if station is not None:
        documents = documents.where(F.col("from_station_id") == F.lit(int(station)))
    return document_messages(documents)
