from stationcast.sources.forecast import flatten_forecast, parse_forecast, read_forecast
from stationcast.sources.predictions import (
    parse_documents,
    read_documents,
    read_model,
    read_topic,
)
from stationcast.sources.tables import (
    read_flagged_trips,
    read_measure,
    read_measures,
    read_profile,
    read_stations,
    read_trips,
    read_trips_csv,
    read_weather,
    select_measure,
    trip_columns,
)
from stationcast.sources.keyed import KeyedTable

__all__ = [
    "KeyedTable",
    "flatten_forecast",
    "parse_documents",
    "parse_forecast",
    "read_documents",
    "read_flagged_trips",
    "read_forecast",
    "read_measure",
    "read_measures",
    "read_model",
    "read_profile",
    "read_stations",
    "read_topic",
    "read_trips",
    "read_trips_csv",
    "read_weather",
    "select_measure",
    "trip_columns",
]
