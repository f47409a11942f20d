from stationcast.operators.calendar import (
    GERMANY,
    HolidayRules,
    calendar_features,
    day_features,
    flag_holidays,
    holiday_calendar,
)
from stationcast.operators.documents import (
    document_messages,
    lookup_predictions,
    prediction_documents,
)
from stationcast.operators.frequency import most_frequent_per_group
from stationcast.operators.grid import scoring_grid, station_list
from stationcast.operators.joins import grid_join, replicate_join
from stationcast.operators.quality import unmatched_hours, unmatched_summary
from stationcast.operators.stations import (
    attach_profile,
    profile_of_tally,
    station_profile,
    trip_tally,
    usertype_flags,
)
from stationcast.operators.target import join_hourly_weather, modal_weather, target_frame
from stationcast.operators.weather import align_series, classify_weather, weather_vocabulary
from stationcast.operators.ledger import Ledger

__all__ = [
    "GERMANY",
    "HolidayRules",
    "Ledger",
    "align_series",
    "attach_profile",
    "calendar_features",
    "classify_weather",
    "day_features",
    "document_messages",
    "flag_holidays",
    "grid_join",
    "holiday_calendar",
    "join_hourly_weather",
    "lookup_predictions",
    "modal_weather",
    "most_frequent_per_group",
    "prediction_documents",
    "profile_of_tally",
    "replicate_join",
    "scoring_grid",
    "station_list",
    "station_profile",
    "target_frame",
    "trip_tally",
    "unmatched_hours",
    "unmatched_summary",
    "usertype_flags",
    "weather_vocabulary",
]
