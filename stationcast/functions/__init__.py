from stationcast.functions.columns import (
    easter_sunday,
    hour_bucket,
    keyed_share,
    membership_flag,
    normalize_value,
    number,
    part_of_day,
    part_of_hour,
    stable_round,
    wall_clock,
    weekday_name,
)

__all__ = [
    "easter_sunday",
    "hour_bucket",
    "keyed_share",
    "membership_flag",
    "normalize_value",
    "number",
    "part_of_day",
    "part_of_hour",
    "stable_round",
    "wall_clock",
    "weekday_name",
]
