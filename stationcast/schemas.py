"""Column lists and schemas shared by the sources, operators and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the tables, of the training frame and of the documents.
STATION_ATTRIBUTES = (
    "latitude",
    "longitude",
    "mean_dpcapacity_start",
    "mean_dpcapacity_end",
    "sum_subscriber",
    "sum_customer",
)
STATION_COLUMNS = ("from_station_id", *STATION_ATTRIBUTES)

MEASURES = ("humidity", "pressure", "temperature", "wind_speed")
# Columns of counted weather beside the hour, the category and the measures.
COUNTED_WEATHER = ("rows", "category_rows")

RAW_TRIP_COLUMNS = (
    "starttime",
    "usertype",
    "from_station_id",
    "latitude_start",
    "longitude_start",
    "dpcapacity_start",
    "dpcapacity_end",
)

# Grain of the demand frame, and the calendar columns its date decides.
SLOT_KEYS = ("date", "from_station_id", "part_time")
CALENDAR_COLUMNS = ("holiday", "week_days", "month")

# Fixed values.
TRAINING_COLUMNS = (
    "date",
    "from_station_id",
    *STATION_ATTRIBUTES,
    "part_time",
    "holiday",
    "week_days",
    "weather_description_mf",
    "month",
    *MEASURES,
    "bicycle_rentals",
)

FORECAST_PAYLOAD = T.StructType(
    [
        T.StructField(
            "list",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("dt_txt", T.StringType()),
                        T.StructField(
                            "main",
                            T.StructType(
                                [
                                    T.StructField("humidity", T.DoubleType()),
                                    T.StructField("pressure", T.DoubleType()),
                                    T.StructField("temp", T.DoubleType()),
                                ]
                            ),
                        ),
                        T.StructField(
                            "weather",
                            T.ArrayType(T.StructType([T.StructField("description", T.StringType())])),
                        ),
                        T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
                    ]
                )
            ),
        )
    ]
)

# Fields of a prediction document.
_DAY_PART = T.StructType(
    [
        T.StructField("part_time", T.StringType()),
        T.StructField("bicycle_rentals", T.IntegerType()),
        T.StructField("weather_description_mf", T.StringType()),
        T.StructField("week_days", T.StringType()),
        T.StructField("holiday", T.StringType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
    ]
)

PREDICTION_DOCUMENT = T.StructType(
    [
        T.StructField("from_station_id", T.IntegerType()),
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField("mean_dpcapacity_start", T.DoubleType()),
        T.StructField("mean_dpcapacity_end", T.DoubleType()),
        T.StructField("sum_subscriber", T.LongType()),
        T.StructField("sum_customer", T.LongType()),
        T.StructField(
            "dates",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("info", T.ArrayType(_DAY_PART)),
                    ]
                )
            ),
        ),
    ]
)


def require_columns(df: DataFrame, columns, what: str) -> DataFrame:
    """Return ``df`` unchanged, or fail early when it lacks one of ``columns``."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")
    return df
