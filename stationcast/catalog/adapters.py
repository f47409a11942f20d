"""Shape the test tables into trips, measure series and forecast payloads.

Everything is derived from the whole ``events`` table, so it grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.operators import holiday_calendar
from stationcast.session import stage
from stationcast.sources import select_measure

CITY = "Chicago"
OTHER_CITY = "Elsewhere"

# Descriptions of the derived series, by hour number modulo their count.
DESCRIPTIONS = (
    "thunderstorm with rain",
    "drizzle",
    "light rain",
    "heavy snow",
    "mist",
    "clear sky",
    "few clouds",
    "sky is clear",
    "MODERATE RAIN",
    "HEAVY THUNDERSTORM",
    "Ash volcanic ash",
    "plague of frogs",
    None,
)

FORECAST_SHIFT_HOURS = 31 * 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event, all columns as text."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.col("ts").cast("string").substr(1, 19).alias("starttime"),
        F.when(kind.isin("purchase", "signup"), "Subscriber")
        .when(kind.isin("view", "click"), "Customer")
        .otherwise("Dependent")
        .alias("usertype"),
        F.col("user_id").cast("string").alias("from_station_id"),
        F.concat(F.lit("41."), (800 + F.col("event_id") % 3).cast("string")).alias("latitude_start"),
        F.concat(F.lit("-87."), (600 + F.col("event_id") % 3).cast("string")).alias(
            "longitude_start"
        ),
        (11 + 4 * (F.col("event_id") % 4)).cast("string").alias("dpcapacity_start"),
        (11 + 4 * (F.col("event_id") % 5)).cast("string").alias("dpcapacity_end"),
    )


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct hours of the events, numbered from 1970 on.

    All series are read from it, so it is stored: one pass over the events, not five.
    """
    hours = (
        table(spark, sf_dir, "events")
        .select(F.col("ts").cast("date").alias("day"), F.hour("ts").alias("hour"))
        .distinct()
    )
    days = F.date_diff("day", F.lit("1970-01-01").cast("date"))
    return stage(hours.select((days * 24 + F.col("hour")).alias("k")), "hours")


def _hour_text(number: Column) -> Column:
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(number / 24).cast("int"))
    hour = F.lpad((number % 24).cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit(" "), hour, F.lit(":00:00"))


def _description(number: Column) -> Column:
    texts = F.array(*[F.lit(text).cast("string") for text in DESCRIPTIONS])
    return F.get(texts, (number % len(DESCRIPTIONS)).cast("int"))


def _readings(number: Column) -> dict[str, Column]:
    return {
        "humidity": 40 + (7 * number) % 60,
        "pressure": F.when(number % 17 != 0, 1000 + number % 30),
        "temperature": number % 40 - 20,
        "wind_speed": number % 15,
        "weather_description": _description(number),
    }


def measure_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Five series by hour, each with two cities, all columns as text."""
    hours = _hours(spark, sf_dir)
    tables = {}
    for name, reading in _readings(F.col("k")).items():
        source = hours.where(F.col("k") % 50 != 0) if name == "wind_speed" else hours
        tables[name] = source.select(
            _hour_text(F.col("k")).alias("datetime"),
            F.lit("0").alias(OTHER_CITY),
            reading.cast("string").alias(CITY),
        )
    return tables


def measure_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: select_measure(df, CITY, name) for name, df in measure_tables(spark, sf_dir).items()
    }


def repeated_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The series, with humidity and pressure twice for odd hours, the second one higher."""
    series = measure_series(spark, sf_dir)
    odd = F.substring("datetime", 12, 2).cast("int") % 2
    for name in ("humidity", "pressure"):
        copies = series[name].withColumn("copy", F.explode(F.sequence(F.lit(0), odd)))
        shifted = (F.col(name).cast("int") + 10 * F.col("copy")).cast("string")
        series[name] = copies.select("datetime", shifted.alias(name))
    return series


def forecast_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per day, its readings three hours apart, a month after the events."""
    number = F.floor(F.col("k") / 3).cast("int") * 3 + FORECAST_SHIFT_HOURS
    slots = _hours(spark, sf_dir).select(number.alias("k")).distinct()
    reading = _readings(F.col("k"))
    item = F.struct(
        _hour_text(F.col("k")).alias("dt_txt"),
        F.struct(
            reading["humidity"].alias("humidity"),
            reading["pressure"].alias("pressure"),
            reading["temperature"].alias("temp"),
        ).alias("main"),
        F.array(
            F.struct(reading["weather_description"].alias("description")),
            F.struct(F.lit("second entry").alias("description")),
        ).alias("weather"),
        F.struct(reading["wind_speed"].alias("speed")).alias("wind"),
    )
    return (
        slots.select(F.floor(F.col("k") / 24).alias("day"), item.alias("item"))
        .groupBy("day")
        .agg(F.collect_list("item").alias("list"))
        .select(F.to_json(F.struct("list")).alias("value"))
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays of all years of events and orders, and of the next for the forecast."""
    dates = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"))
    dates = dates.union(table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date")))
    # Two numbers of one row.
    first, last = dates.agg(F.min(F.year("day")), F.max(F.year("day"))).first()
    return holiday_calendar(spark, range(first or 2000, (last or 2000) + 2))


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of all orders, and the same 8, 16, 24 and 32 years later, at each hour once.

    Order dates cover seven years, so the days reach from 1995 to 2033.
    """
    day = F.col("o_orderdate").cast("date")
    moved = F.add_months(day, F.col("years") * 12)
    text = F.concat(
        moved.cast("string"),
        F.lit(" "),
        F.lpad(F.pmod("o_orderkey", F.lit(24)).cast("string"), 2, "0"),
        F.lit(":30:00"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shifted = orders.withColumn("years", F.explode(F.array(*[F.lit(8 * k) for k in range(5)])))
    return shifted.select(text.alias("starttime")).distinct()


def uneven_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with a third at one station, some without one, and unreadable numbers."""
    number = F.col("trip_id").cast("bigint")
    station = F.when(number % 17 == 0, F.lit(None)).when(number % 3 == 0, F.lit("1"))
    return raw_trips(spark, sf_dir).withColumns(
        {
            "from_station_id": station.when(number % 19 == 0, F.lit("depot")).otherwise(
                F.col("from_station_id")
            ),
            "dpcapacity_start": F.when(number % 7 == 0, F.lit("n/a"))
            .when(number % 11 == 0, F.lit(""))
            .otherwise(F.col("dpcapacity_start")),
            "starttime": F.when(number % 23 == 0, F.lit("no time")).otherwise(F.col("starttime")),
        }
    )


def stand_in_score(df: DataFrame) -> DataFrame:
    """A fixed formula in place of a fitted model, with negative and fractional values."""
    value = (
        F.col("temperature") * 0.25
        + F.col("wind_speed") * 0.5
        - F.col("humidity") * 0.125
        + F.col("mean_dpcapacity_start") * 0.25
    )
    return df.withColumn("prediction", value)
