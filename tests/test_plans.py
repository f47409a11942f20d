"""Training and scoring plans against plain loops and against the row-level operators."""

import datetime as dt
import json
import random
from unittest import mock

import pytest
from pyspark.sql import functions as F

from stationcast import operators as ops
from stationcast import plans, sources
from stationcast.plans import features
from stationcast.schemas import MEASURES, STATION_COLUMNS
from tests.fixtures import (
    TRIP_SCHEMA,
    WEATHER_SCHEMA,
    brute_training,
    hourly_weather,
    skewed_trips,
    trip,
)


@pytest.fixture(scope="module")
def holidays(spark):
    return ops.holiday_calendar(spark, range(2013, 2020))


def weather_frame(spark, rows):
    return spark.createDataFrame(rows, WEATHER_SCHEMA)


def raw_frame(spark, rows):
    return ops.usertype_flags(spark.createDataFrame(rows, TRIP_SCHEMA))


def slots(frame):
    return {
        (r["date"], r["from_station_id"], r["part_time"]): (
            r["bicycle_rentals"],
            r["weather_description_mf"],
            tuple(r[m] for m in MEASURES),
            r["holiday"],
            r["week_days"],
            r["month"],
        )
        for r in frame.collect()
    }


def as_text(frame):
    names = sorted(frame.columns)
    return sorted(str(tuple(r[n] for n in names)) for r in frame.collect())


@pytest.mark.parametrize("repeat", [(), range(60, 200, 3)], ids=["unique hours", "repeated hours"])
def test_training_frame_equals_loops(spark, holidays, repeat):
    """A third of the trips at one station, half of those in one hour."""
    trips, weather = skewed_trips(), hourly_weather(repeat=repeat)
    raw = raw_frame(spark, trips).repartition(5)
    frame = plans.training_frame(
        raw, weather_frame(spark, weather), holidays, profile=ops.station_profile(raw)
    )
    expected = brute_training(trips, weather, {dt.date(2016, 7, 4)})
    got = slots(frame)
    assert frame.count() == len(got)
    assert got == expected


@pytest.mark.parametrize("repeat", [(), range(0, 240, 5)], ids=["unique hours", "repeated hours"])
def test_row_level_operators_give_the_same_frame(spark, holidays, repeat):
    raw = raw_frame(spark, skewed_trips(seed=9))
    weather = weather_frame(spark, hourly_weather(seed=10, repeat=repeat))
    ingested = plans.ingest_trips(raw.drop("subscriber", "customer"))
    detail = ops.calendar_features(
        ops.join_hourly_weather(sources.trip_columns(ingested), weather), holidays
    )
    by_rows = ops.target_frame(detail, ops.modal_weather(detail))
    by_plan = plans.training_frame(ingested, weather, holidays)
    assert by_rows.columns == by_plan.columns
    assert as_text(by_rows) == as_text(by_plan)


def test_series_tally_equals_the_tally_of_the_aligned_rows(spark):
    """Hours repeated in several series, missing from one, with NULL and no time."""
    rng = random.Random(3)

    def rows(values, missing):
        return [
            (f"2016-07-01 {h:02d}:00:00" if h < 23 else None, rng.choice(values))
            for h in range(24)
            if h != missing
            for _ in range(rng.randint(1, 3) if h != 5 else 9)
        ]

    kinds = ["sky is clear", "mist", "LIGHT RAIN", None]
    series = {
        name: spark.createDataFrame(rows(values, i), f"datetime string, {name} string")
        for i, (name, values) in enumerate(
            {**{m: ["1", "4", "n/a", None] for m in MEASURES}, "weather_description": kinds}.items()
        )
    }
    by_rows = plans.weather_tally(plans.ingest_weather(series))
    assert by_rows.agg(F.max("readings")).first()[0] > 1000
    assert as_text(plans.series_tally(series)) == as_text(by_rows)


def test_rentals_add_up_to_the_joined_trips(spark, holidays):
    ingested = plans.ingest_trips(spark.createDataFrame(skewed_trips(), TRIP_SCHEMA))
    weather = weather_frame(spark, hourly_weather())
    joined = ops.join_hourly_weather(sources.trip_columns(ingested), weather)
    frame = plans.training_frame(ingested, weather, holidays)
    assert frame.agg(F.sum("bicycle_rentals")).first()[0] == joined.count()


def test_unusable_rows_reach_no_group(spark, holidays):
    """No station, a station that is no number, an unreadable time: as in the row-level join.

    The hour without minutes is readable and its text key meets the second weather row.
    """
    rows = [
        trip("2016-07-04 10:00:00"),
        trip("2016-07-04 10:00:00", station=None),
        trip("2016-07-04 10:00:00", station="x"),
        trip("2016-07-04 10:99:00"),
        trip("2016-07-04 1", station="1"),
        trip(None),
    ]
    weather = weather_frame(
        spark, [("2016-07-04 10:00:00", "50", "1000", "290", "Clear", "1"),
                ("2016-07-04 1:00:00", "50", "1000", "290", "Clear", "1")]
    )
    ingested = plans.ingest_trips(spark.createDataFrame(rows, TRIP_SCHEMA))
    detail = ops.calendar_features(
        ops.join_hourly_weather(sources.trip_columns(ingested), weather), holidays
    )
    by_rows = ops.target_frame(detail, ops.modal_weather(detail))
    by_plan = plans.training_frame(ingested, weather, holidays)
    assert as_text(by_rows) == as_text(by_plan)
    got = {r["part_time"]: r["bicycle_rentals"] for r in by_plan.collect()}
    assert got == {"Morning": 1, "Early Morning": 1}


def test_stations_that_are_the_same_number_share_the_modal_weather(spark, holidays):
    """'7' and '007' keep their own rows, and vote together on the weather."""
    rows = [trip(f"2016-07-04 0{h}:10:00", station="7", lat="41.8") for h in (0, 1, 2)]
    rows += [trip(f"2016-07-04 0{h}:10:00", station="007", lat="41.9") for h in (3, 4, 4, 4)]
    weather = weather_frame(
        spark,
        [
            (f"2016-07-04 0{h}:00:00", "50", "1000", "290", kind, "1")
            for h, kind in enumerate(["Rain", "Rain", "Snow", "Snow", "Clear"])
        ],
    )
    ingested = plans.ingest_trips(spark.createDataFrame(rows, TRIP_SCHEMA))
    detail = ops.calendar_features(
        ops.join_hourly_weather(sources.trip_columns(ingested), weather), holidays
    )
    by_rows = ops.target_frame(detail, ops.modal_weather(detail))
    by_plan = plans.training_frame(ingested, weather, holidays)
    assert as_text(by_rows) == as_text(by_plan)
    got = {r["latitude"]: (r["weather_description_mf"], r["bicycle_rentals"]) for r in by_plan.collect()}
    assert got == {"41.8": ("Clear", 3), "41.9": ("Clear", 4)}


def test_trips_are_counted_before_they_are_joined(spark, holidays):
    """The scan feeds a partial count; no join or exchange sees single trips."""
    raw = raw_frame(spark, skewed_trips())
    frame = plans.training_frame(
        raw, weather_frame(spark, hourly_weather()), holidays, ops.station_profile(raw)
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    first_join = plan.index("Join Inner")
    assert "Aggregate [from_station_id" in plan[first_join:]
    assert "CartesianProduct" not in frame._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in frame._jdf.queryExecution().executedPlan().toString()


# Scoring ---------------------------------------------------------------------------

FORECAST_SCHEMA = (
    "datetime string, humidity double, pressure double, temperature double, "
    "weather_description string, wind_speed double"
)


def forecast_rows():
    rows = []
    for i in range(40):
        when = dt.datetime(2019, 7, 3) + dt.timedelta(hours=3 * i)
        text = ["light rain", "sky is clear", "clear sky", "Snow", None][i % 5]
        pressure = None if when.hour == 21 else 1000.0 + i
        rows.append((when.strftime("%Y-%m-%d %H:%M:%S"), 50.0 + i, pressure, 290.5, text, 1.0))
    return rows


def stations_frame(spark):
    rows = [(str(s), f"41.{s}", "-87.6", 15.0, 11.0, 3 * s, s) for s in range(1, 12)]
    rows += rows[:4]  # stations come from trips, so they repeat
    rows += [("x", "41.0", "-87.0", 15.0, 11.0, 1, 1), (None, "41.0", "-87.0", 15.0, 11.0, 1, 1)]
    return spark.createDataFrame(
        rows,
        "from_station_id string, latitude string, longitude string, mean_dpcapacity_start double, "
        "mean_dpcapacity_end double, sum_subscriber bigint, sum_customer bigint",
    )


@pytest.mark.parametrize(
    "extra",
    [
        [],
        [("2019-07-03 00:00", 90.0, 1.0, 1.0, "snow", 9.0)],  # same moment, other spelling
        [("2019-07-03 00:00:00", 90.0, 1.0, 1.0, "snow", 9.0)],  # same time twice
        [(None, 90.0, 1.0, 1.0, "snow", 9.0), ("bad", 90.0, 1.0, 1.0, "snow", 9.0)],
    ],
    ids=["plain", "spelling", "repeated", "unreadable"],
)
def test_scoring_frame_equals_row_level_grid(spark, holidays, extra):
    forecast = spark.createDataFrame(forecast_rows() + extra, FORECAST_SCHEMA)
    stations = stations_frame(spark)
    grid = ops.scoring_grid(ops.station_list(stations), ops.classify_weather(forecast))
    detail = ops.calendar_features(
        grid.drop("weather_description").withColumnRenamed(
            "weather_condition", "weather_description"
        ),
        holidays,
    )
    by_rows = ops.target_frame(detail, ops.modal_weather(detail)).drop("bicycle_rentals")
    by_plan = plans.scoring_frame(stations, forecast, holidays)
    assert by_rows.columns == by_plan.columns
    assert as_text(by_rows) == as_text(by_plan)


def test_grid_has_every_station_with_every_reading(spark):
    forecast = spark.createDataFrame(forecast_rows(), FORECAST_SCHEMA)
    grid = ops.scoring_grid(ops.station_list(stations_frame(spark)), forecast)
    assert grid.count() == 13 * 40
    assert grid.where("starttime <> cast(datetime AS timestamp_ntz)").count() == 0


def test_historic_spelling_is_not_normalized_for_forecasts(spark, holidays):
    rows = [("2019-07-03 00:00:00", 1.0, 1.0, 1.0, "sky is clear", 1.0)]
    frame = plans.scoring_frame(
        stations_frame(spark), spark.createDataFrame(rows, FORECAST_SCHEMA), holidays
    )
    assert {r["weather_description_mf"] for r in frame.collect()} == {"Clouds"}


def payload(items):
    return json.dumps({"cod": "200", "list": items})


def test_forecast_file_takes_the_first_weather_entry(spark, tmp_path):
    item = {
        "dt": 1,
        "dt_txt": "2019-07-03 00:00:00",
        "main": {"temp": 290, "pressure": 1001.5, "humidity": 50},
        "weather": [{"description": "mist"}, {"description": "snow"}],
        "wind": {"speed": 2},
    }
    empty = {**item, "weather": [], "main": {"temp": 1.5}}
    (tmp_path / "payload.json").write_text(json.dumps({"list": [item, empty]}, indent=2))
    rows = sources.read_forecast(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [
        ("2019-07-03 00:00:00", 50.0, 1001.5, 290.0, "mist", 2.0),
        ("2019-07-03 00:00:00", None, None, 1.5, None, 2.0),
    ]
    texts = spark.createDataFrame([(payload([item]),), (payload([]),)], "value string")
    assert sources.parse_forecast(texts).count() == 1


def scans(df):
    """Reads of files in the plan."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_trips_are_read_once(spark, holidays, tmp_path):
    """The tally is the only pass over the trips; the target reads its detail once."""
    spark.createDataFrame(skewed_trips(300), TRIP_SCHEMA).write.parquet(str(tmp_path / "trips"))
    flagged = ops.usertype_flags(spark.read.parquet(str(tmp_path / "trips")))
    weather = spark.createDataFrame(hourly_weather(), WEATHER_SCHEMA)
    assert scans(ops.trip_tally(flagged)) == 1
    with mock.patch.object(features, "stage", wraps=features.stage) as staged:
        frame = plans.training_frame_from_trips(flagged, weather, holidays)
    assert staged.call_count == 1
    assert all("/trips/" not in path for path in frame.inputFiles())
    old = plans.training_frame(flagged, weather, holidays, profile=ops.station_profile(flagged))
    assert as_text(frame) == as_text(old)

    wide = ops.join_hourly_weather(sources.trip_columns(plans.ingest_trips(flagged)), weather)
    detail = ops.calendar_features(wide, holidays)
    assert scans(ops.target_frame(detail)) == scans(detail)
    assert as_text(ops.target_frame(detail)) == as_text(
        ops.target_frame(detail, ops.modal_weather(detail))
    )


def test_station_columns_are_what_the_trip_table_offers(spark):
    ingested = plans.ingest_trips(spark.createDataFrame(skewed_trips(300), TRIP_SCHEMA))
    assert sources.trip_columns(ingested).columns == ["starttime", *STATION_COLUMNS, "starttime_join"]
    assert ops.station_list(ingested).count() == ingested.select("station").distinct().count()
