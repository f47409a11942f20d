"""Column expressions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationcast import functions as fn
from tests.fixtures import half_up


def one(spark, expression, **cells):
    names = list(cells) or ["x"]
    values = tuple(cells.values()) or (1,)
    schema = ", ".join(
        f"{n} {'double' if isinstance(v, float) else 'string'}"
        for n, v in zip(names, values, strict=True)
    )
    if not cells:
        schema = "x int"
    return spark.createDataFrame([values], schema).select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "value"), [("15", 15.0), ("1.5", 1.5), ("", None), ("n/a", None), (None, None)]
)
def test_malformed_numbers_become_null(spark, text, value):
    assert one(spark, fn.number("t"), t=text) == value


def test_flag_is_zero_for_null_and_other_values(spark):
    rows = spark.createDataFrame([("Subscriber",), ("subscriber",), (None,)], "u string")
    flags = [r[0] for r in rows.select(fn.membership_flag("u", "Subscriber")).collect()]
    assert flags == [1, 0, 0]


@pytest.mark.parametrize(
    ("hour", "part"),
    [
        (0, "Early Morning"),
        (6, "Early Morning"),
        (7, "Morning"),
        (12, "Morning"),
        (13, "Afternoon"),
        (18, "Afternoon"),
        (19, "Night"),
        (23, "Night"),
    ],
)
def test_part_of_day_limits(spark, hour, part):
    text = f"2016-05-04 {hour:02d}:59:59"
    assert one(spark, fn.part_of_day(fn.wall_clock("t")), t=text) == part


def test_part_of_day_of_null_is_null(spark):
    assert one(spark, fn.part_of_day(fn.wall_clock("t")), t=None) is None


def test_part_of_day_takes_other_limits(spark):
    halves = ((11, "am"), (23, "pm"))
    assert one(spark, fn.part_of_day(fn.wall_clock("t"), halves), t="2016-05-04 12:00:00") == "pm"


@pytest.mark.parametrize(
    ("text", "bucket"),
    [
        ("2016-05-04 09:59:59", "2016-05-04 09:00:00"),
        ("2016-05-04 00:00:00", "2016-05-04 00:00:00"),
        (None, None),
    ],
)
def test_hour_bucket(spark, text, bucket):
    assert one(spark, fn.hour_bucket("t"), t=text) == bucket


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_clock_time_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in Chicago.
        text = "2016-03-13 02:30:00"
        assert one(spark, fn.wall_clock("t"), t=text) == dt.datetime(2016, 3, 13, 2, 30)
        assert one(spark, F.hour(fn.wall_clock("t")), t=text) == 2
        assert one(spark, fn.weekday_name(fn.wall_clock("t")), t=text) == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("value", "digits", "rounded"),
    [
        (0.25, 1, 0.3),
        (0.24999999999999997, 1, 0.3),
        (-0.25, 1, -0.3),
        (2.5, 0, 3.0),
        (1e300, 1, 1e300),
    ],
)
def test_stable_round(spark, value, digits, rounded):
    assert one(spark, fn.stable_round(F.col("v"), digits), v=value) == rounded


@pytest.mark.parametrize("value", [-0.04, -0.4, -1e-9, 0.0, -0.0])
def test_stable_round_has_no_negative_zero(spark, value):
    """As JSON text, because -0.0 equals 0.0."""
    rounded = F.struct(fn.stable_round(F.col("v"), 0).alias("t"))
    assert one(spark, F.to_json(rounded), v=value) == '{"t":0.0}'
    if abs(value) < 0.1:
        assert one(spark, F.to_json(F.struct(fn.stable_round(F.col("v"), 1).alias("t"))), v=value) == '{"t":0.0}'


@pytest.mark.parametrize("value", [1e9 + 0.25, 1e9 - 0.75, 123456789012.35, -5e10 - 0.05])
def test_stable_round_has_one_rule_for_all_sizes(spark, value):
    assert one(spark, fn.stable_round(F.col("v"), 1), v=value) == half_up(value, 1)


def test_stable_round_keeps_nan(spark):
    result = one(spark, fn.stable_round(F.col("v"), 1), v=float("nan"))
    assert result != result


def test_stable_round_equals_decimal_rounding(spark):
    """Halves, values a hair off them, and random ones, of both signs and several sizes."""
    rng = random.Random(1)
    values = [sign * i / 20 for i in range(400) for sign in (1, -1)]
    values += [v * (1 + nudge) for v in values[:200] for nudge in (1e-16, -1e-16, 1e-12, -1e-12)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(0, 7) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1):
        got = df.select("v", fn.stable_round(F.col("v"), digits).alias("r")).collect()
        wrong = [(r["v"], r["r"]) for r in got if r["r"] != half_up(r["v"], digits)]
        assert wrong == []


def test_normalize_value_is_exact(spark):
    rows = spark.createDataFrame([("sky is clear",), ("Sky is clear",), (None,)], "d string")
    got = rows.select(fn.normalize_value("d", {"sky is clear": "clear sky"})).collect()
    assert [r[0] for r in got] == ["clear sky", "Sky is clear", None]


def test_keyed_share_does_not_depend_on_partitioning(spark):
    rows = spark.range(2000).select("id", F.col("id").cast("string").alias("k"))
    share = fn.keyed_share(["id", "k"], seed=3).alias("share")
    a = {r["id"]: r["share"] for r in rows.select("id", share).collect()}
    b = {r["id"]: r["share"] for r in rows.repartition(13).select("id", share).collect()}
    assert a == b
    assert set(a.values()) == set(range(100))
    other = {
        r["id"]: r["s"] for r in rows.select("id", fn.keyed_share(["id", "k"], 4).alias("s")).collect()
    }
    assert a != other
