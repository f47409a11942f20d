"""Column expressions. All are built-in Spark functions and stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last hour of each part of the day, and its label.
PARTS_OF_DAY = (
    (6, "Early Morning"),
    (12, "Morning"),
    (18, "Afternoon"),
    (23, "Night"),
)

# Weekday names, from the first day of the week on.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def number(column: str | Column, kind: str = "double") -> Column:
    """Numeric value of a text column; malformed text gives NULL, also under ANSI."""
    return _col(column).try_cast(kind)


def wall_clock(column: str | Column) -> Column:
    """Zone-free timestamp: the clock time stays as written in every session zone."""
    return _col(column).try_cast("timestamp_ntz")


def membership_flag(column: str | Column, *values: str) -> Column:
    """1 where the column holds one of ``values``, else 0 (also for NULL)."""
    return F.coalesce(_col(column).isin(*values).cast("int"), F.lit(0))


def normalize_value(column: str | Column, mapping: dict[str, str]) -> Column:
    """Replace exact values by their preferred spelling and keep all others."""
    result = _col(column)
    for old, new in mapping.items():
        result = F.when(_col(column) == old, new).otherwise(result)
    return result


def hour_bucket(column: str | Column) -> Column:
    """Text key of the full hour: the first 13 characters, then minutes and seconds at zero."""
    return F.concat(_col(column).cast("string").substr(1, 13), F.lit(":00:00"))


def part_of_hour(
    hour: str | Column, parts: Sequence[tuple[int, str]] = PARTS_OF_DAY
) -> Column:
    """Label of the first part whose last hour is not before the given hour."""
    hour = _col(hour)
    ordered = sorted(parts)
    label = F.when(hour <= ordered[0][0], ordered[0][1])
    for last_hour, name in ordered[1:]:
        label = label.when(hour <= last_hour, name)
    return label


def part_of_day(column: str | Column, parts: Sequence[tuple[int, str]] = PARTS_OF_DAY) -> Column:
    """Part of the day of a timestamp."""
    return part_of_hour(F.hour(_col(column)), parts)


def weekday_name(column: str | Column) -> Column:
    """English name of the weekday, without a formatter run per row."""
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), F.dayofweek(_col(column)) - 1)


def stable_round(value: Column, digits: int) -> Column:
    """Round half away from zero, independent of the order a floating sum was added in.

    Summation order moves the last bits of a mean; at an exact half that would flip the
    rounded digit from run to run. So the value is rounded to millionths first, and those
    to ``digits``, both as decimals: one rule for values of any size. A result of zero has
    no sign; NaN and infinities stay.
    """
    return F.round(F.round(value.cast("double"), 6), digits)


def keyed_share(columns: Sequence[str], seed: int = 0) -> Column:
    """Whole number from 0 to 99 that depends on the key values and the seed only.

    A row keeps its number under any partitioning, retry or engine, so a split made
    with it never moves rows between its parts.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def easter_sunday(year: str | Column) -> Column:
    """Date of Easter Sunday of a Gregorian year, by whole-number arithmetic on the column."""

    def whole(value: Column, by: int) -> Column:
        return F.floor(value / by).cast("int")

    year = _col(year).cast("int")
    century, golden = whole(year, 100), year % 19
    # Age of the moon at the turn of the year, from the lunar cycle and two century corrections.
    age = (19 * golden + century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3) + 15) % 30
    # Days from the full moon to the Sunday after it.
    wait = (32 + 2 * (century % 4) + 2 * whole(year % 100, 4) - age - year % 100 % 4) % 7
    late = whole(golden + 11 * age + 22 * wait, 451)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), age + wait - 7 * late)
