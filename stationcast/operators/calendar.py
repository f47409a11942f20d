"""Holiday calendar and the calendar features of a timestamp."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.functions import easter_sunday, part_of_day, wall_clock, weekday_name

# Holidays of the United States and of Illinois.
# name, month, day, first year, observed on the nearest weekday
FIXED_HOLIDAYS = (
    ("New Year's Day", 1, 1, 1871, True),
    ("Lincoln's Birthday", 2, 12, 1971, False),
    ("Juneteenth", 6, 19, 2021, True),
    ("Independence Day", 7, 4, 1871, True),
    ("Veterans Day", 11, 11, 1978, True),
    ("Christmas Day", 12, 25, 1871, True),
)
# name, month, weekday, week of the month (-1 is the last), days after it, first year,
# every how many years
WEEKDAY_HOLIDAYS = (
    ("Martin Luther King Jr. Day", 1, "MON", 3, 0, 1986, 1),
    ("Presidents' Day", 2, "MON", 3, 0, 1971, 1),
    ("Casimir Pulaski Day", 3, "MON", 1, 0, 1978, 1),
    ("Memorial Day", 5, "MON", -1, 0, 1971, 1),
    ("Labor Day", 9, "MON", 1, 0, 1894, 1),
    ("Columbus Day", 10, "MON", 2, 0, 1971, 1),
    ("Election Day", 11, "MON", 1, 1, 2008, 2),
    ("Thanksgiving", 11, "THU", 4, 0, 1942, 1),
)


@dataclass(frozen=True)
class HolidayRules:
    """The holidays of a region: days of the month, weekdays of a month, and days around Easter.

    The first two are laid out as above, the last as name, days after Easter Sunday (negative:
    before it) and first year.
    """

    fixed: tuple[tuple[str, int, int, int, bool], ...] = ()
    by_weekday: tuple[tuple[str, int, str, int, int, int, int], ...] = ()
    by_easter: tuple[tuple[str, int, int], ...] = ()


ILLINOIS = HolidayRules(FIXED_HOLIDAYS, WEEKDAY_HOLIDAYS)

# The days that are holidays in all of Germany.
GERMANY = HolidayRules(
    fixed=(
        ("Neujahr", 1, 1, 1871, False),
        ("Tag der Arbeit", 5, 1, 1933, False),
        ("Tag der Deutschen Einheit", 10, 3, 1990, False),
        ("Erster Weihnachtstag", 12, 25, 1871, False),
        ("Zweiter Weihnachtstag", 12, 26, 1871, False),
    ),
    by_easter=(
        ("Karfreitag", -2, 1871),
        ("Ostermontag", 1, 1871),
        ("Christi Himmelfahrt", 39, 1871),
        ("Pfingstmontag", 50, 1871),
    ),
)


def _quoted(text: str) -> str:
    return '"' + text + '"'


def _rules(rules: HolidayRules) -> str:
    """The rule rows as an array of structs, in each of which only its own kind of rule is filled."""
    rows = [
        f"({_quoted(name)}, {month}, {day}, NULL, NULL, 0, {since}, 1, {str(observed).lower()}, false)"
        for name, month, day, since, observed in rules.fixed
    ]
    rows += [
        f"({_quoted(name)}, {month}, NULL, '{weekday}', {week}, {after}, {since}, {every}, false, false)"
        for name, month, weekday, week, after, since, every in rules.by_weekday
    ]
    rows += [
        f"({_quoted(name)}, NULL, NULL, NULL, NULL, {after}, {since}, 1, false, true)"
        for name, after, since in rules.by_easter
    ]
    return "array(" + ", ".join(f"struct{row}" for row in rows) + ")"


_RULE_COLUMNS = "(name, month, day, weekday, week, after, since, every, observed, movable)"

_DATE = """
CASE WHEN movable THEN date_add(easter, after)
     WHEN day IS NOT NULL THEN make_date(year, month, day)
     WHEN week < 0 THEN next_day(last_day(make_date(year, month, 1)) - 7, weekday) + after
     ELSE next_day(make_date(year, month, 1) - 1, weekday) + 7 * (week - 1) + after
END
"""

# Saturday is observed on Friday, Sunday on Monday; other days have no second entry.
_ENTRIES = """
inline(array(
  struct(nominal AS date, name AS name),
  struct(CASE WHEN observed AND weekday(nominal) = 5 THEN nominal - 1
              WHEN observed AND weekday(nominal) = 6 THEN nominal + 1 END AS date,
         name || ' (Observed)' AS name)))
"""


def holiday_calendar(
    spark: SparkSession, years: Iterable[int], rules: HolidayRules = ILLINOIS
) -> DataFrame:
    """Holidays of the given years as ``date`` and ``name``, built from ``rules``.

    New Year's Day may be observed in the year before, so one year more is generated
    and dates outside the requested years are left out.
    """
    wanted = sorted({int(year) for year in years})
    if not wanted:
        raise ValueError("holiday_calendar needs at least one year")
    return (
        spark.range(wanted[0], wanted[-1] + 2)
        .selectExpr("CAST(id AS INT) AS year", f"inline({_rules(rules)}) AS {_RULE_COLUMNS}")
        .where("year >= since AND year % every = 0")
        .withColumn("easter", easter_sunday("year"))
        .selectExpr("name", "observed", f"{_DATE} AS nominal")
        .selectExpr(_ENTRIES)
        .where(F.year("date").isin(wanted))
    )


def flag_holidays(
    df: DataFrame, holidays: DataFrame, date: str = "date", out: str = "holiday"
) -> DataFrame:
    """Add ``yes`` where the date is in the calendar, else ``no`` (also for NULL).

    The default calendar is generated from some rows per year and known to be small, so
    the planner broadcasts it.
    """
    days = holidays.select(F.col("date").cast("date").alias("_day")).distinct()
    return (
        df.join(days, F.col(date).try_cast("date") == F.col("_day"), "left")
        .withColumn(out, F.when(F.col("_day").isNotNull(), "yes").otherwise("no"))
        .drop("_day")
    )


def day_features(df: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Add ``holiday``, ``week_days`` and ``month``, which the date alone decides."""
    named = df.withColumns({"week_days": weekday_name(date), "month": F.month(date)})
    return flag_holidays(named, holidays, date)


def calendar_features(df: DataFrame, holidays: DataFrame, ts: str = "starttime") -> DataFrame:
    """Add ``date`` (text), ``holiday``, ``week_days``, ``part_time`` and ``month``.

    All features use the clock time as written, so the session zone has no influence.
    """
    clock = wall_clock(ts)
    dated = df.withColumns({"date": clock.cast("date"), "part_time": part_of_day(clock)})
    return day_features(dated, holidays).withColumn("date", F.col("date").cast("string"))
