"""DuckDB SQL for the registered queries.

The SQL spells out the row-by-row meaning (join the detail, then group) and not the
reduced plans, so that it checks them.
"""

from __future__ import annotations

from stationcast.catalog.adapters import FORECAST_SHIFT_HOURS
from stationcast.catalog.queries import LOOKUP_STATION
from stationcast.schemas import MEASURES, STATION_COLUMNS


# The categories, written out again so that they check the library's lookup table.
_CATEGORY = """CASE
        WHEN {text} IN (
             'thunderstorm with light rain',
             'thunderstorm with rain',
             'thunderstorm with heavy rain',
             'light thunderstorm',
             'thunderstorm',
             'heavy thunderstorm',
             'ragged thunderstorm',
             'thunderstorm with light drizzle',
             'thunderstorm with drizzle',
             'thunderstorm with heavy drizzle',
             'proximity thunderstorm with rain',
             'proximity thunderstorm with drizzle',
             'proximity thunderstorm') THEN 'Thunderstorm'
        WHEN lower({text}) IN (
             'light intensity drizzle',
             'drizzle',
             'heavy intensity drizzle',
             'light intensity drizzle rain',
             'drizzle rain',
             'heavy intensity drizzle rain',
             'shower rain and drizzle',
             'heavy shower rain and drizzle',
             'shower drizzle') THEN 'Drizzle'
        WHEN lower({text}) IN (
             'light rain',
             'moderate rain',
             'heavy intensity rain',
             'very heavy rain',
             'extreme rain',
             'freezing rain',
             'light intensity shower rain',
             'shower rain',
             'heavy intensity shower rain',
             'ragged shower rain',
             'proximity shower rain') THEN 'Rain'
        WHEN lower({text}) IN (
             'light snow',
             'snow',
             'heavy snow',
             'sleet',
             'light shower sleet',
             'shower sleet',
             'light rain and snow',
             'rain and snow',
             'light shower snow',
             'shower snow',
             'heavy shower snow') THEN 'Snow'
        WHEN lower({text}) IN (
             'mist',
             'smoke',
             'haze',
             'sand/ dust whirls',
             'fog',
             'sand',
             'dust',
             'Ash volcanic ash',
             'squalls',
             'tornado') THEN 'Atmosphere'
        WHEN lower({text}) = 'clear sky' THEN 'Clear'
        ELSE 'Clouds' END"""


def _category(column: str) -> str:
    return _CATEGORY.format(text=column)


def _mean(column: str) -> str:
    return f"CAST(round(CAST(avg({column}) AS DECIMAL(20,6)), 1) AS DOUBLE)"


# The derived descriptions, by hour number modulo 13.
_DESCRIPTIONS = """['thunderstorm with rain', 'drizzle', 'light rain', 'heavy snow', 'mist',
    'clear sky', 'few clouds', 'sky is clear', 'MODERATE RAIN', 'HEAVY THUNDERSTORM',
    'Ash volcanic ash', 'plague of frogs', NULL]"""


def _description(k: str) -> str:
    return f"({_DESCRIPTIONS})[({k}) % 13 + 1]"


def _hour_text(k: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_hours({k}), '%Y-%m-%d %H:%M:%S')"


_K = "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 24 + hour(ts)"

TRIPS = """
trips AS (
  SELECT CAST(event_id AS VARCHAR) AS trip_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS starttime,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'Subscriber'
              WHEN event_type IN ('view', 'click') THEN 'Customer'
              ELSE 'Dependent' END AS usertype,
         CAST(user_id AS VARCHAR) AS from_station_id,
         '41.' || CAST(800 + event_id % 3 AS VARCHAR) AS latitude_start,
         '-87.' || CAST(600 + event_id % 3 AS VARCHAR) AS longitude_start,
         CAST(11 + 4 * (event_id % 4) AS VARCHAR) AS dpcapacity_start,
         CAST(11 + 4 * (event_id % 5) AS VARCHAR) AS dpcapacity_end
  FROM events),
flagged AS (
  SELECT *, CASE WHEN usertype = 'Subscriber' THEN 1 ELSE 0 END AS subscriber,
            CASE WHEN usertype = 'Customer' THEN 1 ELSE 0 END AS customer
  FROM trips)"""

PROFILE = TRIPS + """,
coordinate_groups AS (
  SELECT from_station_id, latitude_start, longitude_start,
         count(from_station_id) AS "count",
         round(avg(TRY_CAST(dpcapacity_start AS DOUBLE))) AS mean_dpcapacity_start,
         round(avg(TRY_CAST(dpcapacity_end AS DOUBLE))) AS mean_dpcapacity_end,
         CAST(sum(subscriber) AS BIGINT) AS sum_subscriber,
         CAST(sum(customer) AS BIGINT) AS sum_customer
  FROM flagged GROUP BY 1, 2, 3),
profile AS (
  SELECT from_station_id AS station, latitude_start AS latitude, longitude_start AS longitude,
         "count", mean_dpcapacity_start, mean_dpcapacity_end, sum_subscriber, sum_customer, rank
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY from_station_id
               ORDER BY "count" DESC, latitude_start, longitude_start) AS INTEGER) AS rank
        FROM coordinate_groups)
  WHERE rank = 1),
ingested AS (SELECT f.*, p.* FROM flagged f JOIN profile p ON f.from_station_id = p.station),
trip_columns AS (
  SELECT starttime, from_station_id, latitude, longitude, mean_dpcapacity_start,
         mean_dpcapacity_end, sum_subscriber, sum_customer,
         substr(starttime, 1, 13) || ':00:00' AS starttime_join
  FROM ingested)"""

# A third of the trips at one station, some without one, unreadable numbers and times.
UNEVEN = TRIPS.replace("trips AS (", "even_trips AS (", 1).replace(
    "flagged AS (",
    """trips AS (
  SELECT trip_id, usertype, latitude_start, longitude_start, dpcapacity_end,
         CASE WHEN n % 23 = 0 THEN 'no time' ELSE starttime END AS starttime,
         CASE WHEN n % 17 = 0 THEN NULL WHEN n % 3 = 0 THEN '1' WHEN n % 19 = 0 THEN 'depot'
              ELSE from_station_id END AS from_station_id,
         CASE WHEN n % 7 = 0 THEN 'n/a' WHEN n % 11 = 0 THEN '' ELSE dpcapacity_start END
              AS dpcapacity_start
  FROM (SELECT *, CAST(trip_id AS BIGINT) AS n FROM even_trips)),
flagged AS (""",
    1,
)
UNEVEN_PROFILE = PROFILE.replace(TRIPS, UNEVEN)

SERIES = f"""
hours AS (SELECT DISTINCT {_K} AS k FROM events),
humidity AS (SELECT {_hour_text('k')} AS datetime, CAST(40 + (7 * k) % 60 AS VARCHAR) AS humidity
             FROM hours),
pressure AS (SELECT {_hour_text('k')} AS datetime,
                    CASE WHEN k % 17 <> 0 THEN CAST(1000 + k % 30 AS VARCHAR) END AS pressure
             FROM hours),
temperature AS (SELECT {_hour_text('k')} AS datetime, CAST(k % 40 - 20 AS VARCHAR) AS temperature
                FROM hours),
wind_speed AS (SELECT {_hour_text('k')} AS datetime, CAST(k % 15 AS VARCHAR) AS wind_speed
               FROM hours WHERE k % 50 <> 0),
weather_description AS (SELECT {_hour_text('k')} AS datetime,
                               {_description('k')} AS weather_description
                        FROM hours)"""



def _twice(name: str) -> str:
    """Odd hours once more, ten higher."""
    return f"""{name} AS (
  SELECT datetime, {name} FROM {name}_once
  UNION ALL
  SELECT datetime, CAST(CAST({name} AS INTEGER) + 10 AS VARCHAR) FROM {name}_once
  WHERE CAST(substr(datetime, 12, 2) AS INTEGER) % 2 = 1)"""


REPEATED_SERIES = (
    SERIES.replace("humidity AS (", "humidity_once AS (").replace("pressure AS (", "pressure_once AS (")
    + f""",\n{_twice('humidity')},\n{_twice('pressure')}"""
)

_ALIGNED = f""",
spelled AS (SELECT datetime, CASE WHEN weather_description = 'sky is clear' THEN 'clear sky'
                                  ELSE weather_description END AS d
            FROM weather_description),
weather AS (
  SELECT h.datetime, h.humidity, p.pressure, t.temperature,
         {_category('s.d')} AS weather_description, w.wind_speed
  FROM humidity h
  JOIN pressure p ON h.datetime = p.datetime
  JOIN temperature t ON h.datetime = t.datetime
  JOIN spelled s ON h.datetime = s.datetime
  JOIN wind_speed w ON h.datetime = w.datetime)"""

WEATHER = SERIES + _ALIGNED
REPEATED_WEATHER = REPEATED_SERIES + _ALIGNED

# Rules by day of the month and weekday (1 = Monday) over every day of the years.
HOLIDAYS = """
days AS (
  SELECT CAST(d AS DATE) AS d, year(d) AS y, month(d) AS m, day(d) AS dd, isodow(d) AS w
  FROM generate_series(TIMESTAMP '1989-12-01', TIMESTAMP '2036-12-31', INTERVAL 1 DAY) s(d)),
fixed_days AS (
  SELECT d, w, CASE WHEN m = 1 AND dd = 1 THEN 'New Year''s Day'
                    WHEN m = 6 AND dd = 19 AND y >= 2021 THEN 'Juneteenth'
                    WHEN m = 7 AND dd = 4 THEN 'Independence Day'
                    WHEN m = 11 AND dd = 11 THEN 'Veterans Day'
                    WHEN m = 12 AND dd = 25 THEN 'Christmas Day' END AS name
  FROM days),
all_days AS (
  SELECT d AS date, name FROM fixed_days WHERE name IS NOT NULL
  UNION ALL
  SELECT CAST(d - INTERVAL 1 DAY AS DATE), name || ' (Observed)'
  FROM fixed_days WHERE name IS NOT NULL AND w = 6
  UNION ALL
  SELECT CAST(d + INTERVAL 1 DAY AS DATE), name || ' (Observed)'
  FROM fixed_days WHERE name IS NOT NULL AND w = 7
  UNION ALL
  SELECT d, CASE WHEN m = 2 AND dd = 12 THEN 'Lincoln''s Birthday'
                 WHEN m = 1 AND w = 1 AND dd BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
                 WHEN m = 2 AND w = 1 AND dd BETWEEN 15 AND 21 THEN 'Presidents'' Day'
                 WHEN m = 3 AND w = 1 AND dd <= 7 THEN 'Casimir Pulaski Day'
                 WHEN m = 5 AND w = 1 AND dd >= 25 THEN 'Memorial Day'
                 WHEN m = 9 AND w = 1 AND dd <= 7 THEN 'Labor Day'
                 WHEN m = 10 AND w = 1 AND dd BETWEEN 8 AND 14 THEN 'Columbus Day'
                 WHEN m = 11 AND w = 4 AND dd BETWEEN 22 AND 28 THEN 'Thanksgiving'
                 WHEN m = 11 AND w = 2 AND dd BETWEEN 2 AND 8 AND y % 2 = 0 AND y >= 2008
                   THEN 'Election Day' END AS name
  FROM days WHERE name IS NOT NULL),
holidays AS (SELECT date, name FROM all_days WHERE name IS NOT NULL)"""


def _calendar(ts: str) -> str:
    return f"""strftime({ts}, '%Y-%m-%d') AS date,
         CASE WHEN CAST({ts} AS DATE) IN (SELECT date FROM holidays) THEN 'yes' ELSE 'no' END AS holiday,
         dayname({ts}) AS week_days,
         CASE WHEN hour({ts}) <= 6 THEN 'Early Morning' WHEN hour({ts}) <= 12 THEN 'Morning'
              WHEN hour({ts}) <= 18 THEN 'Afternoon' ELSE 'Night' END AS part_time,
         CAST(month({ts}) AS INTEGER) AS month"""


_KEYS = ", ".join(f"d.{name}" for name in STATION_COLUMNS)


def _grouped(source: str, prefix: str) -> str:
    """Modal weather of each slot, then the detail joined to it and grouped."""
    means = ",\n         ".join(f"{_mean(f'TRY_CAST(d.{m} AS DOUBLE)')} AS {m}" for m in MEASURES)
    return f"""
{prefix}modal AS (
  SELECT date AS date_mf, weather_description AS weather_description_mf,
         part_time AS part_time_mf, from_station_id AS from_station_id_mf
  FROM (SELECT *, row_number() OVER (PARTITION BY date, from_station_id, part_time, holiday,
                                                  week_days, month
                                     ORDER BY n DESC, weather_description NULLS FIRST) AS r
        FROM (SELECT date, from_station_id, part_time, holiday, week_days, month,
                     weather_description, count(*) AS n
              FROM {source} GROUP BY ALL))
  WHERE r = 1),
{prefix}target AS (
  SELECT d.date, {_KEYS}, d.part_time, d.holiday, d.week_days, m.weather_description_mf, d.month,
         {means},
         count(d.from_station_id) AS bicycle_rentals
  FROM {source} d
  JOIN {prefix}modal m ON d.date = m.date_mf AND d.from_station_id = m.from_station_id_mf
                      AND d.part_time = m.part_time_mf
  GROUP BY d.date, {_KEYS}, d.part_time, d.holiday, d.week_days, m.weather_description_mf, d.month)"""


_JOINED = """,
joined AS (
  SELECT TRY_CAST(t.starttime AS TIMESTAMP) AS starttime,
         TRY_CAST(t.from_station_id AS INTEGER) AS from_station_id,
         t.latitude, t.longitude, t.mean_dpcapacity_start, t.mean_dpcapacity_end,
         t.sum_subscriber, t.sum_customer, w.humidity, w.pressure, w.temperature,
         w.weather_description, w.wind_speed
  FROM trip_columns t JOIN weather w ON t.starttime_join = w.datetime)"""

_TARGET = "," + HOLIDAYS + f""",
detail AS (SELECT *, {_calendar('starttime')} FROM joined),""" + _grouped("detail", "")

JOINED = PROFILE + "," + WEATHER + _JOINED
TARGET = JOINED + _TARGET
UNEVEN_TARGET = UNEVEN_PROFILE + "," + WEATHER + _JOINED + _TARGET.replace(
    "FROM joined)", "FROM joined WHERE starttime IS NOT NULL AND from_station_id IS NOT NULL)"
)
REPEATED_TARGET = PROFILE + "," + REPEATED_WEATHER + _JOINED + _TARGET

FORECAST = f"""
forecast_hours AS (
  SELECT DISTINCT ({_K}) // 3 * 3 + {FORECAST_SHIFT_HOURS} AS k FROM events),
forecast AS (
  SELECT {_hour_text('k')} AS datetime,
         CAST(40 + (7 * k) % 60 AS DOUBLE) AS humidity,
         CASE WHEN k % 17 <> 0 THEN CAST(1000 + k % 30 AS DOUBLE) END AS pressure,
         CAST(k % 40 - 20 AS DOUBLE) AS temperature,
         {_description('k')} AS weather_description,
         CAST(k % 15 AS DOUBLE) AS wind_speed
  FROM forecast_hours),
classified AS (SELECT *, {_category('weather_description')} AS weather_condition FROM forecast)"""

GRID = PROFILE + "," + FORECAST + """,
stations AS (
  SELECT DISTINCT from_station_id, latitude, longitude, mean_dpcapacity_start,
         mean_dpcapacity_end, sum_subscriber, sum_customer FROM ingested),
grid AS (
  SELECT CAST(c.datetime AS TIMESTAMP) AS starttime,
         TRY_CAST(s.from_station_id AS INTEGER) AS from_station_id, s.latitude, s.longitude,
         s.mean_dpcapacity_start, s.mean_dpcapacity_end, s.sum_subscriber, s.sum_customer,
         c.datetime, c.humidity, c.pressure, c.temperature, c.weather_description,
         c.wind_speed, c.weather_condition
  FROM classified c CROSS JOIN stations s)"""

SCORING = GRID + "," + HOLIDAYS + f""",
grid_detail AS (
  SELECT * EXCLUDE (weather_condition) REPLACE (weather_condition AS weather_description),
         {_calendar('starttime')}
  FROM grid),""" + _grouped("grid_detail", "scoring_")

STAND_IN = """(temperature * 0.25::DOUBLE + wind_speed * 0.5::DOUBLE
   - humidity * 0.125::DOUBLE + mean_dpcapacity_start * 0.25::DOUBLE)"""

ENTRIES = SCORING + f""",
entries AS (
  SELECT from_station_id, latitude, longitude, mean_dpcapacity_start, mean_dpcapacity_end,
         sum_subscriber, sum_customer, date, part_time,
         CAST(trunc({STAND_IN}) AS INTEGER) AS bicycle_rentals,
         weather_description_mf, week_days, holiday, humidity, pressure, temperature, wind_speed
  FROM scoring_target)"""


def _field(name: str, text: bool, first: bool = False) -> str:
    comma = "" if first else ","
    value = f"'\"' || {name} || '\"'" if text else f"CAST({name} AS VARCHAR)"
    return f"coalesce('{comma}\"{name}\":' || {value}, '')"


_INFO = " || ".join(
    [
        _field("part_time", True, first=True),
        _field("bicycle_rentals", False),
        _field("weather_description_mf", True),
        _field("week_days", True),
        _field("holiday", True),
        *[_field(name, False) for name in MEASURES],
    ]
)
_STATION = " || ".join(
    [
        _field("from_station_id", False, first=True),
        _field("latitude", True),
        _field("longitude", True),
        _field("mean_dpcapacity_start", False),
        _field("mean_dpcapacity_end", False),
        _field("sum_subscriber", False),
        _field("sum_customer", False),
    ]
)
_SEVEN = ", ".join(STATION_COLUMNS)

MESSAGES = ENTRIES + f""",
per_date AS (
  SELECT {_SEVEN}, date,
         string_agg('{{' || {_INFO} || '}}', ',' ORDER BY part_time) AS info
  FROM entries GROUP BY {_SEVEN}, date),
messages AS (
  SELECT from_station_id,
         '{{' || {_STATION} || ',"dates":[' ||
         string_agg('{{"date":"' || date || '","info":[' || info || ']}}', ',' ORDER BY date)
         || ']}}' AS value
  FROM per_date GROUP BY {_SEVEN})"""


def _rank(column: str) -> str:
    return f"""{column}_rank AS (
  SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR))
                             - 1 AS DOUBLE) AS i
  FROM target GROUP BY {column})"""


_CATEGORIES = ("part_time", "holiday", "week_days", "weather_description_mf", "month")
INDEXED = TARGET + "," + ",\n".join(_rank(name) for name in _CATEGORIES) + """,
prepared AS (
  SELECT t.*, a.i AS part_time_indexed, b.i AS holiday_indexed, c.i AS week_days_indexed,
         d.i AS weather_description_mf_indexed, e.i AS month_indexed,
         round(coalesce(humidity, avg(humidity) OVER ()), 6) AS humidity_input,
         round(coalesce(pressure, avg(pressure) OVER ()), 6) AS pressure_input
  FROM target t
  JOIN part_time_rank a ON t.part_time = a.v
  JOIN holiday_rank b ON t.holiday = b.v
  JOIN week_days_rank c ON t.week_days = c.v
  JOIN weather_description_mf_rank d ON t.weather_description_mf = d.v
  JOIN month_rank e ON t.month = e.v)"""

_VECTOR = ", ".join(
    f"CAST({name} AS DOUBLE) AS f{i:02d}"
    for i, name in enumerate(
        [
            "part_time_indexed",
            "holiday_indexed",
            "month_indexed",
            "week_days_indexed",
            "weather_description_mf_indexed",
            "humidity_input",
            "pressure_input",
            "temperature",
            "wind_speed",
            "from_station_id",
            "mean_dpcapacity_start",
            "mean_dpcapacity_end",
            "sum_subscriber",
            "sum_customer",
        ]
    )
)


def _stacked() -> str:
    names = [*MEASURES, "weather_description"]
    return " UNION ALL ".join(
        f"SELECT datetime, '{name}' AS measure, {name} AS reading FROM {name}" for name in names
    )


def _query(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


_SPLIT = """
SELECT date, from_station_id, part_time,
       CAST('0x' || substr(md5('1|' || date || '|' || from_station_id || '|' || part_time), 1, 8)
            AS BIGINT) % 100 < 70 AS is_train
FROM target"""

ORACLES: dict[str, str] = {
    "usertype_flags": _query(TRIPS, "SELECT trip_id, usertype, subscriber, customer FROM flagged"),
    "station_coordinate_groups": _query(PROFILE, "SELECT * FROM coordinate_groups"),
    "station_profile": _query(PROFILE, "SELECT * FROM profile"),
    "trips_with_profile": _query(PROFILE, "SELECT * FROM ingested"),
    "station_list": _query(PROFILE, f"SELECT DISTINCT {_SEVEN} FROM ingested"),
    "hour_bucket": _query(
        TRIPS,
        "SELECT trip_id, starttime, strftime(date_trunc('hour', CAST(starttime AS TIMESTAMP)),"
        " '%Y-%m-%d %H:%M:%S') AS starttime_join FROM trips",
    ),
    "measure_series": _query(SERIES, _stacked()),
    "weather_classified": _query(
        SERIES,
        f"SELECT *, {_category('weather_description')} AS weather_condition"
        " FROM weather_description",
    ),
    "weather_aligned": _query(WEATHER, "SELECT * FROM weather"),
    "weather_duplicate_hours": _query(REPEATED_WEATHER, "SELECT * FROM weather"),
    "trips_weather_join": _query(
        JOINED,
        "SELECT * REPLACE (strftime(starttime, '%Y-%m-%d %H:%M:%S') AS starttime) FROM joined",
    ),
    "unmatched_trips": _query(
        PROFILE + "," + WEATHER,
        "SELECT starttime_join, count(*) AS trips FROM trip_columns"
        " WHERE starttime_join NOT IN (SELECT datetime FROM weather) GROUP BY 1",
    ),
    "unmatched_summary": _query(
        TRIPS + "," + WEATHER,
        "SELECT count(*) AS trips, count(*) FILTER (from_station_id IS NULL) AS without_station,"
        " count(*) FILTER (substr(starttime, 1, 13) || ':00:00' NOT IN"
        " (SELECT datetime FROM weather)) AS without_weather FROM trips",
    ),
    "calendar_features": _query(
        TRIPS + "," + HOLIDAYS,
        f"SELECT trip_id, starttime, {_calendar('CAST(starttime AS TIMESTAMP)')} FROM trips",
    ),
    "holiday_calendar": _query(
        HOLIDAYS,
        "SELECT strftime(h.date, '%Y-%m-%d') AS date, h.name, count(*) AS orders"
        " FROM orders o JOIN holidays h ON CAST(o.o_orderdate AS DATE) = h.date GROUP BY 1, 2",
    ),
    "modal_weather": _query(TARGET, "SELECT * FROM modal"),
    "target_frame": _query(TARGET, "SELECT * FROM target"),
    "target_frame_single_pass": _query(TARGET, "SELECT * FROM target"),
    "training_frame": _query(TARGET, "SELECT * FROM target"),
    "training_frame_repeated_hours": _query(REPEATED_TARGET, "SELECT * FROM target"),
    "forecast_flatten": _query(FORECAST, "SELECT * FROM forecast"),
    "scoring_grid": _query(
        GRID, "SELECT * REPLACE (strftime(starttime, '%Y-%m-%d %H:%M:%S') AS starttime) FROM grid"
    ),
    "scoring_frame": _query(SCORING, "SELECT * EXCLUDE (bicycle_rentals) FROM scoring_target"),
    "prediction_documents": _query(ENTRIES, "SELECT * FROM entries"),
    "prediction_messages": _query(MESSAGES, "SELECT value FROM messages"),
    "prediction_lookup": _query(
        MESSAGES, f"SELECT value FROM messages WHERE from_station_id = {LOOKUP_STATION}"
    ),
    "prediction_stream": _query(ENTRIES, "SELECT * FROM entries"),
    "json_roundtrip": _query(ENTRIES, "SELECT * FROM entries"),
    "parquet_roundtrip": _query(PROFILE, "SELECT * FROM trip_columns"),
    "weather_roundtrip": _query(WEATHER, "SELECT * FROM weather"),
    "csv_roundtrip": _query(TRIPS, "SELECT * FROM trips"),
    "station_profile_uneven": _query(UNEVEN_PROFILE, "SELECT * FROM profile"),
    "training_frame_uneven": _query(UNEVEN_TARGET, "SELECT * FROM target"),
    "calendar_days": _query(
        HOLIDAYS
        + """,
shifts AS (SELECT unnest([0, 8, 16, 24, 32]) AS years),
moments AS (
  SELECT DISTINCT strftime(CAST(o_orderdate AS DATE) + to_years(years), '%Y-%m-%d') || ' ' ||
         lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS starttime
  FROM orders CROSS JOIN shifts)""",
        f"SELECT starttime, {_calendar('CAST(starttime AS TIMESTAMP)')} FROM moments",
    ),
    "rental_predictions": _query(
        TARGET + f", split AS ({_SPLIT})",
        "SELECT t.date, t.from_station_id, t.part_time, t.bicycle_rentals, true AS is_finite"
        " FROM target t JOIN split s ON t.date = s.date AND t.part_time = s.part_time"
        " AND t.from_station_id = s.from_station_id WHERE NOT s.is_train",
    ),
    "rental_rmse": _query(
        TARGET
        + f""", split AS ({_SPLIT}),
parts AS (
  SELECT t.bicycle_rentals AS y, s.is_train
  FROM target t JOIN split s ON t.date = s.date AND t.part_time = s.part_time
                            AND t.from_station_id = s.from_station_id),
mean AS (SELECT avg(y) AS m FROM parts WHERE is_train)""",
        "SELECT count(*) AS test_rows, round(sqrt(avg(pow(m - y, 2))), 6) AS rmse_of_mean,"
        " true AS model_is_better FROM parts CROSS JOIN mean WHERE NOT is_train",
    ),
    "model_roundtrip": _query(
        SCORING, "SELECT date, from_station_id, part_time, true AS is_equal FROM scoring_target"
    ),
    "hash_split": _query(TARGET, _SPLIT),
    "imputed_features": _query(
        INDEXED, "SELECT date, from_station_id, part_time, humidity_input, pressure_input FROM prepared"
    ),
    "indexed_features": _query(
        INDEXED,
        "SELECT date, from_station_id, part_time, part_time_indexed, holiday_indexed,"
        " week_days_indexed, weather_description_mf_indexed, month_indexed FROM prepared",
    ),
    "assembled_features": _query(
        INDEXED,
        "SELECT date AS key_date, from_station_id AS key_from_station_id,"
        f" part_time AS key_part_time, {_VECTOR} FROM prepared",
    ),
    "stand_in_rmse": _query(
        TARGET,
        f"SELECT round(sqrt(avg(pow({STAND_IN} - bicycle_rentals, 2))), 6) AS rmse FROM target",
    ),
}
