"""DuckDB SQL for the queries over stored tables."""

from __future__ import annotations

from stationcast.catalog.oracle import (
    ENTRIES,
    PROFILE,
    REPEATED_TARGET,
    REPEATED_WEATHER,
    TARGET,
    UNEVEN,
    UNEVEN_PROFILE,
    UNEVEN_TARGET,
    _calendar,
    _query,
)

# Every year's Easter Sunday by another rule than the library's, and the days that go by it.
MOVABLE = """
years AS (SELECT CAST(y AS INTEGER) AS y FROM generate_series(1989, 2036) s(y)),
ages AS (
  SELECT y, y // 100 AS c,
         (y // 100 - y // 400 - (8 * (y // 100) + 13) // 25 + 19 * (y % 19) + 15) % 30 AS h
  FROM years),
moons AS (SELECT y, c, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - y % 19) // 11)) AS i FROM ages),
sundays AS (SELECT y, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM moons),
easter AS (
  SELECT make_date(y, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) AS sunday
  FROM sundays),
holidays AS (
  SELECT CAST(sunday + to_days(n) AS DATE) AS date
  FROM easter, (SELECT unnest([-2, 1, 39, 50]) AS n)
  UNION ALL
  SELECT make_date(y, m, d)
  FROM years, (VALUES (1, 1), (5, 1), (10, 3), (12, 25), (12, 26)) v(m, d))"""

MOMENTS = """,
shifts AS (SELECT unnest([0, 8, 16, 24, 32]) AS years),
moments AS (
  SELECT DISTINCT strftime(CAST(o_orderdate AS DATE) + to_years(years), '%Y-%m-%d') || ' ' ||
         lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS starttime
  FROM orders CROSS JOIN shifts)"""


def _counted(column: str, kind: str) -> str:
    blank = f"trim({column}) = ''"
    checks = {
        "missing": f"{column} IS NULL",
        "blank": f"{column} IS NOT NULL AND {blank}",
        "malformed": f"{column} IS NOT NULL AND NOT {blank} AND TRY_CAST({column} AS {kind}) IS NULL",
    }
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{reason}' AS reason, count(*) FILTER ({found}) AS \"rows\" FROM trips"
        for reason, found in checks.items()
    )


STORED_ORACLES: dict[str, str] = {
    "lookup_many": _query(
        ENTRIES,
        "SELECT * FROM entries WHERE from_station_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
    ),
    "keyed_roundtrip": _query(UNEVEN, "SELECT * FROM trips"),
    "keyed_trips": _query(
        UNEVEN,
        "SELECT * FROM trips WHERE from_station_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)",
    ),
    "profile_by_batches": _query(UNEVEN_PROFILE, "SELECT * FROM profile"),
    "training_frame_by_batches": _query(UNEVEN_TARGET, "SELECT * FROM target"),
    "weather_counted": _query(
        REPEATED_WEATHER,
        'SELECT datetime, weather_description, count(*) AS "rows" FROM weather GROUP BY 1, 2',
    ),
    "weather_expanded": _query(REPEATED_WEATHER, "SELECT * FROM weather"),
    "training_frame_counted_weather": _query(REPEATED_TARGET, "SELECT * FROM target"),
    "orders_by_station": _query(
        PROFILE
        + """,
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
        "SELECT p.station AS from_station_id, count(*) AS days,"
        " count(*) FILTER (TRY_CAST(p.station AS INTEGER) % 31 + 1 = day(d.day)) AS matching,"
        " strftime(min(d.day), '%Y-%m-%d') AS first_day"
        " FROM profile p CROSS JOIN days d WHERE p.station IS NOT NULL GROUP BY 1",
    ),
    "tree_scores": _query(TARGET, "SELECT date, from_station_id, part_time, true AS is_equal FROM target"),
    "bad_values": _query(
        UNEVEN,
        " UNION ALL ".join(
            _counted(column, kind)
            for column, kind in (
                ("starttime", "TIMESTAMP"),
                ("from_station_id", "INTEGER"),
                ("dpcapacity_start", "DOUBLE"),
                ("dpcapacity_end", "DOUBLE"),
            )
        ),
    ),
    "latest_documents": _query(
        ENTRIES,
        """SELECT DISTINCT from_station_id,
       CASE WHEN from_station_id % 2 = 0 THEN sum_customer WHEN from_station_id % 5 <> 0 THEN sum_customer + 1
            ELSE -1 END AS sum_customer,
       CAST(CASE WHEN from_station_id % 2 = 0 THEN 3 WHEN from_station_id % 5 <> 0 THEN 2 ELSE 1 END AS BIGINT) AS run
FROM entries""",
    ),
    "calendar_days_movable": _query(
        MOVABLE + MOMENTS, f"SELECT starttime, {_calendar('CAST(starttime AS TIMESTAMP)')} FROM moments"
    ),
}
