"""Small frames with known contents, and plain-Python reference results."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

TRIP_SCHEMA = (
    "starttime string, usertype string, from_station_id string, latitude_start string, "
    "longitude_start string, dpcapacity_start string, dpcapacity_end string"
)
WEATHER_SCHEMA = (
    "datetime string, humidity string, pressure string, temperature string, "
    "weather_description string, wind_speed string"
)


def trip(start, station="1", user="Subscriber", lat="41.8", lon="-87.6", cap="15", cap_end="11"):
    return (start, user, station, lat, lon, cap, cap_end)


def skewed_trips(n=3000, seed=5):
    """Trips over ten days; station 1 has a third of them, half of those in one hour."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = "1" if i % 3 == 0 else str(rng.randint(2, 25))
        if station == "1" and i % 2 == 0:
            start = dt.datetime(2016, 7, 4, 17, rng.randint(0, 59))
        else:
            start = dt.datetime(2016, 7, 1) + dt.timedelta(minutes=rng.randint(0, 10 * 1440 - 1))
        spot = rng.choice([("41.80", "-87.60"), ("41.81", "-87.61"), ("41.82", "-87.62")])
        rows.append(
            trip(
                start.strftime("%Y-%m-%d %H:%M:%S"),
                station,
                rng.choice(["Subscriber", "Customer", "Dependent"]),
                *spot,
                str(rng.choice([11, 15, 19])),
                rng.choice(["11", "15", "bad", ""]),
            )
        )
    return rows


def hourly_weather(days=10, seed=6, repeat=()):
    """One row per hour, some hours missing, some values NULL; ``repeat`` hours come twice."""
    rng = random.Random(seed)
    rows = []
    for h in range(days * 24):
        when = (dt.datetime(2016, 7, 1) + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S")
        if h % 41 == 7:
            continue
        for _ in range(2 if h in repeat else 1):
            rows.append(
                (
                    when,
                    str(rng.randint(30, 90)),
                    None if h % 5 == 0 else str(rng.randint(990, 1020)),
                    str(rng.randint(280, 305)),
                    rng.choice(["Clear", "Clouds", "Rain"]),
                    str(rng.randint(0, 9)),
                )
            )
    return rows


def half_up(value: float, digits: int) -> float:
    six = Decimal(repr(value)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    return float(six.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def part(hour: int) -> str:
    return ("Early Morning" if hour <= 6 else "Morning" if hour <= 12
            else "Afternoon" if hour <= 18 else "Night")


def brute_profiles(trips):
    """Station profile by plain loops; trips without a station are left out."""
    groups = defaultdict(list)
    for row in trips:
        if row[2] is not None:
            groups[row[2]].append(row)
    profiles = {}
    for station, rows in groups.items():
        counts = Counter((r[3], r[4]) for r in rows)
        spot = min(counts, key=lambda s: (-counts[s], s))
        there = [r for r in rows if (r[3], r[4]) == spot]

        def mean(position, rows=there):
            numbers = [float(r[position]) for r in rows if r[position] not in ("bad", "", None)]
            return half_up(sum(numbers) / len(numbers), 0) if numbers else None

        profiles[station] = (
            *spot,
            mean(5),
            mean(6),
            sum(r[1] == "Subscriber" for r in there),
            sum(r[1] == "Customer" for r in there),
            len(there),
        )
    return profiles


def brute_training(trips, weather, holidays):
    """Training frame by plain loops: {(date, station, part): (rentals, modal, means)}."""
    profiles = brute_profiles(trips)
    by_hour = defaultdict(list)
    for row in weather:
        by_hour[row[0]].append(row)
    slots = defaultdict(list)
    for row in trips:
        if row[2] not in profiles:
            continue
        when = dt.datetime.strptime(row[0], "%Y-%m-%d %H:%M:%S")
        key = (when.strftime("%Y-%m-%d"), int(row[2]), part(when.hour))
        slots[key] += by_hour[row[0][:13] + ":00:00"]
    result = {}
    for key, rows in slots.items():
        if not rows:
            continue
        votes = Counter(r[4] for r in rows)
        modal = min(votes, key=lambda w: (-votes[w], w))
        means = []
        for position in (1, 2, 3, 5):
            numbers = [float(r[position]) for r in rows if r[position] is not None]
            means.append(half_up(sum(numbers) / len(numbers), 1) if numbers else None)
        day = dt.date.fromisoformat(key[0])
        result[key] = (
            len(rows),
            modal,
            tuple(means),
            "yes" if day in holidays else "no",
            day.strftime("%A"),
            day.month,
        )
    return result
