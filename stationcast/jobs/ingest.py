"""Trip CSV and five measure CSVs become the trip, station and weather tables.

    spark-submit submit.py ingest --trips T.csv --humidity H.csv ... \
        --city Chicago --out-trips trips --out-stations stations --out-weather weather

The CSV is parsed once: the trips are stored with their rider flags, and the station profile
is made from some columns of the stored table. ``--wide`` stores the profile on every trip as
well; without ``--out-stations`` only that wide table is written. With ``--batches`` and a name
for this ``--batch`` the trips are counted into that folder, and the profile is made from the counts
of all batches in it. ``--out-ledger`` keeps what could not be read, counted in the same scan.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stationcast.operators import Ledger, attach_profile, station_profile, usertype_flags
from stationcast.plans import (
    add_batch,
    batched_profile,
    ingest_counted_weather,
    ingest_trips,
    ingest_weather,
)
from stationcast.schemas import MEASURES
from stationcast.session import build_session, staging
from stationcast.sinks import write_table
from stationcast.sources import (
    read_flagged_trips,
    read_measures,
    read_profile,
    read_trips_csv,
)

SERIES = (*MEASURES, "weather_description")


def run(
    spark: SparkSession,
    trips: str,
    series: dict[str, str],
    city: str,
    out_trips: str,
    out_weather: str,
    out_stations: str | None = None,
    wide: str | None = None,
    max_records: int | None = None,
    out_ledger: str | None = None,
    batches: str | None = None,
    batch: str | None = None,
    counted: bool = False,
) -> None:
    raw, ledger = read_trips_csv(spark, trips), Ledger()
    if out_ledger:
        raw = ledger.watch(raw)
    with staging(spark):
        if out_stations is None:
            write_table(ingest_trips(raw), out_trips, max_records)
        else:
            write_table(usertype_flags(raw), out_trips, max_records)
            stored = read_flagged_trips(spark, out_trips)
            if batches:
                add_batch(stored, batches, batch)
                write_table(batched_profile(spark, batches), out_stations)
            else:
                write_table(station_profile(stored), out_stations)
            if wide:
                joined = attach_profile(stored, read_profile(spark, out_stations))
                write_table(joined, wide, max_records)
        if out_ledger:
            write_table(ledger.rows(spark), out_ledger)
        weather = ingest_counted_weather if counted else ingest_weather
        write_table(weather(read_measures(spark, series, city)), out_weather)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trips", required=True)
    for name in SERIES:
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name, required=True)
    parser.add_argument("--city", required=True, help="column of the measure files to keep")
    parser.add_argument("--out-trips", required=True)
    parser.add_argument("--out-weather", required=True)
    parser.add_argument("--out-stations", help="table of the station profiles")
    parser.add_argument("--wide", help="also store the trips with their station's profile")
    parser.add_argument("--max-records", type=int, help="rows per file of the trip tables")
    parser.add_argument("--out-ledger", help="table of values that could not be read")
    parser.add_argument("--batches", help="folder of counts per batch, with --batch and --out-stations")
    parser.add_argument("--batch", help="name of this batch; one that comes again replaces its counts")
    parser.add_argument("--counted", action="store_true", help="store the weather with numbers of rows")
    args = parser.parse_args(argv)
    if bool(args.batches) != bool(args.batch) or (args.batches and not args.out_stations):
        parser.error("--batches, --batch and --out-stations go together")
    if args.wide and not args.out_stations:
        parser.error("--wide goes with --out-stations")
    run(
        build_session("ingest"),
        args.trips,
        {name: getattr(args, name) for name in SERIES},
        args.city,
        args.out_trips,
        args.out_weather,
        args.out_stations,
        args.wide,
        args.max_records,
        args.out_ledger,
        args.batches,
        args.batch,
        args.counted,
    )


if __name__ == "__main__":
    main()
