"""Stations, forecast and model become prediction documents, in a folder or a topic.

    spark-submit submit.py predict --stations stations --forecast payload.json \
        --first-year 2024 --last-year 2025 --model model --out documents

``--keyed`` stores the documents for lookups by station instead of as JSON.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stationcast.operators import holiday_calendar, prediction_documents
from stationcast.plans import plain_predictions, scoring_frame
from stationcast.session import build_session, staging
from stationcast.sinks import write_documents, write_keyed, write_topic
from stationcast.sources import read_forecast, read_model, read_stations, read_trips


def documents(
    spark: SparkSession,
    forecast: str,
    years: range,
    model: str,
    stations: str | None = None,
    trips: str | None = None,
) -> DataFrame:
    """Documents for the stored profile ``stations``, or for the stations of wide ``trips``."""
    known = read_stations(spark, stations) if stations else read_trips(spark, trips)
    frame = scoring_frame(known, read_forecast(spark, forecast), holiday_calendar(spark, years))
    return prediction_documents(plain_predictions(read_model(model), frame))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--stations", help="station table of the ingest job")
    source.add_argument("--trips", help="wide trip table, read whole for its stations")
    parser.add_argument("--forecast", required=True, help="payload file or folder of them")
    parser.add_argument("--first-year", type=int, required=True, help="of the holiday calendar")
    parser.add_argument("--last-year", type=int, required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--out", help="folder for JSON documents")
    parser.add_argument("--keyed", action="store_true", help="write --out for lookups by station")
    parser.add_argument("--servers", help="message brokers, instead of --out")
    parser.add_argument("--topic")
    args = parser.parse_args(argv)
    if bool(args.out) == bool(args.servers and args.topic):
        parser.error("give either --out, or --servers and --topic")
    years = range(args.first_year, args.last_year + 1)
    spark = build_session("predict")
    with staging(spark):
        result = documents(spark, args.forecast, years, args.model, args.stations, args.trips)
        if args.out and args.keyed:
            write_keyed(result, args.out, "from_station_id")
        elif args.out:
            write_documents(result, args.out)
        else:
            write_topic(result, args.servers, args.topic)


if __name__ == "__main__":
    main()
