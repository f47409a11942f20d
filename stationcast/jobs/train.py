"""Trip and weather tables become a fitted model; prints its error on held-out rows.

    spark-submit submit.py train --trips trips --stations stations --weather weather \
        --first-year 2013 --last-year 2019 --model model
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stationcast.operators import holiday_calendar
from stationcast.plans import evaluate, fit_model, rental_stages, split_frame, training_frame
from stationcast.plans.model import IMPUTED
from stationcast.session import build_session, stage, staging
from stationcast.sinks import save_model, write_csv
from stationcast.sources import read_flagged_trips, read_profile, read_trips, read_weather


def run(
    spark: SparkSession,
    trips: str,
    weather: str,
    years: range,
    model: str,
    train_percent: int = 70,
    seed: int = 0,
    handle_invalid: str = "error",
    imputed: tuple[str, ...] = IMPUTED,
    export: str | None = None,
    stations: str | None = None,
) -> DataFrame:
    """Fit and save the model; returns the one-row error table, computed.

    ``trips`` is the flagged table that goes with ``stations``, or the wide one without.
    """
    with staging(spark):
        return _run(
            spark, trips, weather, years, model, train_percent, seed, handle_invalid, imputed,
            export, stations,
        )


def _run(
    spark, trips, weather, years, model, train_percent, seed, handle_invalid, imputed, export, stations
) -> DataFrame:
    profile = read_profile(spark, stations) if stations else None
    frame = training_frame(
        read_flagged_trips(spark, trips) if stations else read_trips(spark, trips),
        read_weather(spark, weather),
        holiday_calendar(spark, years),
        profile=profile,
    )
    # The fit reads its rows many times: stored once, they need no recomputation, also
    # after the loss of an executor.
    frame = stage(frame, "training")
    if export:
        write_csv(frame, export)
    train, test = split_frame(frame, train_percent, seed)
    fitted = fit_model(rental_stages(handle_invalid, imputed), train)
    save_model(fitted, model)
    # One row, held here: the staged frame is gone when the caller shows it.
    return spark.createDataFrame(evaluate(fitted, test).collect(), "rmse double")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trips", required=True)
    parser.add_argument("--stations", help="station table of the ingest job")
    parser.add_argument("--weather", required=True)
    parser.add_argument("--first-year", type=int, required=True, help="of the holiday calendar")
    parser.add_argument("--last-year", type=int, required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--train-percent", type=int, default=70)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--handle-invalid", choices=["error", "keep", "skip"], default="error")
    parser.add_argument("--impute", nargs="+", default=list(IMPUTED))
    parser.add_argument("--export", help="also write the frame as CSV")
    args = parser.parse_args(argv)
    error = run(
        build_session("train"),
        args.trips,
        args.weather,
        range(args.first_year, args.last_year + 1),
        args.model,
        args.train_percent,
        args.seed,
        args.handle_invalid,
        tuple(args.impute),
        args.export,
        args.stations,
    )
    error.show()


if __name__ == "__main__":
    main()
