"""Time the headline queries: one JSON line with seconds per query.

Each query is planned and run to the last row into a sink that keeps nothing. The time
is the better of the runs, after one untimed run of the first query to start the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationcast.catalog.queries import REGISTERED  # noqa: E402
from stationcast.session import build_session  # noqa: E402

HEADLINE = (
    "station_profile",
    "trips_with_profile",
    "weather_aligned",
    "trips_weather_join",
    "calendar_features",
    "holiday_calendar",
    "modal_weather",
    "target_frame",
    "target_frame_single_pass",
    "training_frame",
    "scoring_grid",
    "scoring_frame",
    "prediction_documents",
    "prediction_messages",
    "prediction_stream",
    "assembled_features",
    "rental_rmse",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, REGISTERED[HEADLINE[0]], sf_dir)
    times = {}
    for name in HEADLINE:
        runs = 1 if name == "rental_rmse" else RUNS
        times[name] = round(min(seconds(spark, REGISTERED[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
