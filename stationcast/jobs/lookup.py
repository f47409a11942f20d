"""JSON of all prediction documents, or of one station, as text files.

    spark-submit submit.py lookup --documents documents --station 7 --out answer

``--keyed`` says that the documents were written with ``predict --keyed``; then only the files that
can hold the wanted stations are read, and ``--stations`` may name a text file with one per line.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from stationcast.functions import number
from stationcast.operators import lookup_predictions
from stationcast.session import build_session
from stationcast.sources import KeyedTable, read_documents


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--documents", required=True)
    parser.add_argument("--station", type=int)
    parser.add_argument("--stations", help="text file of station numbers, with --keyed")
    parser.add_argument("--keyed", action="store_true")
    parser.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    if args.stations and (args.station is not None or not args.keyed):
        parser.error("--stations goes with --keyed and without --station")
    spark = build_session("lookup")
    if not args.keyed:
        found = lookup_predictions(read_documents(spark, args.documents), args.station)
    elif args.stations:
        wanted = spark.read.text(args.stations).select(number("value", "int").alias("station"))
        found = lookup_predictions(KeyedTable(spark, args.documents).lookup(wanted))
    elif args.station is not None:
        wanted = spark.range(1).select(F.lit(args.station).alias("station"))
        found = lookup_predictions(KeyedTable(spark, args.documents).lookup(wanted))
    else:
        found = lookup_predictions(KeyedTable(spark, args.documents).read())
    found.write.mode("overwrite").text(args.out)


if __name__ == "__main__":
    main()
