"""Entry point for spark-submit: ``spark-submit submit.py <job> <arguments>``."""

from __future__ import annotations

import sys

from stationcast.jobs import ingest, lookup, predict, train

JOBS = {"ingest": ingest.main, "train": train.main, "predict": predict.main, "lookup": lookup.main}


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: submit.py {{{','.join(JOBS)}}} ...")
    JOBS[argv[0]](argv[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
