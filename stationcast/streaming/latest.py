"""The latest prediction document of each station, out of a stream of runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from stationcast.operators.documents import document_messages
from stationcast.schemas import PREDICTION_DOCUMENT

RUN_DOCUMENT = T.StructType([*PREDICTION_DOCUMENT.fields, T.StructField("run", T.LongType())])
_CHANGE = "station int, run long, value string"


def run_messages(documents: DataFrame, run: int) -> DataFrame:
    """The documents of a prediction run as JSON messages that name the run."""
    return document_messages(documents.withColumn("run", F.lit(run).cast("long")))


def newer_documents(messages: DataFrame, column: str = "value") -> DataFrame:
    """Of a stream of messages, those that are newer than all of their station before them.

    The state keeps one message per station: that of the highest run, and of equal runs the
    greatest text, so neither the order of files nor a replay has an influence. A message without
    a run counts as the oldest, one without a station, or that is no JSON, is left out. The
    messages of a station pass through one task one after the other and none is held but the best.
    """

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else None
        best = held
        for frame in frames:
            for run, value in zip(frame["run"].tolist(), frame["value"].tolist(), strict=True):
                best = (int(run), value) if best is None else max(best, (int(run), value))
        if best != held:
            state.update(best)
            yield pd.DataFrame({"station": [key[0]], "run": [best[0]], "value": [best[1]]})

    text = F.col(column).cast("string")
    parsed = messages.select(F.from_json(text, RUN_DOCUMENT).alias("document"), text.alias("value"))
    keyed = parsed.select(
        F.col("document.from_station_id").alias("station"),
        F.coalesce("document.run", F.lit(-(1 << 63))).alias("run"),
        "value",
    ).where(F.col("station").isNotNull())
    return keyed.groupBy("station").applyInPandasWithState(keep, _CHANGE, "run long, value string", "append", "NoTimeout")


def latest_documents(changes: DataFrame) -> DataFrame:
    """One document per station, from the table that ``newer_documents`` is drained into.

    The table has a row for each time that a station was given a newer document; the highest run
    is the last of them. ``run`` comes with the document, missing where the message had none.
    """
    best = F.max(F.struct("run", "value")).alias("best")
    found = changes.groupBy("station").agg(best)
    return found.select(F.from_json("best.value", RUN_DOCUMENT).alias("document")).select("document.*")
