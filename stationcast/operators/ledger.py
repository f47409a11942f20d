"""Values that cannot be read, counted in the same pass that reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.functions import number, wall_clock

# Columns of the trip table that hold times and numbers.
TRIP_KINDS = {
    "starttime": "timestamp_ntz",
    "from_station_id": "int",
    "dpcapacity_start": "double",
    "dpcapacity_end": "double",
}
REASONS = ("missing", "blank", "malformed")
_LEDGER = T.StructType(
    [T.StructField("column", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("rows", T.LongType())]
)


def _reasons(column: str, kind: str) -> dict[str, Column]:
    text = F.col(f"`{column}`").cast("string")
    read = wall_clock(text) if kind == "timestamp_ntz" else number(text, kind)
    blank = F.trim(text) == ""
    return {
        "missing": text.isNull(),
        "blank": text.isNotNull() & blank,
        "malformed": text.isNotNull() & ~blank & read.isNull(),
    }


class Ledger:
    """Counts of bad values per column and reason, of whatever is read through ``watch``.

    The counts are metrics of the very scan that feeds a write (``DataFrame.observe``): no second
    pass, no row more is moved, and the driver receives one number per column and reason. They are
    there once the first action on the watched frame has ended; a frame that is read several times
    counts once.
    """

    def __init__(self, kinds: dict[str, str] = TRIP_KINDS, name: str = "ledger"):
        self.kinds = kinds
        self.observation = Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` as it is, with its bad values counted; columns it lacks are not watched."""
        counts = [F.count(F.lit(1)).alias("rows")]
        for column, kind in self.kinds.items():
            if column in df.columns:
                counts += [
                    F.count_if(found).alias(f"{reason} {column}") for reason, found in _reasons(column, kind).items()
                ]
        return df.observe(self.observation, *counts)

    def counts(self) -> dict[tuple[str, str], int]:
        """By column and reason; waits for the first action."""
        found = self.observation.get
        return {
            (name.partition(" ")[2], name.partition(" ")[0]): int(value)
            for name, value in found.items()
            if " " in name
        }

    def rows(self, spark: SparkSession) -> DataFrame:
        """The ledger as a table, zeros included: ``column``, ``reason``, ``rows``."""
        return spark.createDataFrame([(*key, value) for key, value in sorted(self.counts().items())], _LEDGER)
