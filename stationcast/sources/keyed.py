"""Lookups in a table that ``write_keyed`` has laid out."""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.sinks.keyed import INDEX, SLICE, read_rows

# Keys that are handed to the scan as values; more are looked up in a join.
MOST_VALUES = 1000


class KeyedTable:
    """A keyed table; only its index, one row per slice, is read by the driver."""

    def __init__(self, spark: SparkSession, path: str):
        rows = spark.read.parquet(f"{path}/{INDEX}").collect()
        self.spark, self.path, self.key = spark, path, rows[0]["key"]
        self.schema = T.StructType.fromJson(json.loads(rows[0]["columns"]))
        # Slices are numbered by ascending ranges; one without any key has no bounds.
        held = sorted((r[SLICE], r["first"], r["last"]) for r in rows if r["first"] is not None)
        self.slices = [number for number, _, _ in held]
        self.firsts = [first for _, first, _ in held]
        self.lasts = [last for _, _, last in held]

    def read(self, condition: Column | None = None) -> DataFrame:
        """The whole table, or what meets a condition on ``slice`` and the columns."""
        rows = read_rows(self.spark, self.path, self.schema)
        return (rows if condition is None else rows.where(condition)).drop(SLICE)

    def slices_of(self, values: Iterable) -> list[int]:
        """The slices whose range holds one of the values."""
        found: set[int] = set()
        for value in values:
            at = bisect.bisect_left(self.lasts, value)
            while at < len(self.slices) and self.firsts[at] <= value:
                found.add(self.slices[at])
                at += 1
        return sorted(found)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows whose key stands in the only column of ``wanted``, each once.

        Up to ``MOST_VALUES`` distinct keys become a filter: the index leaves the slices that can
        hold them, and the row groups' bounds and Bloom filters leave fewer still. More keys are
        met in a semi-join, with the slices that the index leaves between the first and the last
        of them; Spark's threshold decides whether they are broadcast. Missing keys find nothing.
        """
        kind = self.schema[self.key].dataType
        keys = wanted.select(F.col(f"`{wanted.columns[0]}`").cast(kind).alias(self.key)).dropna().distinct()
        few = [r[0] for r in keys.limit(MOST_VALUES + 1).collect()]
        column = F.col(f"`{self.key}`")
        if len(few) <= MOST_VALUES:
            slices = self.slices_of(few)
            return self.read(F.col(SLICE).isin(slices) & column.isin(few))
        first, last = keys.agg(F.min(self.key), F.max(self.key)).first()
        held = zip(self.slices, self.firsts, self.lasts, strict=True)
        slices = [number for number, a, b in held if a <= last and b >= first]
        rows = self.read(F.col(SLICE).isin(slices) & column.between(first, last))
        return rows.join(keys, self.key, "left_semi").select(*[F.col(f"`{n}`") for n in self.schema.names])
