"""The most frequent value combination of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_frequent_per_group(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    measures: Sequence[Column] = (),
    counted: str | Column | None = None,
    count_name: str = "count",
    counter: Column | None = None,
) -> DataFrame:
    """One row per key: the value combination with the highest count, and its measures.

    ``counted`` limits the count to rows where it is not NULL; ``counter`` is an aggregate to
    use instead, for rows that stand for several. ``measures`` are aliased
    aggregates over the rows of the winning combination only. Equal counts are decided
    by the values in ascending order, NULL first, so the answer does not depend on the
    partitioning.

    Both steps are aggregations that combine before the shuffle: a key that holds a
    large share of the rows leaves each task as one row per combination in the first
    step and as a single row in the second, and no task sees a whole group.
    """
    keys, values = list(keys), list(values)
    if counter is None:
        counter = F.count(F.lit(1) if counted is None else counted)
    tally = df.groupBy(*keys, *values).agg(counter.alias(count_name), *measures)
    carried = [name for name in tally.columns if name not in {*keys, *values, count_name}]

    order = (-F.col(count_name)).alias("order")
    winner = F.min(F.struct(order, *values, *carried)).alias("winner")
    return (
        tally.groupBy(*keys)
        .agg(winner)
        .select(
            *keys,
            *[F.col("winner")[name].alias(name) for name in values],
            (-F.col("winner.order")).alias(count_name),
            *[F.col("winner")[name].alias(name) for name in carried],
        )
    )
