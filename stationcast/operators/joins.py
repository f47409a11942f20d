"""Pairing of two frames without a cross join."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pairs that one cell of the grid makes, as far as there are enough rows to deal.
PAIRS_PER_CELL = 1 << 17


def grid_shape(many: int, few: int, pairs_per_cell: int = PAIRS_PER_CELL) -> tuple[int, int]:
    """Into how many rows and columns of blocks two sides of these sizes are dealt.

    There are as many cells as the pairs need. With r rows and c columns of blocks the first side
    is copied c times and the second r times; for a given number of cells the copies are fewest
    where ``many * c`` equals ``few * r``.
    """
    if not many or not few:
        return 1, 1
    cells = max(1, math.ceil(many * few / pairs_per_cell))
    rows = min(many, cells, max(1, round(math.sqrt(cells * many / few))))
    return rows, min(few, math.ceil(cells / rows))


def grid_join(
    many: DataFrame,
    few: DataFrame,
    keys: list[str],
    few_keys: list[str] | None = None,
    sizes: tuple[int, int] | None = None,
    pairs_per_cell: int = PAIRS_PER_CELL,
) -> DataFrame:
    """Every row of ``many`` with every row of ``few``, as an equi-join on the cells of a grid.

    ``many`` is dealt to rows of blocks by a hash of its ``keys``, ``few`` to columns by one of its
    ``few_keys`` (all its columns), and each row is copied to the cells of its block. The shape
    follows the ``sizes`` of the sides in rows, which are counted if they are not given. So tasks
    grow with the pairs on either side, a cell holds a bounded part of both, and neither side is
    ever broadcast.
    """
    rows, columns = grid_shape(*(sizes or (many.count(), few.count())), pairs_per_cell)
    return _in_cells(many, few, keys, few_keys or few.columns, rows, columns)


def _in_cells(
    many: DataFrame, few: DataFrame, keys: list[str], few_keys: list[str], rows: int, columns: int
) -> DataFrame:
    """The hint keeps both sides partitioned: one streams past a hash table of the other's cell.

    The cells are dealt to a number of tasks that adaptive execution keeps. It would merge them by
    the bytes of the sides, and not by the pairs these make.
    """
    tasks = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.pmod(F.xxhash64(*keys), F.lit(rows)).cast("int")
    second = F.pmod(F.xxhash64(*few_keys), F.lit(columns)).cast("int")
    across = F.sequence(F.lit(0), F.lit(columns - 1))
    along = F.sequence(F.lit(0), F.lit(rows - 1))
    dealt = many.withColumn("_cell", F.explode(F.transform(across, lambda c: first * columns + c)))
    copies = few.withColumn("_cell", F.explode(F.transform(along, lambda r: r * columns + second)))
    dealt, copies = (side.repartition(tasks, "_cell") for side in (dealt, copies))
    return dealt.join(copies.hint("shuffle_hash"), "_cell").drop("_cell")


def replicate_join(many: DataFrame, few: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The pairing in one column of ``buckets`` blocks: ``many`` is not copied, ``few`` to each."""
    return _in_cells(many, few, keys, few.columns, buckets, 1)
