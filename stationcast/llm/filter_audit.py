"""What each filter of a chain removes, for every order in which the filters may be applied.

Every filter is a stored table of the ids that fail it. Which documents survive a prefix of a
chain depends on the set of filters in it and not on their order, so the relations are kept per
set: the survivors of a set meet the id table of each further filter, in a left-semi join that
gives what it removes and a left-anti join that gives the survivors of the larger set. The sets
of one size are one relation, joined once and stored, so a lost executor costs one level. Only
documents that some filter fails take part; all others survive everything and are counted.

The keys of the joins are ids of single rows, so no key is hot, and ids alone are shuffled. The
m! orders come in at the end, on the counts per set, filter and part.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.shingles import pieces_of_words
from stationcast.llm.tables import documents, labels, map_slices
from stationcast.session import stage

# Orders are listed, m! of them.
MOST_FILTERS = 8

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))


def word_counts(data: bytes) -> tuple[int, int]:
    """Words, and distinct words."""
    total, seen = 0, set()
    for piece in pieces_of_words(data):
        found = piece.split()
        total += len(found)
        seen.update(found)
    return total, len(seen)


def _without(data: bytes, characters: bytes) -> int:
    return len(data.translate(None, characters))


def text_failures(data: bytes) -> tuple[bool, bool, bool, bool]:
    """Whether a text fails A (short), B (repeats words), C (capitals) and D (symbols)."""
    n_words, n_distinct = word_counts(data)
    capitals = len(data) - _without(data, _UPPER)
    return (
        n_words < 200,
        100 * n_distinct < 50 * n_words,
        100 * capitals > 3 * _without(data, _CONTINUED),
        _without(data, _SYMBOLS) < len(data),
    )


def document_facts(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``part``, ``digest`` of the text, and whether it fails ``A`` to ``D``.

    Stored, because ``row`` numbers the rows as they are read: it tells rows apart that repeat an
    id. A null text is empty, a null ``lang`` is the empty part.
    """

    def look(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = [text_failures(t) for t in texts]
        kept = {n: batch.column(n) for n in ("row", "doc_id", "part")}
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
        columns = zip("ABCD", zip(*found, strict=True), strict=True) if found else ((n, ()) for n in "ABCD")
        return kept | {"digest": pa.array(digests, pa.binary())} | {n: pa.array(c, pa.bool_()) for n, c in columns}

    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    flags = ", ".join(f"{name} boolean" for name in "ABCD")
    return stage(map_slices(given, look, f"row long, doc_id long, part string, digest binary, {flags}"), "facts")


def repeated_texts(facts: DataFrame) -> DataFrame:
    """``row`` of every text that a smaller ``doc_id`` has too; a missing id is not smaller."""
    firsts = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stage(firsts.where("first < last").select("digest", "first"), "firsts")
    return facts.join(firsts, "digest").where("doc_id > first").select("row")


def failing_rows(facts: DataFrame) -> dict[str, DataFrame]:
    """One stored table of ``row`` per filter."""
    failing = {name: facts.where(name).select("row") for name in "ABCD"} | {"E": repeated_texts(facts)}
    return {name: stage(rows, f"fails-{name}") for name, rows in failing.items()}


def with_labels(facts: DataFrame, marks: DataFrame) -> DataFrame:
    """``row`` and ``part`` with ``good`` and ``toxic``: whether any label of the id says so."""
    marks = marks.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    held = facts.select("row", "doc_id", "part").join(marks, "doc_id", "left")
    none = F.lit(False)
    return held.select("row", "part", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _levels(suspects: DataFrame, failing: list[DataFrame]) -> DataFrame:
    """Per ``prefix`` (a set of filters as bits), further ``filter`` and ``part``: how many of the
    survivors it keeps and removes, and the labels it loses."""
    m = len(failing)
    table = _union([rows.select("row").withColumn("filter", F.lit(k)) for k, rows in enumerate(failing)])
    rows = suspects.withColumn("prefix", F.lit(0))
    counts = []
    for level in range(m):
        free = F.filter(
            F.array(*[F.lit(k) for k in range(m)]),
            lambda k: F.expr("prefix").bitwiseAND(F.call_function("shiftleft", F.lit(1), k)) == 0,
        )
        asked = rows.select("row", "prefix", "part", "good", "toxic", F.explode(free).alias("filter"))
        keys = ["row", "filter"]
        removed = asked.join(table, keys, "left_semi").withColumn("removed", F.lit(True))
        kept = asked.join(table, keys, "left_anti").withColumn("removed", F.lit(False))
        met = stage(removed.unionByName(kept), f"prefixes-{level}")
        out = F.col("removed")
        counts.append(
            met.groupBy("prefix", "filter", "part").agg(
                F.count_if(~out).alias("kept"),
                F.count_if(out).alias("removed"),
                F.count_if(out & F.col("good")).alias("good_lost"),
                F.count_if(out & F.col("toxic")).alias("toxic_lost"),
            )
        )
        # A larger set is reached once, by its filters in ascending order.
        added = F.call_function("shiftleft", F.lit(1), F.col("filter"))
        rows = met.where(~out & (F.col("prefix") < added)).select(
            "row", F.col("prefix").bitwiseOR(added).alias("prefix"), "part", "good", "toxic"
        )
    return stage(_union(counts), "counts")


def _zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0)).cast("long").alias(column)


def audit(members: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``members`` has ``row`` (unique), ``part``, ``good`` and ``toxic``; ``failing`` has, for each
    filter by its name of one letter, a table of the ``row`` values that fail it. Returns
    ``part``, ``filter_order``, ``step`` from 1 and the counts: ``kept`` after the step,
    ``removed`` by it, ``redundant`` (fails it, but went earlier), ``unique_fails`` (fails it
    alone), ``good_lost``, ``toxic_lost``, and ``shapley``, its removals over all orders.

    Every part has all rows, zeros included. No members: an empty result. Rows of ``failing``
    that repeat count once, those that are no members not at all; null rows match nothing.
    """
    names = list(failing)
    if not 1 <= len(names) <= MOST_FILTERS or any(len(n) != 1 for n in names):
        raise ValueError(f"give 1 to {MOST_FILTERS} filters named by one letter")
    anything = _union([rows.select("row") for rows in failing.values()])
    suspects = stage(members.join(anything, "row", "left_semi"), "suspects")
    counts = _levels(suspects, list(failing.values()))
    whole = members.groupBy("part").agg(F.count(F.lit(1)).alias("whole"))
    open_rows = suspects.groupBy("part").agg(F.count(F.lit(1)).alias("suspects"))
    parts = whole.join(open_rows, "part", "left").select(
        "part", (F.col("whole") - F.coalesce("suspects", F.lit(0))).alias("clean"), "whole"
    )
    alone = _union(
        [
            counts.where((F.col("filter") == k) & (F.col("prefix") == (1 << len(names)) - 1 - (1 << k)))
            for k in range(len(names))
        ]
    ).select("part", "filter", F.col("removed").alias("unique_fails"))
    first = counts.where("prefix = 0").select("part", "filter", F.col("removed").alias("failed"))

    # As many rows as orders and steps for each part; the parts are few against the documents.
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(names)])
    grid = stage(parts, "parts").select("part", "clean", "whole", F.explode(orders).alias("filter_order"))
    grid = grid.withColumn("step", F.explode(F.array(*[F.lit(k + 1) for k in range(len(names))])))
    place = {n: F.instr("filter_order", n) for n in names}
    prefix, number = F.lit(0), F.lit(0)
    for k, name in enumerate(names):
        prefix = prefix + F.when(place[name] < F.col("step"), 1 << k).otherwise(0)
        number = number + F.when(place[name] == F.col("step"), k).otherwise(0)
    grid = grid.withColumn("prefix", prefix).withColumn("filter", number)
    held = (
        grid.join(counts, ["part", "prefix", "filter"], "left")
        .join(first, ["part", "filter"], "left")
        .join(alone, ["part", "filter"], "left")
    )
    removed = F.coalesce("removed", F.lit(0))
    every = Window.partitionBy("part", "filter")
    return held.select(
        "part",
        "filter_order",
        "step",
        (F.col("clean") + F.coalesce("kept", F.lit(0))).alias("kept"),
        _zero("removed"),
        (F.coalesce("failed", F.lit(0)) - removed).cast("long").alias("redundant"),
        _zero("unique_fails"),
        _zero("good_lost"),
        _zero("toxic_lost"),
        F.sum(removed).over(every).cast("long").alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = document_facts(documents(spark, sf_dir))
    return audit(stage(with_labels(facts, labels(spark, sf_dir)), "members"), failing_rows(facts))


OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), marks AS (
    SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
), failed AS (
    SELECT d.part, coalesce(m.good, FALSE) AS good, coalesce(m.toxic, FALSE) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body)
              THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN min(d.doc_id) OVER (PARTITION BY body) < d.doc_id THEN 'E' ELSE '' END AS fails
    FROM d LEFT JOIN marks m ON d.doc_id = m.doc_id
), grouped AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good,
           count(*) FILTER (WHERE toxic) AS n_toxic
    FROM failed GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS l, substr(filter_order, 1, step - 1) AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), seen AS (
    SELECT g.*, s.*, contains(fails, l) AS fails_this,
           earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]') AS gone
    FROM grouped g, steps s
), counts AS (
    SELECT part, filter_order, step, l,
           coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails_this), 0) AS kept,
           coalesce(sum(n) FILTER (WHERE NOT gone AND fails_this), 0) AS removed,
           coalesce(sum(n) FILTER (WHERE gone AND fails_this), 0) AS redundant,
           coalesce(sum(n) FILTER (WHERE fails = l), 0) AS unique_fails,
           coalesce(sum(n_good) FILTER (WHERE NOT gone AND fails_this), 0) AS good_lost,
           coalesce(sum(n_toxic) FILTER (WHERE NOT gone AND fails_this), 0) AS toxic_lost
    FROM seen GROUP BY part, filter_order, step, l
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counts
"""
