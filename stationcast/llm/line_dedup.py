"""Removal of lines that repeat across documents, in built-in Spark functions only.

Lines are compared by 128 bits of hash of their key. The occurrences are dealt by hash and
sorted by document, the largest first; only those in the first few documents of a hash are
streamed on (``WindowGroupLimit``), once in every map task before the shuffle and once after
it. So a line that a third of all documents hold sends a few rows per task, and no task ever
holds its whole group. The repeated hashes are written to the shared folder; then they meet
the occurrences in a join whose hot keys adaptive execution splits, and what is left out comes back as a run-length compressed keep
bitmap per document, not as text.

Spark deals the occurrences by a hash of the line hash instead of by ranges of it: either way a
uniform value is dealt evenly, but only the former lets the limit run before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.tables import documents
from stationcast.session import stage

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A to Z lowered."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def filled_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_lines(text: str = "text") -> Column:
    """The lines of a text; a missing or empty one has one empty line."""
    return F.split(filled_text(text), "\n", -1)


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that is long enough: its hash in two halves, and where it stands.

    ``row_hash`` tells rows apart that repeat a ``doc_id`` with another text.
    """
    lines = docs.select(
        F.col("doc_id"), F.xxhash64(filled_text()).alias("row_hash"), text_lines().alias("lines")
    ).select(
        "doc_id",
        "row_hash",
        F.size("lines").alias("n_lines"),
        F.posexplode("lines").alias("position", "line"),
    )
    long = lines.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= min_chars)
    return long.withColumn("line", line_key(F.col("line"))).select(
        F.xxhash64(F.col("line")).alias("h1"),
        F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
        "doc_id",
        "row_hash",
        "n_lines",
        "position",
    )


def repeated_lines(occurrences: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents, with the largest of these documents."""
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").desc())
    return (
        occurrences.select("h1", "h2", "doc_id")
        .withColumn("nth", F.dense_rank().over(order))
        .where(F.col("nth") <= min_docs)
        .groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("last_doc"), F.max("nth").alias("found"))
        .where(F.col("found") == min_docs)
        .select("h1", "h2", "last_doc")
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Which lines stay, for every document that loses some.

    A line's key is the line without blanks at both ends and with A to Z lowered. Keys of at
    least ``min_chars`` code points found in at least ``min_docs`` documents stay only in the
    largest ``doc_id`` that holds them, there at all their places. Returns ``doc_id``,
    ``row_hash`` (of the text), ``n_lines``, ``n_dropped`` and ``keep_runs``, the set bits of the
    keep bitmap as runs of ``start`` and ``length``.

    Null or empty text: one empty line, never dropped by a positive ``min_chars``. Rows that
    repeat a ``doc_id`` are one document; each distinct text of it gets its own bitmap. A
    missing ``doc_id`` counts as the smallest. No rows: an empty result. Other columns of
    ``docs`` are neither read nor returned.
    """
    found = _occurrences(docs, min_chars)
    repeated = stage(repeated_lines(found, min_docs), "repeated-lines")
    dropped = found.join(repeated, ["h1", "h2"]).where(
        F.coalesce(F.col("doc_id") < F.col("last_doc"), F.col("last_doc").isNotNull())
    )
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("dropped")),
        lambda i: F.struct(
            F.coalesce(F.get("dropped", i - 1) + 1, F.lit(0)).alias("start"),
            F.coalesce(F.get("dropped", i), F.col("n_lines")).alias("stop"),
        ),
    )
    runs = F.transform(
        F.filter(gaps, lambda gap: gap["stop"] > gap["start"]),
        lambda gap: F.struct(
            gap["start"].alias("start"), (gap["stop"] - gap["start"]).alias("length")
        ),
    )
    return (
        dropped.groupBy("doc_id", "row_hash", "n_lines")
        .agg(F.array_sort(F.collect_set("position")).alias("dropped"))
        .select(
            "doc_id",
            "row_hash",
            "n_lines",
            F.size("dropped").alias("n_dropped"),
            runs.alias("keep_runs"),
        )
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, dropped: str | None = None) -> DataFrame:
    """``docs`` with only the kept lines in ``text``, joined by line feeds.

    All columns and rows stay; a document without a bitmap keeps its text as it is, also a
    missing one. ``dropped`` names a column to add: the number of lines left out.
    """
    kept = bitmaps.select(
        F.col("doc_id").alias("__id"),
        F.col("row_hash").alias("__row"),
        F.col("n_dropped").alias("__dropped"),
        F.col("keep_runs").alias("__runs"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__row"))
    lines = text_lines()
    rest = F.array_join(
        F.flatten(F.transform("__runs", lambda run: F.slice(lines, run["start"] + 1, run["length"]))),
        "\n",
    )
    text = F.when(F.col("__runs").isNull(), F.col("text")).otherwise(rest)
    columns = [text.alias("text") if name == "text" else F.col(f"`{name}`") for name in docs.columns]
    if dropped:
        columns.append(F.coalesce("__dropped", F.lit(0)).alias(dropped))
    joined = docs.withColumn("__hash", F.xxhash64(filled_text())).join(kept, same, "left")
    return joined.select(*columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.size(text_lines()).cast("long").alias("n_lines")
    )
    return apply_bitmaps(docs, keep_bitmaps(docs), dropped="dropped").select(
        "doc_id",
        "n_lines",
        F.col("dropped").cast("long").alias("n_dropped"),
        F.sha2(filled_text().cast("binary"), 256).alias("kept_sha256"),
    )


OP3_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position
    FROM documents
), keyed AS (
    SELECT doc_id, line, position,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
), repeated AS (
    SELECT line_key, max(doc_id) AS last_doc
    FROM keyed
    WHERE length(line_key) >= 20
    GROUP BY line_key
    HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.line, k.position, r.line_key IS NOT NULL AND k.doc_id < r.last_doc AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), ''))
           AS kept_sha256
FROM marked
GROUP BY doc_id
"""
