"""Stupid-backoff scores of documents, with n-gram counts over the whole corpus.

An n-gram seen ``min_count`` times or more scores its count over its context's count; otherwise
the next shorter one stands for it, at a ``backoff`` factor. Single words score their count over
the number of words. In logarithms, what a word gains by a longer n-gram over the shorter one does
not depend on the document. So all is done by tables and joins:

1. Texts become n-grams of all orders as 64-bit hashes, each distinct one of a batch of texts once
   with its number. They are counted by hash; those that do not repeat are left out. An n-gram's
   hash is made of its context's and its shorter one's.
2. The count tables are joined with each other, order by order: context's count, score of the
   shorter n-gram, and the ``gain`` over it.
3. Texts become n-grams again, each distinct one of a document once with its number. They are joined
   with the gains and summed per document. A hot n-gram has one entry per document.

All these tables are partitioned by ``bucket``, a share of the hashes, and a row holds the n-grams
that a task has for a bucket: each column is binary and holds their numbers one after the other, as
rows of two or three numbers cost several times as much. Spark groups and cogroups by bucket, and
the groups are counted, joined and summed in numpy. There are as many buckets as shuffle
partitions, so raising these bounds what a task holds.

The hashes are dealt to a fixed number of ``passes`` as well, one after the other, so that the
n-grams of one pass only are on the disks at a time. The texts are read in each, and not stored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.shingles import mix, words
from stationcast.llm.tables import documents, id_text, map_slices, partitions
from stationcast.session import scratch_path, stage, staging


# Bits of a hash that hold the number of words.
MOST_WORDS = 7
# Columns of the tables of scores, by bucket.
LEVEL = "bucket int, grams binary, n binary, scores binary, gains binary"
GAINS = ["bucket", "grams", "gains"]
# Bits of a hash below those that tell the bucket.
BUCKET_BITS = 40


@dataclass(frozen=True)
class Backoff:
    """``order``: words of the longest n-grams, seven at most."""

    order: int = 3
    backoff: float = 0.4
    min_count: int = 2
    passes: int = 4


def _joined(context: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """The hashes of n-grams, of those of their contexts and shorter ones. The lowest bits of a hash
    hold the number of words, so it needs no column.
    """
    k = (shorter & np.uint64(MOST_WORDS)) + np.uint64(1)
    return (mix(context * np.uint64(0x9E3779B97F4A7C15) + shorter) & ~np.uint64(MOST_WORDS)) | k


def grams(texts: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the 1- to ``order``-grams that end at each word; how many words stand in the text
    before it; and the bounds of the texts. Longer grams are valid from the word on that ends one.
    """
    found = words([text.lower() for text in texts])
    counts = np.diff(found.bounds)
    place = np.arange(len(found.hashes)) - np.repeat(found.bounds[:-1], counts)
    out = [(found.hashes & ~np.uint64(MOST_WORDS)) | np.uint64(1)]
    for _ in range(1, order):
        before = np.concatenate([np.zeros(1, np.uint64), out[-1][:-1]])[: len(place)]
        out.append(_joined(before, out[-1]))
    return out, place, found.bounds


def _pass(own: np.ndarray, how: Backoff) -> np.ndarray:
    return (own >> np.uint64(32)) % np.uint64(how.passes)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _firsts(*ordered: np.ndarray) -> np.ndarray:
    """Where a value, or a value of any of several columns, differs from the one before."""
    changed = functools.reduce(np.logical_or, (c[1:] != c[:-1] for c in ordered))
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered[0])), bool), changed]))


def _runs(first: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(first, total)).astype(np.int32)


def _small(values: np.ndarray, below: int) -> np.ndarray:
    """In two bytes where they fit: numpy sorts these by radix."""
    return values.astype(np.uint16 if below <= 1 << 16 else np.uint32)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(BUCKET_BITS)) % np.uint64(buckets)


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers between one bound and the next as the bytes of a row."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), data])


def _bounds(blobs: pa.Array) -> np.ndarray:
    return np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset : blobs.offset + len(blobs) + 1]


def _ends(blobs: pa.Array) -> np.ndarray:
    """The bounds of the rows in what ``_numbers`` returns, for numbers of eight bytes."""
    bounds = _bounds(blobs)
    return (bounds - bounds[0]) // 8


def _numbers(column: pa.ChunkedArray | pa.Array, kind: type = np.uint64) -> np.ndarray:
    """The numbers of all rows one after the other."""
    parts = [np.zeros(0, kind)]
    for blobs in getattr(column, "chunks", [column]):
        if len(blobs) and blobs.buffers()[2] is not None:
            bounds = _bounds(blobs)
            parts.append(np.frombuffer(blobs.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view(kind))
    return np.concatenate(parts)


def _dealt(bucket: np.ndarray, buckets: int, columns: dict[str, np.ndarray]) -> dict:
    """A row for each bucket with the numbers of the columns, in the order they have."""
    bucket = _small(bucket, buckets)
    at = np.argsort(bucket, kind="stable")
    first = _firsts(bucket[at])
    bounds = np.append(first, len(at))
    return {"bucket": bucket[at][first].astype(np.int32)} | {n: _blobs(c[at], bounds) for n, c in columns.items()}


def _only(df: DataFrame, by: str, test: Callable[[dict], np.ndarray]) -> DataFrame:
    """The numbers at the places that ``test`` is true for, dealt by the hashes in column ``by``.

    ``test`` is given the binary columns. What a task reads together becomes one row for each bucket.
    """
    buckets = partitions(df.sparkSession)
    kept = df.schema.names[1:]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: _numbers(batch.column(name)) for name in kept}
            chosen = np.flatnonzero(test(columns))
            columns = {name: c[chosen] for name, c in columns.items()}
            yield pa.RecordBatch.from_pydict(_dealt(_bucket(columns[by], buckets), buckets, columns))

    return df.mapInArrow(choose, df.schema)


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``known`` (any order, distinct) holds what is asked, and whether it does."""
    order, turn = np.argsort(known), np.argsort(asked)
    place = np.zeros(len(asked), np.int64)
    if not len(known):
        return place, np.zeros(len(asked), bool)
    # In ascending order both stay in the processor's cache.
    place[turn] = np.minimum(np.searchsorted(known[order], asked[turn]), len(known) - 1)
    place = order[place]
    return place, known[place] == asked


def _summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else values[:0]


def _table(columns: dict) -> pa.Table:
    return pa.table({name: pa.array(c) for name, c in columns.items()})


def _batch_grams(texts: DataFrame, how: Backoff, number: int) -> DataFrame:
    """``context``, ``shorter`` and ``times`` of the grams of a pass, once per batch, by bucket.

    A single word has no context but 0, and itself for the shorter one.
    """
    buckets = partitions(texts.sparkSession)

    def count(batch: pa.RecordBatch) -> dict:
        hashes, place, _ = grams(_texts(batch), how.order)
        parts = []
        for k, own in enumerate(hashes):
            at = np.flatnonzero((place >= k) & (_pass(own, how) == number))
            shorter = hashes[max(0, k - 1)]
            context = shorter[at - 1] if k else np.zeros(len(at), np.uint64)
            parts.append((own[at], context, shorter[at]))
        own, context, shorter = (np.concatenate(p) for p in zip(*parts, strict=True))
        at = np.argsort(own)
        first = _firsts(own[at])
        some = at[first]
        columns = {"context": context[some], "shorter": shorter[some], "times": _runs(first, len(at))}
        return _dealt(_bucket(own[some], buckets), buckets, columns)

    return map_slices(texts, count, "bucket int, context binary, shorter binary, times binary")


def _in_texts(batch: pa.RecordBatch, how: Backoff, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, gram and number of the distinct grams of a pass in each text; those of a text together."""
    hashes, place, bounds = grams(_texts(batch), how.order)
    owner = np.repeat(_small(np.arange(len(bounds) - 1), len(bounds)), np.diff(bounds))
    parts = []
    for k, own in enumerate(hashes):
        at = np.flatnonzero((place >= k) & (_pass(own, how) == number))
        parts.append((owner[at], own[at]))
    owner, own = (np.concatenate(p) for p in zip(*parts, strict=True))
    at = np.argsort(own)
    at = at[np.argsort(owner[at], kind="stable")]
    owner, own = owner[at], own[at]
    first = _firsts(own, owner)
    rows = batch.column("row").to_numpy(zero_copy_only=False)
    return rows[owner[first]], own[first], _runs(first, len(at))


def _document_grams(texts: DataFrame, how: Backoff, number: int) -> DataFrame:
    """``rows``, ``grams`` and ``times``: the distinct grams of a pass in each text, by bucket."""
    buckets = partitions(texts.sparkSession)

    def spread(batch: pa.RecordBatch) -> dict:
        rows, own, times = _in_texts(batch, how, number)
        return _dealt(_bucket(own, buckets), buckets, {"rows": rows, "grams": own, "times": times})

    return map_slices(texts, spread, "bucket int, rows binary, grams binary, times binary")


def _document_rows(texts: DataFrame, how: Backoff, number: int) -> DataFrame:
    """``row``, ``gram`` and ``times``: the same with a row for each gram, for use outside this module."""

    def spread(batch: pa.RecordBatch) -> dict:
        rows, own, times = _in_texts(batch, how, number)
        return {"row": rows, "gram": own.view(np.int64), "times": times}

    return map_slices(texts, spread, "row long, gram long, times int")


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def count_tables(texts: DataFrame, how: Backoff) -> DataFrame:
    """The counts of all words, and of longer grams that repeat, as ``n`` with ``context`` and
    ``shorter``; stored by bucket.
    """
    buckets = partitions(texts.sparkSession)

    def total(table: pa.Table) -> pa.Table:
        context, shorter = _numbers(table["context"]), _numbers(table["shorter"])
        own = np.where(context == 0, shorter, _joined(context, shorter))
        at = np.argsort(own)
        first = _firsts(own[at])
        n = _summed(_numbers(table["times"], np.int32)[at].astype(np.int64), first)
        some = at[first]
        kept = (context[some] == 0) | (n >= how.min_count)
        context, shorter, n = context[some[kept]], shorter[some[kept]], n[kept]
        by = _bucket(own[at[first]][kept], buckets)
        return _table(_dealt(by, buckets, {"context": context, "shorter": shorter, "n": n}))

    tables = []
    for number in range(how.passes):
        grouped = _batch_grams(texts.select("text"), how, number).groupBy("bucket")
        tables.append(stage(grouped.applyInArrow(total, "bucket int, context binary, shorter binary, n binary"), "counts"))
    return _union(tables)


def _next_level(own: DataFrame, level: DataFrame, how: Backoff) -> DataFrame:
    """Grams one word longer than those of ``level``, from their counts: joined by context, then by
    the shorter gram.

    A gram that repeats has a context and a shorter gram that repeat as well, so both are found.
    """
    buckets = partitions(own.sparkSession)

    def by_context(own: pa.Table, level: pa.Table) -> pa.Table:
        context, shorter, n = _numbers(own["context"]), _numbers(own["shorter"]), _numbers(own["n"], np.int64)
        place, _ = _find(_numbers(level["grams"]), context)
        score = np.log(n / _numbers(level["n"], np.int64)[place]) if len(n) else np.zeros(0)
        columns = {"shorter": shorter, "grams": _joined(context, shorter), "n": n, "scores": score}
        return _table(_dealt(_bucket(shorter, buckets), buckets, columns))

    def by_shorter(own: pa.Table, level: pa.Table) -> pa.Table:
        made, score = _numbers(own["grams"]), _numbers(own["scores"], np.float64)
        place, _ = _find(_numbers(level["grams"]), _numbers(own["shorter"]))
        under = _numbers(level["scores"], np.float64)[place] if len(score) else score
        gain = score - under - math.log(how.backoff)
        columns = {"grams": made, "n": _numbers(own["n"]), "scores": score, "gains": gain}
        return _table(_dealt(_bucket(made, buckets), buckets, columns))

    level = level.drop("gains").groupBy("bucket")
    schema = "bucket int, shorter binary, grams binary, n binary, scores binary"
    scored = own.groupBy("bucket").cogroup(level).applyInArrow(by_context, schema).groupBy("bucket")
    return scored.cogroup(level).applyInArrow(by_shorter, LEVEL)


def _has_words(columns: dict[str, np.ndarray], k: int) -> np.ndarray:
    return (columns["context"] != 0) & (columns["shorter"] & np.uint64(MOST_WORDS) == np.uint64(k - 1))


def gain_tables(counts: DataFrame, how: Backoff, paths: list[str]) -> DataFrame:
    """``grams`` and ``gains`` by ``bucket``; a gain is what a gram adds to the logarithm of the score of
    its shorter one. Stored order by order in ``paths``."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [int(_numbers(batch.column("n"), np.int64).sum())]})

    single = stage(_only(counts, "shorter", lambda c: c["context"] == 0), "words")
    # One number: the words of the corpus.
    total = single.select("n").mapInArrow(words_of, "n long").agg(F.sum("n")).first()[0] or 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n")
            scores = _blobs(np.log(_numbers(n, np.int64) / total), _ends(n))
            made = [batch.column("bucket"), batch.column("shorter"), n, scores, scores]
            yield pa.RecordBatch.from_arrays(made, names=["bucket", "grams", "n", "scores", "gains"])

    level = stage(single.select("bucket", "shorter", "n").mapInArrow(score, LEVEL), "level", paths[0])
    gains = [level]
    for k in range(2, how.order + 1):
        own = _only(counts, "context", functools.partial(_has_words, k=k))
        made = _next_level(own, level, how)
        # No order follows the last, so its gains alone are kept.
        level = stage(made if k < how.order else made.select(GAINS), "level", paths[k - 1])
        gains.append(level)
    return _union([g.select(GAINS) for g in gains])


def _stored_gains(texts: DataFrame, how: Backoff) -> DataFrame:
    """The gains; the counts they are made of go from the disks."""
    spark = texts.sparkSession
    paths = [scratch_path(spark, "gains") for _ in range(how.order)]
    with staging(spark):
        return gain_tables(count_tables(texts, how), how, paths)


def _sums(texts: DataFrame, gains: DataFrame, how: Backoff, number: int) -> DataFrame:
    """``row``, ``gained`` and ``words``: sums over the grams of a pass in each text."""
    buckets = partitions(texts.sparkSession)

    def added(row: np.ndarray, columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        at = np.argsort(row)
        first = _firsts(row[at])
        return {"row": row[at[first]]} | {n: _summed(c[at], first) for n, c in columns.items()}

    def met(entries: pa.Table, gains: pa.Table) -> pa.Table:
        row, own = _numbers(entries["rows"]), _numbers(entries["grams"])
        place, found = _find(_numbers(gains["grams"]), own)
        row, own, times = row[found], own[found], _numbers(entries["times"], np.int32)[found].astype(np.int64)
        # A text of a batch has its grams side by side, equal texts of several batches have not.
        first = _firsts(row)
        sums = added(row[first], {
            "gained": _summed(times * _numbers(gains["gains"], np.float64)[place[found]], first),
            "words": _summed(np.where(own & np.uint64(MOST_WORDS) == 1, times, 0), first),
        })
        return _table(_dealt(_bucket(sums["row"], buckets), buckets, sums))

    def whole(table: pa.Table) -> pa.Table:
        columns = {"gained": _numbers(table["gained"], np.float64), "words": _numbers(table["words"], np.int64)}
        sums = added(_numbers(table["row"]), columns)
        return _table(sums | {"row": sums["row"].view(np.int64)})

    known = _only(gains, "grams", lambda c: _pass(c["grams"], how) == number).groupBy("bucket")
    parts = _document_grams(texts, how, number).groupBy("bucket").cogroup(known).applyInArrow(
        met, "bucket int, row binary, gained binary, words binary"
    )
    return parts.groupBy("bucket").applyInArrow(whole, "row long, gained double, words long")


def corpus_scores(docs: DataFrame, how: Backoff = Backoff()) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` and ``mean_log_score`` of every whole text.

    Words are runs outside the ASCII blanks with A to Z lowered. ``log_score`` is the sum of the
    natural logarithms of the words' scores, the mean is per word. A null, empty or blank text
    has 0 words and a score and mean of 0. Every row counts and is scored, also a repeated one.
    Other columns are not read. No rows: an empty result. A batch holds at least one text whole.
    Rows are told apart by a 64-bit hash of the text, on which alone a score depends: the sums of
    equal texts are made together and divided by their number.
    """
    given = id_text(docs).withColumn("row", F.xxhash64("text"))
    texts = given.select("row", "text")
    gains = _stored_gains(texts, how)
    sums = [stage(_sums(texts, gains, how, number), "sums") for number in range(how.passes)]
    whole = _union(sums).groupBy("row").agg(F.sum("gained").alias("gained"), F.sum("words").alias("words"))
    copies = given.groupBy("row").agg(F.count("*").alias("copies"))
    # A word that could end a gram of k words starts with k - 1 factors, which each gain takes back.
    n, order = F.col("n_words"), how.order
    each = copies.join(whole, "row", "left").select(
        "row",
        F.coalesce(F.expr("words div copies"), F.lit(0)).alias("n_words"),
        (F.col("gained") / F.col("copies")).alias("gained"),
    )
    short = F.least(n, F.lit(order))
    factors = short * (short - 1) / 2 + (n - short) * (order - 1)
    log_score = F.coalesce("gained", F.lit(0.0)) + factors * F.lit(math.log(how.backoff))
    return given.select("doc_id", "row").join(each, "row").select(
        "doc_id",
        "n_words",
        log_score.alias("log_score"),
        F.coalesce(F.try_divide(log_score, F.col("n_words")), F.lit(0.0)).alias("mean_log_score"),
    )


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = corpus_scores(documents(spark, sf_dir))
    return scored.select(
        "doc_id",
        "n_words",
        F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 6).alias("mean_log_score"),
    )


OP2_SQL = r"""
WITH lists AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), tokens AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM lists
), chains AS (
    SELECT doc_id, word, lag(word) OVER w AS before, lag(word, 2) OVER w AS first
    FROM tokens WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), single AS (
    SELECT word, count(*) AS n FROM tokens GROUP BY word
), two AS (
    SELECT before, word, count(*) AS n FROM chains WHERE before IS NOT NULL GROUP BY before, word
), three AS (
    SELECT first, before, word, count(*) AS n FROM chains WHERE first IS NOT NULL GROUP BY first, before, word
), scored AS (
    SELECT p.doc_id,
           CASE WHEN h.n >= 2 THEN ln(h.n / f.n::DOUBLE)
                WHEN t.n >= 2 THEN ln(t.n / c.n::DOUBLE) + CASE WHEN p.first IS NULL THEN 0 ELSE ln(0.4) END
                ELSE ln(s.n / (SELECT count(*) FROM tokens)::DOUBLE)
                     + CASE WHEN p.before IS NULL THEN 0 WHEN p.first IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END
           END AS score
    FROM chains p JOIN single s ON p.word = s.word
    LEFT JOIN three h ON p.first = h.first AND p.before = h.before AND p.word = h.word
    LEFT JOIN two f ON p.first = f.before AND p.before = f.word
    LEFT JOIN two t ON p.before = t.before AND p.word = t.word
    LEFT JOIN single c ON p.before = c.word
), sums AS (
    SELECT doc_id, count(*) AS n_words, sum(score) AS log_score FROM scored GROUP BY doc_id
)
SELECT l.doc_id, coalesce(s.n_words, 0) AS n_words, round(coalesce(s.log_score, 0), 4) AS log_score,
       round(coalesce(s.log_score / s.n_words, 0), 6) AS mean_log_score
FROM lists l LEFT JOIN sums s ON l.doc_id = s.doc_id
"""
