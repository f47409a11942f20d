"""SimHash fingerprints of documents, and the search for all fingerprints within a radius.

The terms of a text are its windows of three words. Each distinct term votes with a weight that
grows with the logarithm of its count: for the bits that its hash has set, against the others.
The signs of the sums are the fingerprint. Two fingerprints that differ in at most r of B > r
blocks' worth of bits agree in at least B - r whole blocks, so the tables hold, for every choice
of B - r blocks, the fingerprints with these blocks moved to the front as the key of a join. For a
large r, blocks are as few as make one of them differ in two bits at most, and the queries ask for
every key that two changed bits lead to.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.shingles import mix, words
from stationcast.llm.tables import documents, id_text, map_slices, partitions, slices
from stationcast.session import stage

TERM_WORDS = 3
BITS = 256
# Bits in which texts of distinct words differ on average at a five-word Jaccard similarity of 0.8:
# 1 of 45 words is changed, so 1 of 15 terms, and 256 * acos(14 / 15) / pi is 29.9.
RADIUS = 29
# Bits for the number of a text in its batch; the others hold a term's hash.
OWNER_BITS = 20
# Terms whose bits are unfolded at once.
TERMS_AT_ONCE = 1 << 14
# One multiplier for each 64 bits of the fingerprint.
SPREAD = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One row of ``BITS`` bits per text, packed into bytes; texts without words give zeros."""
    windows, bounds = words(texts, lower=True).window(TERM_WORDS)
    # Always as many bits, so that a term's hash does not depend on what else is in the batch.
    shift = np.uint64(OWNER_BITS)
    if len(texts) >> OWNER_BITS:
        raise ValueError("too many texts at once")
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(bounds))
    keys = np.sort((owner << (np.uint64(64) - shift)) | (windows >> shift))
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    weights = (1 + np.log(np.diff(np.append(first, len(keys))))).astype(np.float32)
    terms, owner = keys[first] << shift, (keys[first] >> (np.uint64(64) - shift)).astype(np.int64)
    limits = np.searchsorted(owner, np.arange(len(texts) + 1))
    votes = np.zeros((len(texts), BITS), np.float32)
    for text, (a, b) in enumerate(zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)):
        for k in range(a, b, TERMS_AT_ONCE):
            own = terms[k : min(b, k + TERMS_AT_ONCE)]
            spread = np.stack([mix(own * m) for m in SPREAD], axis=1)
            bits = np.unpackbits(spread.view(np.uint8), axis=1).astype(np.float32)
            weight = weights[k : k + len(own)]
            votes[text] += 2 * (weight @ bits) - weight.sum()
    return np.packbits(votes > 0, axis=1)


def likeness(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Estimated cosine of the two texts' weighted terms, from 0 to 1."""
    differ = np.unpackbits(first ^ second, axis=1).sum(axis=1) / BITS
    return np.clip(np.cos(np.pi * differ), 0, 1)


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (bytes) of every whole text; equal texts have equal ones.

    A null, empty or blank text has the fingerprint of zeros; a text of fewer than three words has
    its sequence as only term. Repeated rows are fingerprinted each; other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> dict:
        made = fingerprints(batch.column("text").cast(pa.binary()).to_pylist())
        return {"doc_id": batch.column("doc_id"), "fingerprint": pa.array([f.tobytes() for f in made], pa.binary())}

    return map_slices(id_text(docs), run, "doc_id long, fingerprint binary")


def _block_keys(fingerprint: Column, radius: int, spare: int) -> Column:
    """The permuted tables of a fingerprint: each choice of blocks that must agree, as a key."""
    blocks = radius + spare
    step = BITS // 8 // blocks
    parts = [F.substring(fingerprint, 1 + k * step, step) for k in range(blocks)]
    choices = itertools.combinations(range(blocks), spare)
    return F.array(
        *[
            F.struct(F.lit(n).alias("table"), F.concat(*[parts[k] for k in chosen]).alias("key"))
            for n, chosen in enumerate(choices)
        ]
    )


def _distance(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ."""
    pieces = []
    for k in range(BITS // 32):
        x, y = (F.conv(F.hex(F.substring(c, 1 + 4 * k, 4)), 16, 10).cast("long") for c in (a, b))
        pieces.append(F.bit_count(x.bitwiseXOR(y)))
    total = pieces[0]
    for piece in pieces[1:]:
        total = total + piece
    return total


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 7, spare: int = 1) -> DataFrame:
    """All fingerprints of ``prints`` within ``radius`` bits of those of ``queries``.

    Both have ``doc_id`` and ``fingerprint``. Returns ``query``, ``fingerprint``, ``distance`` and
    ``n_docs``, the documents that bear the fingerprint: equal ones are one row, so a group of
    copies is never listed. There are ``radius`` + ``spare`` blocks, whose number must divide the
    fingerprint's bytes, and one table per choice of ``spare`` of them; a pair that several tables
    find is returned once. No queries or prints: an empty result. Null fingerprints match nothing.
    """
    keys = _block_keys(F.col("fingerprint"), radius, spare)
    distinct = prints.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n_docs")
    )
    table = distinct.select("fingerprint", "n_docs", F.explode(keys).alias("at")).select(
        "fingerprint", "n_docs", "at.table", "at.key"
    )
    asked = queries.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()
    asked = asked.select(F.col("fingerprint").alias("wanted"), F.explode(keys).alias("at")).select(
        "wanted", "at.table", "at.key"
    )
    near = (
        asked.join(table, ["table", "key"])
        .withColumn("distance", _distance("wanted", "fingerprint"))
        .where(F.col("distance") <= radius)
        .select("wanted", "fingerprint", "distance", "n_docs")
        .distinct()
    )
    named = queries.select(F.col("doc_id").alias("query"), F.col("fingerprint").alias("wanted"))
    return named.join(near, "wanted").drop("wanted")


def _block_numbers(fingerprint: Column, blocks: int) -> list[Column]:
    """The blocks as numbers, each with its own number above its bits."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    numbers = []
    for k, (start, end) in enumerate(itertools.pairwise(edges)):
        first, last = start // 8, -(-end // 8)
        held = F.conv(F.hex(F.substring(fingerprint, 1 + first, last - first)), 16, 10).cast("long")
        bits = F.shiftright(held, 8 * last - end).bitwiseAND(F.lit((1 << (end - start)) - 1).cast("long"))
        numbers.append(bits + F.lit(k << 48).cast("long"))
    return numbers


def _keyed(numbers: list[Column], k: int) -> Column:
    """A block as the key of a table, and the bits of the block before it; the first has none."""
    before = F.lit(None) if k == 0 else numbers[k - 1].bitwiseAND(F.lit((1 << 48) - 1).cast("long"))
    kind = "long" if BITS > 31 * len(numbers) else "int"
    return F.struct(numbers[k].alias("key"), before.cast(kind).alias("before"))


def _changed(block: Column, before: Column) -> Callable[[Column], Column]:
    return lambda mask: F.struct(block.bitwiseXOR(mask).alias("key"), before.alias("before"))


def within_wide_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, flips: int = 2) -> DataFrame:
    """``within_radius`` for a radius that leaves no whole block equal.

    Of ``radius // (flips + 1) + 1`` blocks, one differs in ``flips`` bits at most. There is one
    table per block, and a query asks each for all keys that up to ``flips`` changed bits lead to.
    A block may have 48 bits.
    """
    blocks = radius // (flips + 1) + 1
    if BITS > 48 * blocks:
        raise ValueError("too few blocks: take fewer flips")
    distinct = prints.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("n_docs")
    )
    # With each block comes the one before it: a pair that met in that table is not made again.
    numbers = _block_numbers(F.col("fingerprint"), blocks)
    plain = F.explode(F.array(*[_keyed(numbers, k) for k in range(blocks)])).alias("at")
    table = distinct.select("fingerprint", "n_docs", plain).select(
        "fingerprint", "n_docs", "at.key", F.col("at.before").alias("own_before")
    )
    asked = queries.select(F.col("fingerprint").alias("wanted")).where(F.col("wanted").isNotNull()).distinct()
    # A number stands for the fingerprint in the many rows below.
    asked = stage(asked.withColumn("number", F.monotonically_increasing_id()), "asked")
    changed = []
    numbers = _block_numbers(F.col("wanted"), blocks)
    for k, block in enumerate(numbers):
        width = BITS * (k + 1) // blocks - BITS * k // blocks
        masks = [sum(1 << b for b in c) for n in range(flips + 1) for c in itertools.combinations(range(width), n)]
        masks = F.lit(masks).cast("array<bigint>")
        changed.append(F.transform(masks, _changed(block, _keyed(numbers, k)["before"])))
    # Few rows become thousands of times as many here: they are spread first, and never broadcast.
    spread = asked.repartition(partitions(queries.sparkSession), "number")
    probes = spread.select("number", F.explode(F.flatten(F.array(*changed))).alias("at"))
    probes = probes.select("number", F.col("at.key").alias("asked_key"), "at.before")
    met_before = F.bit_count(F.col("before").bitwiseXOR(F.col("own_before"))) <= flips
    first_met = (F.col("asked_key") == F.col("key")) & ~F.coalesce(met_before, F.lit(False))
    near = (
        probes.hint("merge").join(table, first_met)
        .join(asked, "number")
        .withColumn("distance", _distance("wanted", "fingerprint"))
        .where(F.col("distance") <= radius)
        .select("wanted", "fingerprint", "distance", "n_docs")
        .distinct()
    )
    named = queries.select(F.col("doc_id").alias("query"), F.col("fingerprint").alias("wanted"))
    return named.join(near, "wanted").drop("wanted")


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, part int, head string, tail string"
)


def _compared(doc_ids: list, texts: list[str], following: list[str]) -> dict:
    """Fingerprints of texts, and their likeness to the edited and to the following texts."""
    edited = []
    for own, after in zip(texts, following, strict=True):
        half = len(own) // 2
        edited.append((own[: len(own) - half] + after[:half]).encode())
    first = fingerprints([t.encode() for t in texts])
    second = fingerprints(edited)
    third = fingerprints([following[-1].encode()])
    # Each text but the last is followed by the next in the list.
    after = np.concatenate([first[1:], third])
    return {
        "doc_id": pa.array(doc_ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
        "fingerprint": pa.array([f.tobytes() for f in first], pa.binary()),
        "edited_fingerprint": pa.array([f.tobytes() for f in second], pa.binary()),
        "near_edited": pa.array(likeness(first, second)),
        "near_next": pa.array(likeness(first, after)),
    }


def edit_study(docs: DataFrame, files: int) -> DataFrame:
    """Every document's fingerprint, and that of its text with its second half replaced.

    The last half of the code points gives way to the first as many of the next document, by
    descending ``doc_id`` (equal ids by text, missing ids last); the first document follows the
    last. Texts are dealt to ``files`` ranges and sorted once; a task needs its own texts only,
    and the last of each range is completed from the first of the next: one row per range. A null
    text is empty. A single document follows itself. No rows: an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        waiting: tuple[int | None, str] | None = None
        head: str | None = None

        def rows(doc_ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
            made = _compared(doc_ids, texts, following)
            none = pa.nulls(len(texts), pa.string())
            number = pa.array([part] * len(texts), pa.int32())
            return pa.RecordBatch.from_pydict(made | {"part": number, "head": none, "tail": none})

        for piece in slices(batches):
            doc_ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            if waiting:
                doc_ids, texts = [waiting[0], *doc_ids], [waiting[1], *texts]
            else:
                head = texts[0]
            if len(texts) > 1:
                yield rows(doc_ids[:-1], texts[:-1], texts[1:])
            waiting = (doc_ids[-1], texts[-1])
        if waiting:
            fields = {f.split()[0]: None for f in _EDITED.split(", ")}
            last = fields | {"doc_id": waiting[0], "part": part, "head": head, "tail": waiting[1]}
            yield pa.RecordBatch.from_pylist([last], _ARROW)

    order = F.col("doc_id").desc_nulls_last()
    ordered = id_text(docs).repartitionByRange(files, order).sortWithinPartitions(order, "text")
    made = stage(ordered.mapInArrow(run, _EDITED), "edited")

    ends = made.where(F.col("tail").isNotNull())
    # One row per range.
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole))
    ends = ends.select("doc_id", F.col("tail").alias("text"), following.alias("after"))

    def finish(batch: pa.RecordBatch) -> dict:
        rows = zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "after")), strict=True)
        parts = [_compared([i], [t], [a]) for i, t, a in rows]
        return {n: pa.concat_arrays([p[n] for p in parts]) for n in parts[0]}

    columns = _EDITED.split(", part")[0]
    last = map_slices(ends, finish, columns)
    return made.where(F.col("tail").isNull()).drop("part", "head", "tail").unionByName(last)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("part", pa.int32()),
        ("head", pa.string()),
        ("tail", pa.string()),
    ]
)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also ``n_near``: other documents within ``RADIUS`` bits, for ids divisible by 50, else null.

    They are counted per fingerprint, so rows that repeat an id have a number each.
    """
    made = stage(edit_study(documents(spark, sf_dir), partitions(spark)), "study")
    prints = made.select("doc_id", "fingerprint")
    is_asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    # The queries are named by their fingerprints here.
    asked = prints.where(is_asked).select(F.col("fingerprint").alias("doc_id"), "fingerprint").distinct()
    near = within_wide_radius(asked, prints).groupBy("query").agg((F.sum("n_docs") - 1).alias("n_near"))
    # Only the asked rows are dealt by their fingerprints, which copies share.
    counted = made.where(is_asked).join(stage(near, "near"), F.col("fingerprint") == F.col("query"), "left")
    others = made.where(~is_asked).withColumn("n_near", F.lit(None).cast("long"))
    return counted.drop("query").unionByName(others).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )
