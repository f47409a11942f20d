"""Token files in a word-aligned code: a selector and as many ids as fit per 64-bit word.

A word has a selector in its upper four bits and 60 bits of data. Selector s < 14 holds
``COUNTS[s]`` values of ``WIDTHS[s]`` bits, the first in the lowest bits; ``RUN`` holds a run of
one value (28 bits of length, 32 of value); ``ESCAPE`` is followed by a word with one value of
up to 64 bits. Values are coded in blocks of ``BLOCK``, each of which starts a new word, and a
segment lists the first word of every block. So coding and decoding step through all blocks of a
segment side by side, one word of each at a time.

A token file is a folder of segments, stored as Parquet rows that Spark commits: documents in
ascending order of ``doc_id``, each segment with its documents' ids, their token counts and the
coded tokens. Nothing is held in memory beyond a segment and a batch of text.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.chunks import LETTERS, ChunkCoder, model_ids
from stationcast.llm.tables import documents, id_text, partitions, slices
from stationcast.session import scratch_path

COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = 60 // COUNTS
RUN, ESCAPE = 14, 15
BLOCK = 128
# A run takes this many equal values at least, so that it beats the packed form of any width.
LEAST_RUN = 61
SEGMENT_IDS = 1 << 18
MAGIC = np.uint64(0x31423853)


_LIMITS = np.array([1 << int(w) for w in WIDTHS], dtype=np.uint64)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8)


def _needs(values: np.ndarray) -> np.ndarray:
    """The first selector that is wide enough for each value, past the last if none is."""
    if values.max() < len(_SMALL):
        return _SMALL[values.astype(np.int64)]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.int8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code unsigned values; the words, and the first word of each block."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = values
    stops = np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)
    left = (np.repeat(stops, BLOCK) - np.tile(np.arange(BLOCK), blocks)).astype(np.int16)

    # best[i]: the selector of a word that starts at value i; top: the widest need of a window.
    need = _needs(flat)
    best = np.full(len(flat), ESCAPE, np.int8)
    tops = {1: need}
    for size in (2, 4, 8, 16, 32):
        half = tops[size // 2]
        tops[size] = np.maximum(half, np.append(half[size // 2 :], half[: size // 2]))
    for s in range(len(COUNTS) - 1, -1, -1):
        k = int(COUNTS[s])
        size = 1 << (k.bit_length() - 1)
        top = tops[size]
        if k > size:
            top = np.maximum(top, np.append(top[k - size :], top[: k - size]))
        best[(top <= s) & (left >= k)] = s
    changes = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1, [len(flat)]])
    lengths = np.diff(changes)
    same = np.zeros(0, np.int64)
    if lengths.max() >= LEAST_RUN:
        same = np.minimum(np.repeat(changes[1:], lengths) - np.arange(len(flat)), left)
        best[(same >= LEAST_RUN) & (flat < (np.uint64(1) << np.uint64(32)))] = RUN

    rows, at = np.arange(blocks), np.zeros(blocks, np.int64)
    used = np.zeros(blocks, np.int64)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        here = rows * BLOCK + at
        kind = best[here].astype(np.int64)
        word = kind.astype(np.uint64) << np.uint64(60)
        step = np.ones(len(rows), np.int64)
        for s in np.unique(kind).tolist():
            of = np.flatnonzero(kind == s)
            cell = here[of]
            if s == RUN:
                step[of] = same[cell]
                word[of] |= (step[of].astype(np.uint64) << np.uint64(32)) | flat[cell]
            elif s != ESCAPE:
                k, width = int(COUNTS[s]), np.uint64(WIDTHS[s])
                step[of] = k
                packed = flat[cell[:, None] + np.arange(k)]
                word[of] |= np.bitwise_or.reduce(
                    packed << (np.arange(k, dtype=np.uint64) * width), axis=1
                )
        steps.append((rows, used[rows].copy(), word))
        used[rows] += 1
        if (escaped := np.flatnonzero(kind == ESCAPE)).size:
            own = rows[escaped]
            steps.append((own, used[own].copy(), flat[here[escaped]]))
            used[own] += 1
        at = at + step
        going = at < stops[rows]
        rows, at = rows[going], at[going]
    firsts = np.cumsum(used) - used
    words = np.zeros(int(used.sum()), np.uint64)
    for own, place, word in steps:
        words[firsts[own] + place] = word
    return words, firsts.astype(np.uint32)


def unpack(words: np.ndarray, firsts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of coded blocks."""
    blocks = len(firsts)
    out = np.zeros(blocks * BLOCK, np.uint64)
    stops = np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)
    rows, at, place = np.arange(blocks), np.zeros(blocks, np.int64), firsts.astype(np.int64)
    data = np.uint64((1 << 60) - 1)
    while len(rows):
        word = words[place]
        kind = (word >> np.uint64(60)).astype(np.int64)
        step = np.ones(len(rows), np.int64)
        place = place + 1
        for s in np.unique(kind).tolist():
            of = np.flatnonzero(kind == s)
            cell = rows[of] * BLOCK + at[of]
            if s == RUN:
                body = word[of] & data
                step[of] = (body >> np.uint64(32)).astype(np.int64)
                many = np.repeat(cell - (np.cumsum(step[of]) - step[of]), step[of])
                out[many + np.arange(len(many))] = np.repeat(body & np.uint64(0xFFFFFFFF), step[of])
            elif s == ESCAPE:
                out[cell] = words[place[of]]
                place[of] += 1
            else:
                k, width = int(COUNTS[s]), np.uint64(WIDTHS[s])
                step[of] = k
                mask = (np.uint64(1) << width) - np.uint64(1)
                fields = (word[of][:, None] >> (np.arange(k, dtype=np.uint64) * width)) & mask
                out[cell[:, None] + np.arange(k)] = fields
        at = at + step
        going = at < stops[rows]
        rows, at, place = rows[going], at[going], place[going]
    return out[:n]


def segment_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: a header, documents' ids and token counts, block offsets, words."""
    words, firsts = pack(ids)
    header = np.array([MAGIC, len(doc_ids), len(ids), len(firsts), len(words)], np.uint64)
    padded = firsts if len(firsts) % 2 == 0 else np.append(firsts, np.uint32(0))
    parts = (header, doc_ids.astype("<i8"), counts.astype("<u8"), padded.astype("<u4"), words)
    return b"".join(p.tobytes() for p in parts)


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' ids, their token counts, and all their tokens."""
    header = np.frombuffer(data, "<u8", 5)
    if header[0] != MAGIC:
        raise ValueError("not a segment of a token file")
    docs, n, blocks, size = (int(x) for x in header[1:])
    at = 40
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    counts = np.frombuffer(data, "<u8", docs, at := at + 8 * docs).astype(np.int64)
    firsts = np.frombuffer(data, "<u4", blocks, at := at + 8 * docs)
    words = np.frombuffer(data, "<u8", size, at + 4 * (blocks + blocks % 2))
    return doc_ids, counts, unpack(words, firsts, n)


_LETTERS = re.compile(" ?" + LETTERS)


@functools.cache
def _library_coder(path: str) -> ChunkCoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def by_library(strings: list[str]) -> list[bytes]:
        found = []
        for k in range(0, len(strings), 20_000):
            done = tokenizer.encode_batch_fast(strings[k : k + 20_000], add_special_tokens=False)
            found += [np.array(e.ids, dtype=np.uint32).tobytes() for e in done]
        return found

    # A run of letters behind a blank or none goes straight to the model, if that is how it is coded.
    probes = ["Word", " word", " Stra\u00dfe", "\u00e9t\u00e9", " \u017bywi\u0119cie"]
    direct = model_ids(tokenizer, probes) == by_library(probes)

    def code(strings: list[str]) -> list[bytes]:
        letters = [s for s in strings if direct and _LETTERS.fullmatch(s)]
        coded = dict(zip(letters, model_ids(tokenizer, letters), strict=True))
        rest = [s for s in strings if s not in coded]
        coded |= zip(rest, by_library(rest), strict=True)
        return [coded[s] for s in strings]

    return ChunkCoder(code)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, files: int) -> None:
    """Encode every whole text and write the ids, each text's followed by ``end_id``.

    Rows go to ``files`` parts by ranges of ``doc_id`` and are sorted there, equal ids by text;
    a missing ``doc_id`` sorts first and is stored as the smallest long. A null or empty text
    has the end id alone. Other columns are not read. No rows: a folder without segments.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number = size = 0

        def flush() -> pa.RecordBatch:
            doc_ids, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "segment": pa.array([number], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "data": pa.array([segment_bytes(doc_ids, counts, ids)], pa.binary()),
                }
            )

        for piece in slices(batches):
            doc_ids = piece.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            ids, bounds = _library_coder(path).encode(piece.column("text"))
            counts = np.diff(bounds) + 1
            ended = np.insert(ids, bounds[1:], end_id)
            held.append((doc_ids, counts, ended))
            size += len(ended)
            if size >= SEGMENT_IDS:
                yield flush()
                number, size, held = number + 1, 0, []
        if held:
            yield flush()

    ordered = (
        id_text(docs)
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    stored = ordered.mapInArrow(segments, "part int, segment long, n_ids long, data binary")
    stored.write.option("compression", "zstd").parquet(folder)


def _stored_documents(batch: pa.RecordBatch) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """For each segment: the columns that place its documents, their bounds, and all ids."""
    rows = zip(*(batch.column(n).to_pylist() for n in ("part", "segment", "data")), strict=True)
    for part, segment, data in rows:
        doc_ids, counts, ids = read_segment(data)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        yield {
            "part": np.full(len(doc_ids), part, np.int32),
            "segment": np.full(len(doc_ids), segment, np.int64),
            "doc_id": doc_ids,
            "offset": bounds[:-1],
        }, bounds, ids


_PLACES = "part int, segment long, doc_id long, offset long"


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a token file: its place in the order, and its ids.

    Columns ``part``, ``segment``, ``doc_id``, ``offset`` (ids before it in its segment) and
    ``token_ids``.
    """

    def documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, bounds, ids in _stored_documents(batch):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_pydict({**places, "token_ids": lists})

    stored = spark.read.parquet(folder).select("part", "segment", "data")
    return stored.mapInArrow(documents_of, f"{_PLACES}, token_ids array<long>")


def segment_starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each segment: a running sum inside a part, and one over the parts' totals.

    Only one row per part, of which the writer makes a given number, meets in one task.
    """
    heads = spark.read.parquet(folder).select("part", "segment", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        heads.groupBy("part")
        .agg(F.sum("n_ids").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start"))
    )
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (
        heads.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "segment", (F.col("part_start") + F.col("inside")).alias("segment_start"))
    )


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a token file: where its ids start, how many, and their crc32.

    The segments are read back, and only the sums of a document's ids leave the task.
    """

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, bounds, ids in _stored_documents(batch):
                raw, edges = ids.astype("<u4"), bounds.tolist()
                sums = [zlib.crc32(raw[a:b]) for a, b in itertools.pairwise(edges)]
                yield pa.RecordBatch.from_pydict(
                    {**places, "n_tokens": np.diff(bounds), "ids_crc32": np.array(sums, np.int64)}
                )

    stored = spark.read.parquet(folder).select("part", "segment", "data")
    read = stored.mapInArrow(sums_of, f"{_PLACES}, n_tokens long, ids_crc32 long")
    return read.join(segment_starts(spark, folder), ["part", "segment"]).select(
        "doc_id",
        (F.col("segment_start") + F.col("offset")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def op1_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    write_tokens(
        documents(spark, sf_dir),
        folder,
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2,
        files=partitions(spark),
    )
    return checksums(spark, folder)
