"""Packing of documents into training sequences: concatenate, and cut at a fixed length.

The ids of all documents, each with an end id, are one stream that is cut every ``length`` ids, so
only the last sequence can be short. Two passes make the stream without moving a text:

1. Every task encodes the texts it reads and stores the ids with its number and the ids it has
   stored before. One row per task, its total, goes into a prefix sum, which is taken in two
   steps so that no task of that sum holds more than a group of totals and one row per group.
2. With the sums a document knows where it stands in the whole stream. It is cut where the fixed
   windows end, and every piece is a record of its sequence, offset and ids.

A window that lies inside what one task stored is complete there. Those that reach across two or
more are put together from their boundary records by ``sequences``, the only ids that are
shuffled: at most two windows for each stored part.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.chunks import LETTERS, ChunkCoder, model_ids
from stationcast.llm.shingles import PIECE, SPACES, pieces_of_words
from stationcast.llm.tables import documents, id_text, slices
from stationcast.session import scratch_path, stage

LENGTH = 4096
# Totals of so many tasks are summed up together.
GROUP = 1024
# Words a process remembers before it starts again; only speed depends on it.
REMEMBERED = 500_000
# Words handed to the library at once.
AT_ONCE = 10_000


def _flags(characters: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(characters)] = True
    return flags


_SIGNS = _flags((string.ascii_letters + string.digits).encode())
_MARKS = _flags(b'.,;:!?"')
_LETTERS = re.compile(LETTERS)


class WordCoder(ChunkCoder):
    """The ids of texts word by word; a word met for the first time is coded by the library.

    For tokenizers that drop white space and code runs of letters, single digits and runs of other
    signs each by itself, as their pre-tokenizer's pattern says. Words end at ASCII blanks and where
    a mark follows an ASCII letter or digit: no part of the pattern reaches across such a place, so
    both sides are coded by themselves, and far fewer of them are distinct.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(self._code, remembered)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Words of letters go straight to the model, if the tokenizer lowers and maps them as here.
        self.direct = False
        probes = ["Word", "Stra\u00dfe", "\u00c9t\u00e9", "\u017bywi\u0119cie"]
        self.direct = self._by_model(probes) == [ids.tobytes() for ids in self._library(probes)]

    def spans(self, data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        filled = ~SPACES[data]
        begins = filled.copy()
        begins[1:] &= ~filled[:-1] | (_MARKS[data[1:]] & _SIGNS[data[:-1]])
        begins[heads] = filled[heads]
        stops = filled.copy()
        stops[:-1] &= ~filled[1:] | begins[1:]
        return np.flatnonzero(begins), np.flatnonzero(stops) + 1

    def token_ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; a long one is coded by pieces."""
        long = pc.greater(pc.binary_length(texts), PIECE).to_numpy(zero_copy_only=False)
        at = 0
        for stop in [*np.flatnonzero(long).tolist(), len(texts)]:
            ids, bounds = self.encode(texts.slice(at, stop - at))
            yield from (ids[a:b] for a, b in itertools.pairwise(bounds.tolist()))
            if stop < len(texts):
                pieces = pieces_of_words(texts[stop].as_py().encode())
                yield np.concatenate([self.encode(pa.array([p.decode()]))[0] for p in pieces])
            at = stop + 1

    def _code(self, words: list[str]) -> list[bytes]:
        coded: dict[str, bytes] = {}
        if self.direct:
            letters = [w for w in words if _LETTERS.fullmatch(w)]
            coded = dict(zip(letters, self._by_model(letters), strict=True))
        rest = [w for w in words if w not in coded]
        for k in range(0, len(rest), AT_ONCE):
            some = rest[k : k + AT_ONCE]
            coded |= {w: ids.tobytes() for w, ids in zip(some, self._library(some), strict=True)}
        return [coded[w] for w in words]

    def _by_model(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one run of letters, equal ones but for their case only once."""
        lowered = [w.lower() for w in words]
        distinct = list(set(lowered))
        found = dict(zip(distinct, model_ids(self.tokenizer, distinct), strict=True))
        return [found[w] for w in lowered]

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in coded]


@functools.cache
def _coder(path: str) -> WordCoder:
    """One coder per process and path."""
    return WordCoder(path)


_STORED = "part int, place long, doc_id long, n_ids long, ids binary"


def store_tokens(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """The ids of every whole text and ``end_id``, stored as the tasks read the texts.

    ``part`` is the task, ``place`` the ids it stored before, ``n_ids`` their number and ``ids``
    the ids as little-endian unsigned 32-bit integers. A null, empty or blank text has the end id
    alone. Rows that repeat a ``doc_id`` are coded each, a missing one stays missing.
    """
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, place = context.partitionId() if context else 0, 0
        coder = _coder(path)
        for piece in slices(batches):
            coded = [ids.astype("<u4").tobytes() + end for ids in coder.token_ids(piece.column("text"))]
            counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(coded), part, np.int32)),
                    "place": pa.array(place + np.cumsum(counts) - counts),
                    "doc_id": piece.column("doc_id"),
                    "n_ids": pa.array(counts),
                    "ids": pa.array(coded, pa.binary()),
                }
            )
            place += int(counts.sum())

    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "tokens")
    stored = id_text(docs).mapInArrow(run, _STORED)
    stored.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(stored.schema).parquet(folder)


def part_starts(stored: DataFrame) -> DataFrame:
    """``part`` and ``part_start``, the ids of all parts before it: a prefix sum of two steps."""
    totals = stage(stored.groupBy("part").agg(F.sum("n_ids").alias("total")), "totals")
    totals = totals.withColumn("group", F.floor(F.col("part") / GROUP))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy("group").agg(F.sum("total").alias("held"))
    groups = groups.select("group", F.coalesce(F.sum("held").over(across), F.lit(0)).alias("before"))
    summed = totals.withColumn("within", F.coalesce(F.sum("total").over(inside), F.lit(0)))
    return summed.join(groups, "group").select("part", (F.col("before") + F.col("within")).alias("part_start"))


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _cut(place: int, n: int, length: int) -> np.ndarray:
    """Where a document of ``n`` ids from ``place`` on is cut, its two ends included."""
    inner = np.arange((place // length + 1) * length, place + n, length, dtype=np.int64)
    return np.concatenate([[place], inner, [place + n]]) - place


def pieces(stored: DataFrame, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents: where they come from and where in which sequence they stand.

    ``start`` and ``length`` are within the document's ``doc_tokens`` ids, ``offset`` within the
    sequence, ``ids_crc32`` is the unsigned checksum of the piece's ids as little-endian unsigned
    32-bit integers; ``keep_ids`` adds these as ``ids``. Every id is in exactly one piece, and the
    offsets of a sequence have no gaps. All sequences but the last are full. Documents come in the
    order in which they were stored. No documents: no pieces.
    """
    # One row per stored part: the planner knows its bytes.
    starts = stage(part_starts(stored), "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices([batch], "ids"):
                yield _pieces_of(piece, length, keep_ids)

    placed = stored.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("place")).alias("place"), "ids"
    )
    return placed.mapInArrow(run, _PIECES + (", ids binary" if keep_ids else ""))


def _pieces_of(batch: pa.RecordBatch, length: int, keep_ids: bool) -> pa.RecordBatch:
    places, coded = batch.column("place").to_pylist(), batch.column("ids").to_pylist()
    edges = [_cut(p, len(c) // 4, length) for p, c in zip(places, coded, strict=True)]
    many = np.array([len(e) - 1 for e in edges], np.int64)
    starts, stops = (np.concatenate([np.zeros(0, np.int64), *[e[s] for e in edges]]) for s in (np.s_[:-1], np.s_[1:]))
    at = np.repeat(np.array(places, np.int64), many) + starts
    owner = np.repeat(np.arange(len(coded)), many)
    spans = zip(owner.tolist(), (4 * starts).tolist(), (4 * stops).tolist(), strict=True)
    cut = [memoryview(coded[i])[a:b] for i, a, b in spans]
    columns = {
        "doc_id": batch.column("doc_id").take(pa.array(owner)),
        "start": pa.array(starts),
        "length": pa.array(stops - starts),
        "ids_crc32": pa.array([zlib.crc32(c) for c in cut], pa.int64()),
        "doc_tokens": pa.array(np.repeat(np.array([len(c) // 4 for c in coded], np.int64), many)),
        "sequence_id": pa.array(at // length),
        "offset": pa.array(at % length),
    }
    if keep_ids:
        columns["ids"] = pa.array([c.tobytes() for c in cut], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


_WINDOW = "sequence_id long, offset long, n_ids long, ids binary"


def sequences(stored: DataFrame, length: int = LENGTH) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``n_ids`` and ``ids`` as little-endian 32-bit integers.

    Each task joins the documents it reads into windows. A window that is full leaves as it is;
    the others, where a task's own stream begins and ends, are boundary records that meet by
    ``sequence_id``. The last sequence is not padded: ``n_ids`` tells how many ids it has.
    """
    starts = stage(part_starts(stored), "starts")
    placed = stored.join(starts, "part").select((F.col("part_start") + F.col("place")).alias("place"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, held, size = 0, [], 0

        def windows(last: bool) -> pa.RecordBatch:
            """What is held, cut into windows; an unfinished one is held on."""
            nonlocal begin, held, size
            joined = b"".join(held)
            cuts = _cut(begin, len(joined) // 4, length)
            if not last and (begin + cuts[-1]) % length:
                cuts = cuts[:-1]
            made = [joined[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            at = begin + cuts[:-1]
            held = [joined[4 * int(cuts[-1]) :]]
            begin, size = begin + int(cuts[-1]), len(held[0])
            return pa.RecordBatch.from_pydict(
                {
                    "sequence_id": pa.array(at // length),
                    "offset": pa.array(at % length),
                    "n_ids": pa.array([len(m) // 4 for m in made], pa.int64()),
                    "ids": pa.array(made, pa.binary()),
                }
            )

        for batch in batches:
            for place, ids in zip(batch.column("place").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if size and place != begin + size // 4:
                    yield windows(last=True)
                    held, size = [], 0
                if not size:
                    begin = place
                held.append(ids)
                size += len(ids)
                if size >= PIECE:
                    yield windows(last=False)
        if size:
            yield windows(last=True)

    made = stage(placed.mapInArrow(run, _WINDOW), "windows")
    full = made.where(F.col("n_ids") == length).select("sequence_id", "n_ids", "ids")
    ends = made.where(F.col("n_ids") < length).groupBy("sequence_id")
    # At most ``length`` records of one id each.
    records = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = ends.agg(F.sum("n_ids").alias("n_ids"), records.alias("records"))
    whole = F.aggregate("records", F.lit(b""), lambda ids, record: F.concat(ids, record["ids"]))
    return full.unionByName(joined.select("sequence_id", "n_ids", whole.alias("ids")))


def op11_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pieces(store_tokens(documents(spark, sf_dir), path, end_id=2))
