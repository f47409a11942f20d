"""Counts that describe how a text is written, for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.shingles import SPACES, Words, mix, words
from stationcast.llm.tables import map_slices

BLANKS = " \t\n\x0b\x0c\r"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_lines",
    "n_ended_lines",
    "n_letters",
    "n_upper",
    "n_digits",
    "n_cries",
    "n_bars",
)


def _flags(characters: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(characters)] = True
    return flags


_UPPER = _flags(bytes(range(ord("A"), ord("Z") + 1)))
# ASCII letters, and every character from U+00C0 on: dashes, quotes and emoji among them.
_LETTER = _UPPER | _flags(bytes(range(ord("a"), ord("z") + 1))) | _flags(bytes(range(0xC3, 0xF5)))
_OF_BYTES = {
    # One per code point of a word: neither white space nor a continuation byte.
    "word_chars": ~SPACES & ~_flags(bytes(range(0x80, 0xC0))),
    "n_symbols": _flags(b"#*$%&|<>"),
    "n_letters": _LETTER,
    "n_upper": _UPPER,
    "n_digits": _flags(b"0123456789"),
    "n_cries": _flags(b"!"),
    "n_bars": _flags(b"|"),
}


def _repeats(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each key stands twice or more in its text."""
    own = mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    found = np.zeros(len(keys), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Set flags between bounds that cover all of them, without a number for each flag."""
    out, filled = np.zeros(len(bounds) - 1, np.int64), np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled] = np.add.reduceat(flags, bounds[filled], dtype=np.int64)
    return out


def repeated_words(found: Words, size: int = 3) -> np.ndarray:
    """Words of each text that lie in a window of ``size`` words found twice or more in it."""
    windows, bounds = found.window(size)
    counts = np.diff(found.bounds)
    many = np.diff(bounds)
    owner = np.repeat(np.arange(len(many)), many)
    twice = _repeats(windows, owner) & (counts >= size)[owner]
    at = np.arange(len(windows)) - bounds[:-1][owner] + found.bounds[:-1][owner]
    steps = np.zeros(len(found.hashes) + size + 1, np.int64)
    np.add.at(steps, at[twice], 1)
    np.add.at(steps, at[twice] + size, -1)
    return _sums(np.cumsum(steps)[: len(found.hashes)] > 0, found.bounds)


def _lines(text: str) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier line, and those that end a sentence."""
    seen: set[str] = set()
    filled = again = ended = 0
    for line in text.split("\n"):
        bare = line.strip(BLANKS)
        if bare:
            filled += 1
            again += line in seen
            ended += bare[-1] in ".!?"
            seen.add(line)
    return filled, again, ended


def counts_of(texts: list[str]) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of each text."""
    found = words([t.encode("utf-8", "surrogatepass") for t in texts])
    out = {name: _sums(flags[found.data], found.places) for name, flags in _OF_BYTES.items()}
    out["n_words"] = np.diff(found.bounds)
    out["n_repeat_words"] = repeated_words(found)
    owner = np.repeat(np.arange(len(texts)), out["n_words"])
    lines = np.array([_lines(t) for t in texts], dtype=np.int64).reshape(len(texts), 3)
    out["n_lines"], out["n_dup_lines"], out["n_ended_lines"] = lines.T
    out["n_distinct_words"] = _distinct(found, owner, len(texts))
    return out


def _distinct(found: Words, owner: np.ndarray, count: int) -> np.ndarray:
    """Distinct words of each text; sorting by text and the upper bits of the hash is enough."""
    bits = np.uint64(max(1, int(count).bit_length()))
    keys = (owner.astype(np.uint64) << (np.uint64(64) - bits)) | (found.hashes >> bits)
    keys.sort()
    first = np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
    own = (keys[first] >> (np.uint64(64) - bits)).astype(np.int64)
    return np.bincount(own, minlength=count)


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of each whole text, as whole numbers.

    A null, empty or blank text has zeros. Repeated rows are counted each; other columns are
    not read.
    """

    def count(batch: pa.RecordBatch) -> dict:
        found = counts_of(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id")} | {n: found[n].astype(np.int64) for n in COUNTS}

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{name} long" for name in COUNTS)
    return map_slices(texts, count, schema)
