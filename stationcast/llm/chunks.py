"""Coding many texts at once, each distinct chunk only once.

The pre-tokeniser of this family never joins what stands on the two sides of certain places: a
single space or line feed between characters that are no white space, and a mark of
punctuation behind a letter. So texts are cut there, all chunks of a batch are hashed together,
and only chunks that this process has not met are coded; the ids of the rest are gathered.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from stationcast.llm.shingles import SPACES, span_hashes

# Chunks a process remembers before it starts again; only speed depends on it.
REMEMBERED = 1_000_000
# Ids it remembers at most, for each of these chunks.
IDS_PER_CHUNK = 8
# Longer chunks are coded each time.
LONGEST = 1 << 10

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b".,;:!?")] = True
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[b for b in range(128) if chr(b).isalpha()]] = True
# White space beyond one byte, in UTF-8.
_WIDE = (
    b"\xc2\x85 \xc2\xa0 \xe1\x9a\x80 \xe2\x80\x80 \xe2\x80\x81 \xe2\x80\x82 \xe2\x80\x83 "
    b"\xe2\x80\x84 \xe2\x80\x85 \xe2\x80\x86 \xe2\x80\x87 \xe2\x80\x88 \xe2\x80\x89 \xe2\x80\x8a "
    b"\xe2\x80\xa8 \xe2\x80\xa9 \xe2\x80\xaf \xe2\x81\x9f \xe3\x80\x80"
).split(b" ")
_BLANK = SPACES.copy()
_BLANK[0x1C:0x20] = True


# How byte-level vocabularies write bytes that are no visible Latin-1 sign: as signs from U+0100 on.
_SHOWN = {b: 256 + k for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
# Latin letters up to U+01BF that stay one letter when composed and lowered: not U+0130, which does not.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u01bf]+"


def model_ids(tokenizer, words: list[str]) -> list[bytes]:
    """Ids of strings that are one part to a byte-level tokenizer, by its model alone.

    Normaliser and pre-tokenizer would do nothing but map the bytes. Returned as the bytes of
    unsigned 32-bit integers.
    """
    tokenize, found = tokenizer.model.tokenize, []
    for word in words:
        mapped = word.encode().decode("latin-1").translate(_SHOWN)
        found.append(array("I", [token.id for token in tokenize(mapped)]).tobytes())
    return found


def _wide(data: np.ndarray, at: np.ndarray, before: bool) -> np.ndarray:
    """Whether the character that ends before, or starts at, each place is wide white space."""
    found = np.zeros(len(at), dtype=bool)
    for code in _WIDE:
        first = at - len(code) if before else at
        inside = (first >= 0) & (first + len(code) <= len(data))
        same = inside.copy()
        for k, byte in enumerate(code):
            same[inside] &= data[first[inside] + k] == byte
        found |= same
    return found


def _ascending(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; for integers faster than ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])]


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in the joined bytes of texts where a chunk may start, ascending."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    blank = _BLANK[data]
    single = (data == 0x20) | (data == 0x0A)
    lone = np.flatnonzero(single[1:-1] & ~blank[:-2] & ~blank[2:]) + 1
    beyond = np.flatnonzero((data[lone - 1] >= 0x80) | (data[lone + 1] >= 0x80))
    wide = _wide(data, lone[beyond], True) | _wide(data, lone[beyond] + 1, False)
    lone = np.delete(lone, beyond[wide])
    marks = np.flatnonzero(_PUNCTUATION[data[1:]] & _LETTERS[data[:-1]]) + 1
    return _ascending(np.concatenate([lone, lone[data[lone] == 0x0A] + 1, marks]))


class ChunkCoder:
    """``code`` gives the ids of each of a list of strings; every string is coded by itself."""

    def __init__(self, code: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED):
        self.code = code
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _add(self, coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Put ids into the pool; where each begins, and how many there are."""
        ids = np.frombuffer(b"".join(coded), np.uint32)
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = self.used + np.cumsum(counts) - counts
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return starts, counts

    def _places(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of each chunk are, and how many; new chunks are coded."""

        def strings(chunks: np.ndarray) -> list[str]:
            pairs = zip(starts[chunks].tolist(), ends[chunks].tolist(), strict=True)
            return [raw[a:b].decode() for a, b in pairs]

        raw = data.tobytes()
        if len(self.keys) > self.remembered or self.used > IDS_PER_CHUNK * self.remembered:
            self._forget()
        first, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        long = ends - starts > LONGEST
        short = np.flatnonzero(~long)
        keys = span_hashes(data, starts[short], ends[short], 0)
        distinct, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
        checks = span_hashes(data, starts[short][example], ends[short][example], 1)
        at = np.searchsorted(self.keys, distinct)
        inside = np.minimum(at, max(0, len(self.keys) - 1))
        known = np.zeros(len(distinct), bool)
        if len(self.keys):
            known = (self.keys[inside] == distinct) & (self.checks[inside] == checks)
        new = np.flatnonzero(~known)
        if len(new):
            begin, many = self._add(self.code(strings(short[example[new]])))
            spots = at[new]
            self.keys = np.insert(self.keys, spots, distinct[new])
            self.checks = np.insert(self.checks, spots, checks[new])
            self.starts = np.insert(self.starts, spots, begin)
            self.counts = np.insert(self.counts, spots, many.astype(np.int32))
            at = np.searchsorted(self.keys, distinct)
        first[short] = self.starts[at][inverse]
        counts[short] = self.counts[at][inverse]
        if long.any():
            # Read once and then overwritten: these are not remembered.
            used, rest = self.used, np.flatnonzero(long)
            first[rest], counts[rest] = self._add(self.code(strings(rest)))
            self.used = used
        return first, counts

    def spans(self, data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks of joined texts start and end; ``heads`` are the starts of the texts."""
        starts = _ascending(np.concatenate([heads, cuts(data)]))
        return starts, np.append(starts[1:], len(data)) if len(starts) else starts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one array, and the bounds of each text in it."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        values = texts.buffers()[2]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        starts, ends = self.spans(data, offsets[:-1][np.diff(offsets) > 0])
        first, counts = self._places(data, starts, ends)
        stops = np.cumsum(counts)
        shift = np.repeat(first - (stops - counts), counts)
        ids = self.pool[shift + np.arange(len(shift))]
        bounds = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        return ids, bounds
