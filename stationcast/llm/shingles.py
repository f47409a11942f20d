"""Words and word windows of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. All of them are hashed together: the
bytes' random values are summed with the powers of an odd base modulo 2**64, so the hash of any
word is a difference of two running sums, and the result is mixed.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# A span of more bytes is hashed by itself.
_BLOCK = 1 << 18
# Bytes whose running sums are made at once: they stay in the processor's cache.
_SUMMED = 1 << 15

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Bytes of a text whose words are listed at once.
PIECE = 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")


def pieces_of_words(data: bytes) -> Iterator[bytes]:
    """The bytes in pieces that end where a word ends, so that a long text is never split whole.

    ``bytes.split`` parts their words at exactly ``[\\x20\\x09-\\x0D]``.
    """
    start = 0
    while len(data) - start > PIECE:
        found = _BLANK.search(data, start + PIECE)
        stop = found.start() if found else len(data)
        yield data[start:stop]
        start = stop
    yield data[start:]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(2 * _BLOCK + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Powers of the base and of its inverse, and two random values for each byte."""
    values = mix(np.arange(1, 513, dtype=np.uint64) * np.uint64(_BASE)).reshape(2, 256)
    return _powers(_BASE), _powers(_INVERSE), (values[0], values[1])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    """A 64-bit hash of each span of bytes; the two kinds are independent. Starts ascend or not."""
    up, down, values = _tables()
    out = np.zeros(len(starts), np.uint64)
    long = ends - starts > _BLOCK
    blocks = np.where(long, -1, starts // min(_SUMMED, _BLOCK))
    ascending = not long.any() and bool((starts[1:] >= starts[:-1]).all())
    order = None if ascending else np.argsort(blocks, kind="stable")
    # Long spans come first and start no group.
    edges = [*np.flatnonzero(np.diff(blocks if ascending else blocks[order], prepend=-1)).tolist(), len(starts)]
    for a, b in itertools.pairwise(edges):
        own = slice(a, b) if ascending else order[a:b]
        first, last = starts[own], ends[own]
        low, high = int(first.min()), int(last.max())
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[kind][data[low:high]] * up[: high - low], out=sums[1:])
        first = first - low
        out[own] = (sums[last - low] - sums[first]) * down[first]
    for i in np.flatnonzero(long):
        raw = data[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=bytes([kind])).digest())
    return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


@dataclass
class Words:
    """Words of several texts: hash, place in the joined bytes, and first word of each text."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # text i has the words bounds[i] to bounds[i + 1]
    places: np.ndarray  # text i has the bytes places[i] to places[i + 1] - 1

    def window(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words inside a text, and the bounds per text.

        A text with fewer words, but some, has its whole sequence as its only window.
        """
        counts = np.diff(self.bounds)
        total = len(self.hashes)
        full = np.maximum(counts - size + 1, 0)
        short = (counts > 0) & (full == 0)
        out = np.concatenate([[0], np.cumsum(full + short)])
        result = np.zeros(out[-1], dtype=np.uint64)
        if full.any():
            joined = np.zeros(total - size + 1, dtype=np.uint64)
            for k in range(size):
                joined += self.hashes[k : total - size + 1 + k] * np.uint64(
                    pow(_BASE, 2 * k + 1, 1 << 64)
                )
            joined = mix(joined)
            inside = np.zeros(total - size + 1, dtype=np.int64)
            starts = self.bounds[:-1][full > 0]
            np.add.at(inside, starts, 1)
            stops = starts + full[full > 0]
            np.add.at(inside, stops[stops < len(inside)], -1)
            keep = np.cumsum(inside) > 0
            place = np.ones(out[-1], dtype=bool)
            place[out[:-1][short]] = False
            result[place] = joined[keep]
        for i in np.flatnonzero(short):
            value = int(counts[i])
            for h in self.hashes[self.bounds[i] : self.bounds[i + 1]].tolist():
                value = (value * _BASE + h) % (1 << 64)
                value ^= value >> 29
            result[out[i]] = value
        return result, out


def words(texts: list[bytes], lower: bool = False) -> Words:
    """Split and hash the words of all ``texts``; ``lower`` lowers A to Z first."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    places = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    if lower:
        data = LOWER[data]
    blank = np.ones(len(data) + 2, bool)
    np.take(SPACES, data, out=blank[1:-1])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[0::2], edge[1::2]
    return Words(
        data=data,
        hashes=span_hashes(data, starts, ends, 0),
        starts=starts,
        ends=ends,
        bounds=np.searchsorted(starts, places),
        places=places,
    )
