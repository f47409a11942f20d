"""Word hashes, feature counts and chunk cuts against plain loops."""

import collections
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stationcast.llm import chunks, features, shingles, tables

TEXTS = st.lists(st.text(alphabet="aB \n\té!|.#1", max_size=40), max_size=6)
WORD = re.compile("[^\x20\x09-\x0d]+")


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_windows(texts):
    found = shingles.words([t.encode() for t in texts], lower=True)
    expected = [[w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))] for t in texts]
    assert np.diff(found.bounds).tolist() == [len(e) for e in expected]
    names = {}
    for h, w in zip(found.hashes.tolist(), [w for e in expected for w in e], strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    hashes, bounds = found.window(3)
    for i, e in enumerate(expected):
        wanted = [tuple(e[k : k + 3]) for k in range(len(e) - 2)] or ([tuple(e)] if e else [])
        got = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(got) == len(wanted)
        for h, w in zip(got, wanted, strict=True):
            assert names.setdefault(w, h) == h


def test_a_hash_does_not_depend_on_its_neighbours(monkeypatch):
    texts = [b"some words of a text", b"x" * 3000, b"and more words"]
    alone = np.concatenate([shingles.words([t]).hashes for t in texts])
    shingles._tables.cache_clear()
    monkeypatch.setattr(shingles, "_BLOCK", 64)
    assert len(shingles.words(texts).hashes) == len(alone)
    small = np.concatenate([shingles.words([t]).hashes for t in texts])
    assert (shingles.words(texts).hashes == small).all()
    shingles._tables.cache_clear()


def base_counts(text):
    words = WORD.findall(text)
    seen, same, again = set(), 0, set()
    for line in text.split("\n"):
        same += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    marks = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), marks, same, len(again), len(set(words))]


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_counts(texts):
    found = features.counts_of(texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words")
    for i, text in enumerate(texts):
        assert [int(found[n][i]) for n in names] == base_counts(text)


def test_slices_hold_a_bound_or_one_row(monkeypatch):
    monkeypatch.setattr(tables, "BATCH_BYTES", 10)
    texts = ["aaaa", "bbbb", "cccc", "d" * 50, "", None, "e"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    parts = [p.column("text").to_pylist() for p in tables.slices(iter([batch]))]
    assert parts == [["aaaa", "bbbb"], ["cccc"], ["d" * 50], ["", None, "e"]]


def test_chunks_are_coded_once_and_gathered():
    asked = []

    def code(strings):
        asked.extend(strings)
        return [np.frombuffer(s.encode(), np.uint8).astype(np.uint32).tobytes() for s in strings]

    coder = chunks.ChunkCoder(code)
    texts = ["the cat, the cat.\nThe end", "", "a  b", "é the　cat", "x" * 2000]
    for _ in range(2):
        ids, bounds = coder.encode(pa.array(texts, pa.string()))
        got = [bytes(ids[a:b].tolist()).decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == texts
    assert asked.count(" cat") == 1 and "a  b" in asked and asked.count("x" * 2000) == 2
    coder.remembered = 0
    ids, bounds = coder.encode(pa.array(texts, pa.string()))
    assert bytes(ids[: bounds[1]].tolist()).decode() == texts[0]
