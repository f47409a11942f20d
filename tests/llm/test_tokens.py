"""BPE and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationcast.llm import bpe, simple8b
from stationcast.session import scratch_path
from tests.llm.fixtures import awkward_rows, frame

PIECES = "a|th| |  |\n|\t|é|ß|<|endoftext|>|'s|1|23|!|!!!|\xa0|　|日本|😀|ing|\x00|\x1c|\x85|'|<|||>|\r\n|,|. ".split("|")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary())


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(bpe.vocabulary())


def odd_texts():
    rng = random.Random(3)
    parts = [*PIECES, "<|endoftext|>"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3000)]
    return [*made, "", "a" * 3000, " " * 500, "ab" * 1500, " a", "a ", "\n"]


def test_encode_and_decode_as_the_library(library, own):
    texts = odd_texts()
    ids, bounds = own.coder.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        got = ids[a:b].tolist()
        assert got == expected, text
        assert own.decode(got) == library.decode(got, skip_special_tokens=False) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_decode_any_ids(library, own, ids):
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_trees_in_tables_equal_single_trees(own):
    rng = random.Random(5)
    words = [bytes(rng.choices(b"aetonhring", k=rng.randint(1, 60))) for _ in range(400)]
    for word, ids in zip(words, own.merge_words(words), strict=True):
        tokens = [int(own.byte_ids[b]) for b in word]
        assert np.frombuffer(ids, np.uint32).tolist() == bpe.MergeTree(tokens, own.merges).run()


def test_encode_operator(spark, library):
    rows = awkward_rows()
    coded = bpe.encode(frame(spark, rows, clash=True), bpe.vocabulary())
    back = bpe.decode(coded, bpe.vocabulary(), text="again").collect()
    assert len(back) == len(rows)
    for row in back:
        assert row.token_ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.again == (row.text or "")
        assert row.position == (None if row.doc_id is None else f"position{row.doc_id}")
    assert bpe.encode(frame(spark, []), bpe.vocabulary()).count() == 0


def test_digests(spark, library):
    rows = awkward_rows()
    got = bpe.digests(frame(spark, rows), bpe.vocabulary()).collect()
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70000) | st.integers(0, 3), max_size=400),
    st.integers(0, 200),
    st.integers(0, 2**64 - 1),
)
def test_pack_round_trip(values, run, value):
    values = np.array([*values, *[value] * run, *values[:5]], dtype=np.uint64)
    words, firsts = simple8b.pack(values)
    assert simple8b.unpack(words, firsts, len(values)).tolist() == values.tolist()


def test_pack_is_short():
    assert len(simple8b.pack(np.zeros(1280, np.uint64))[0]) == 10
    assert len(simple8b.pack(np.tile(np.array([32767, 32766], np.uint64), 60))[0]) == 30
    assert len(simple8b.pack(np.full(2, 2**63, np.uint64))[0]) == 4


def test_segments_keep_documents():
    counts = np.array([3, 1, 2])
    data = simple8b.segment_bytes(np.array([-4, 7, 9]), counts, np.array([5, 6, 2, 2, 50000, 2]))
    doc_ids, sizes, ids = simple8b.read_segment(data)
    assert doc_ids.tolist() == [-4, 7, 9] and sizes.tolist() == [3, 1, 2]
    assert ids.tolist() == [5, 6, 2, 2, 50000, 2]
    with pytest.raises(ValueError):
        simple8b.read_segment(b"\0" * 40)


@pytest.mark.parametrize("segment", [1 << 18, 50])
def test_token_file(spark, library, monkeypatch, segment):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 106]
    folder = scratch_path(spark, "tokens")
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", segment)
    simple8b.write_tokens(frame(spark, rows, clash=True), folder, bpe.vocabulary(), end_id=2, files=5)
    got = sorted(map(tuple, simple8b.checksums(spark, folder).collect()), key=lambda r: r[1])
    expected, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    whole = {r.doc_id: r for r in simple8b.read_tokens(spark, folder).collect()}
    for doc_id, text, *_ in rows:
        assert whole[doc_id].token_ids == [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_token_file_of_nothing_and_of_missing_ids(spark):
    folder = scratch_path(spark, "tokens")
    simple8b.write_tokens(frame(spark, []), folder, bpe.vocabulary(), end_id=2, files=3)
    assert simple8b.checksums(spark, folder).count() == 0
    folder = scratch_path(spark, "tokens")
    rows = [(None, "x", None, None, None), (3, None, None, None, None)]
    simple8b.write_tokens(frame(spark, rows), folder, bpe.vocabulary(), end_id=2, files=3)
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in simple8b.checksums(spark, folder).collect())
    assert got == [(-(1 << 63), 0, 2), (3, 2, 1)]
