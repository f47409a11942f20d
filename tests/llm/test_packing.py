"""Packed sequences against the library's ids of whole texts, and their pieces put together again."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stationcast.llm import packing
from tests.llm.fixtures import awkward_rows, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return [[*e.ids, END] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(rows, expected, length=packing.LENGTH):
    """``rows`` of pieces with their ids; ``expected`` ids of the documents, in any order."""
    windows = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and checksum(ids) == r.ids_crc32
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for number, held in windows.items():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at == length or number == len(windows) - 1
    # The pieces of one document follow each other in the stream.
    joined = []
    for r in sorted(rows, key=lambda r: r.sequence_id * length + r.offset):
        if r.start == 0:
            joined.append([])
        assert len(joined[-1]) == r.start
        joined[-1] += np.frombuffer(r.ids, "<u4").tolist()
        assert r.start + r.length <= r.doc_tokens
        if r.start + r.length == r.doc_tokens:
            assert len(joined[-1]) == r.doc_tokens
    assert sorted(joined) == sorted(expected)


ODD = [
    "It's CAFÉ we'll 12 34! don't<|endoftext|>now <|startoftext|> X y\xa0z \x1c a\x85b",
    "İstanbul ΣΑΣ ́ lone mark　wide",
    "a​b ﻿ 日本語 text 😀😀 '' ''s 's",
]


@pytest.mark.parametrize("length", [7, 4096])
def test_pieces_hold_the_ids_of_the_library(spark, length):
    rows = awkward_rows() + [(200 + k, t, "en", "s", 1) for k, t in enumerate(ODD)]
    docs = frame(spark, rows, clash=True).withColumn("place", F.lit("x")).withColumn("part", F.lit("y"))
    stored = packing.store_tokens(docs.repartition(6), PATH, END)
    found = packing.pieces(stored, length, keep_ids=True).collect()
    texts = [r[1] for r in rows]
    check_pieces(found, library_ids(texts), length)
    joined = sorted(packing.sequences(stored, length).collect(), key=lambda r: r.sequence_id)
    assert [r.n_ids for r in joined[:-1]] == [length] * (len(joined) - 1)
    assert [len(r.ids) for r in joined] == [4 * r.n_ids for r in joined]
    stream = b"".join(r.ids for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)))
    assert b"".join(r.ids for r in joined) == stream


def test_long_texts_are_split_by_the_piece():
    text = " ".join(f"word{k % 700} it's" for k in range(180_000)) + " " + "x" * 5_000
    assert len(text) > 2 * packing.PIECE
    coder = packing.WordCoder(PATH, remembered=10)
    found = list(coder.token_ids(pa.array(["a b.", text, "", text[:70], " \n"])))
    assert [ids.tolist() for ids in found[:4]] == [i[:-1] for i in library_ids(["a b.", text, "", text[:70]])]
    assert len(found) == 5 and not len(found[4])


def test_no_documents(spark):
    stored = packing.store_tokens(frame(spark, []), PATH, END)
    assert packing.pieces(stored).count() == 0
    assert packing.sequences(stored).count() == 0


def test_prefix_sums_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 3)
    rows = [(part, 10 * part + k) for part in range(11) for k in range(2)]
    starts = packing.part_starts(spark.createDataFrame(rows, "part int, n_ids long")).collect()
    totals = [sum(n for p, n in rows if p == part) for part in range(11)]
    assert {r.part: r.part_start for r in starts} == {p: sum(totals[:p]) for p in range(11)}


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = dict(zip(docs, library_ids(docs.values()), strict=True))
    found = packing.op11_pack_sequences(spark, folder).collect()
    assert {r.doc_id for r in found} == set(docs)
    for r in found:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == checksum(ids[r.doc_id][r.start : r.start + r.length])
    total = sum(map(len, ids.values()))
    assert sum(r.length for r in found) == total
    assert max(r.sequence_id for r in found) == (total - 1) // packing.LENGTH
