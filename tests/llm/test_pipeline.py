"""The stages one by one, on awkward rows and on nothing, and all together."""

import pytest

import corpus_pipeline
from stationcast.llm import bpe, mixing
from tests.llm.fixtures import awkward_rows, frame, plain_rows, text_of
from tests.llm.test_line_dedup import expected_texts
from tests.llm.test_near_dups import groups, shingles

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(autouse=True)
def few_rounds(monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 1)


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stage_keeps_the_columns(spark, name):
    for rows, clash in ((awkward_rows(), True), ([], False), (plain_rows(9), False)):
        docs = frame(spark, rows, clash)
        found = STAGES[name](spark, docs, SF)
        assert found.schema.simpleString() == docs.schema.simpleString()
        assert found.count() <= len(rows)


def test_language_leaves_out_what_it_rejects(spark):
    rows = plain_rows(30) + [(500, "12 34", "en", "s", 1), (501, None, "en", "s", 1)]
    found = {r.doc_id for r in STAGES["language"](spark, frame(spark, rows), SF).collect()}
    assert found == set(range(30))


def test_lines_are_dropped_and_counted(spark):
    rows = plain_rows(30)
    found = {r.doc_id: r for r in STAGES["lines"](spark, frame(spark, rows), SF).collect()}
    for doc_id, text, _ in expected_texts(rows, 20, 3):
        assert found[doc_id].text == text and found[doc_id].n_chars == len(text)


def test_one_of_each_group_stays(spark):
    rows = plain_rows(30)
    rows += [(100 + r[0], r[1].upper(), *r[2:]) for r in rows[:10]] + [(None, "a text of no id at all", None, None, None)]
    found = [r.doc_id for r in STAGES["near_duplicates"](spark, frame(spark, rows), SF).collect()]
    expected = groups({r[0]: shingles(r[1]) for r in rows if r[0] is not None}, 80)
    assert sorted(i for i in found if i is not None) == sorted(i for i, g in expected.items() if g[2])
    assert found.count(None) == 1


def test_rows_that_repeat_an_id_or_have_none_are_compared(spark):
    a, b, c, d = (text_of("en", 80, k) for k in range(4))
    rows = [
        (50, a, "en", "s", 1), (50, a, "en", "s", 1),  # the same row twice
        (100, b, "en", "s", 1), (100, c, "en", "s", 1), (101, c, "en", "s", 1),  # two texts of one id, a copy
        (None, a, "en", "s", 1), (None, d, None, "s", 1), (None, d, "en", None, None),
        (7, None, "en", "s", 1), (7, "", "en", "s", 1),
    ]
    found = STAGES["near_duplicates"](spark, frame(spark, rows), SF).collect()
    got = sorted((str(r.doc_id), r.text or "") for r in found)
    assert got == sorted([("50", a), ("100", b), ("100", c), ("None", d), ("7", ""), ("7", "")])


def test_tokens_decode_to_the_texts(spark):
    rows = awkward_rows()
    found = STAGES["tokens"](spark, frame(spark, rows, clash=True), SF)
    back = bpe.decode(found, bpe.vocabulary(), text="text").collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert all(r.n_tokens == len(r.token_ids) for r in back)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
    expected = sorted((r.doc_id, r.ids_sha256) for r in docs.collect())
    got = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == expected and len(got) > 100
