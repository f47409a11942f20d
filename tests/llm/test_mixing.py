"""Raking and sampling against plain loops."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from stationcast.llm import mixing
from tests.llm.fixtures import awkward_rows, frame, plain_rows

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def expected_chances(facts, rounds, budget):
    cells = collections.Counter()
    for f in facts:
        cells[f[1:4]] += f[4]
    cells = {c: t for c, t in cells.items() if t}
    weight = dict(cells)
    for _ in range(rounds):
        for at, margin in enumerate(mixing.MARGINS):
            sums, held = collections.Counter(), collections.Counter()
            for c, t in cells.items():
                sums[c[at]] += t
                held[c[at]] += weight[c]
            raised = {v: t ** POWERS[margin] for v, t in sums.items()}
            for c in cells:
                weight[c] *= raised[c[at]] / sum(raised.values()) / held[c[at]]
    left, capped, total = sorted(cells, key=lambda c: -weight[c] / cells[c]), [], sum(cells.values())
    while left:
        scale = (budget * total - sum(cells[c] for c in capped)) / sum(weight[c] for c in left)
        if weight[left[0]] * scale < cells[left[0]]:
            break
        capped.append(left.pop(0))
    return {c: 1.0 for c in capped} | {c: weight[c] * scale / cells[c] for c in left}, cells


def test_against_loops(spark):
    docs = frame(spark, plain_rows(400) + awkward_rows()).drop("n_chars")
    facts = mixing.document_facts(docs)
    found = mixing.mix(facts, POWERS, 0.6, rounds=3).collect()
    chances, _ = expected_chances([tuple(r[:5]) for r in facts.collect()], 3, 0.6)
    assert len(found) == docs.count()
    for r in found:
        chance = chances.get((r.source, r.lang, r.topic), 0.0) if r.n_tokens else 0.0
        assert r.probability == pytest.approx(chance, rel=1e-9)
        drawn = int(hashlib.md5(f"1|{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:12], 16)
        assert r.sampled == (drawn / 2**48 < r.probability)


def test_margins_meet_the_targets(spark):
    cells = spark.createDataFrame(
        [(s, g, t, 100 + 37 * (7 * i + 3 * j + k)) for i, s in enumerate("abcd") for j, g in enumerate("xyz")
         for k, t in enumerate("pq")],
        "source string, lang string, topic string, tokens long",
    )
    shares = {
        "source": [("a", 0.4), ("b", 0.3), ("c", 0.2), ("d", 0.1)],
        "lang": [("x", 0.5), ("y", 0.25), ("z", 0.25)],
        "topic": [("p", 0.9), ("q", 0.1)],
    }
    targets = {m: spark.createDataFrame(v, "value string, share double") for m, v in shares.items()}
    raked = mixing.rake(cells, targets, rounds=6).collect()
    for margin, wanted in shares.items():
        got = collections.Counter()
        for r in raked:
            got[r[margin]] += r.weight
        for value, share in wanted:
            assert got[value] == pytest.approx(share, abs=1e-6)
    # A value that the target leaves out gets no weight.
    targets["topic"] = targets["topic"].where("value = 'p'")
    assert {r.topic for r in mixing.rake(cells, targets, rounds=2).collect()} == {"p"}


def test_expected_tokens_meet_the_budget(spark):
    facts = mixing.document_facts(frame(spark, plain_rows(300)))
    for budget in (0.4, 1.0):
        mixed = mixing.mix(facts, POWERS, budget, rounds=2)
        kept, total = mixed.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).first()
        assert kept / total == pytest.approx(budget, rel=1e-6)


def test_sample_meets_the_targets(spark):
    """Also for values that the targets raise above what there is, at a large budget."""
    facts = spark.createDataFrame(
        [(i, "hot" if i % 10 else f"s{i % 7}", "es" if i % 50 == 10 else "en", "loud" if i % 23 == 0 else "long",
          20 + i % 60) for i in range(6000)],
        "doc_id long, source string, lang string, topic string, n_tokens long",
    )
    rows = mixing.mix(facts, POWERS, 0.8, repeated=True).collect()
    total = sum(r.n_tokens for r in rows)
    assert len(rows) == 6000 and max(r.expected for r in rows) > 1.5
    assert sum(r.n_tokens * r.expected for r in rows) == pytest.approx(0.8 * total, rel=1e-6)
    for margin in mixing.MARGINS:
        own, expected, got = collections.Counter(), collections.Counter(), collections.Counter()
        for r in rows:
            own[r[margin]] += r.n_tokens
            expected[r[margin]] += r.n_tokens * r.expected / (0.8 * total)
            got[r[margin]] += r.n_tokens * r.repeats / (0.8 * total)
        raised = {v: t ** POWERS[margin] for v, t in own.items()}
        for value in own:
            target = raised[value] / sum(raised.values())
            assert expected[value] == pytest.approx(target, abs=1e-4)
            assert got[value] == pytest.approx(target, abs=0.02)
    for r in rows:
        draw = int(hashlib.md5(f"1|{r.doc_id}".encode()).hexdigest()[:12], 16) / 2**48
        assert r.repeats == int(r.expected) + (draw < r.expected - int(r.expected))
        assert r.sampled == (r.repeats > 0) and r.probability == min(1, r.expected)


def test_edges(spark):
    assert mixing.mix(mixing.document_facts(frame(spark, [])), POWERS, 0.5, rounds=1).count() == 0
    blank = frame(spark, [(1, None, "en", "s", 0), (2, " ", None, None, 0)])
    assert all(r.sampled for r in mixing.mix(mixing.document_facts(blank), POWERS, 0.5, rounds=1).collect())
    clash = frame(spark, awkward_rows(), clash=True).drop("topic", "n_tokens")
    facts = clash.withColumn("n_tokens", mixing.word_count(F.col("text")))
    facts = facts.withColumn("topic", mixing.text_form(F.col("text"), F.col("n_tokens")))
    found = mixing.mix(facts.withColumn("probability", F.lit("x")), POWERS, 0.5, rounds=1)
    assert set(found.columns) == {*facts.columns, "probability", "sampled"}
    assert found.count() == len(awkward_rows())


def test_plan_has_no_python(spark):
    plan = mixing.mix(mixing.document_facts(frame(spark, plain_rows(5))), POWERS, 0.5, rounds=1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
