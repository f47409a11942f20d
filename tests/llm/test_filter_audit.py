"""The audit against plain loops over all orders."""

import itertools

import pytest
from pyspark.sql import functions as F

from stationcast.llm import filter_audit as fa
from tests.llm.fixtures import awkward_rows, frame

LABELS = "doc_id long, quality int, toxic int"
BLANKS = " \t\n\x0b\x0c\r"


def plain_failures(rows):
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = "".join("\n" if c in BLANKS else c for c in text).split("\n")
        words = [w for w in words if w]
        failed = ""
        failed += "A" * (len(words) < 200)
        failed += "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text))
        failed += "D" * any(c in "#$%&*|" for c in text)
        smaller = [r for r in rows if r[0] is not None and doc_id is not None and r[0] < doc_id]
        failed += "E" * any((r[1] or "") == text for r in smaller)
        out.append(failed)
    return out


def plain_audit(parts, failed, good, toxic, names):
    out = {}
    for part in set(parts):
        for order in map("".join, itertools.permutations(names)):
            left = [i for i, p in enumerate(parts) if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                hit = [i for i in left if name in failed[i]]
                redundant = sum(name in failed[i] for i in gone)
                left = [i for i in left if name not in failed[i]]
                gone += hit
                alone = sum(failed[i] == name for i, p in enumerate(parts) if p == part)
                losses = (sum(good[i] for i in hit), sum(toxic[i] for i in hit))
                out[part, order, step] = [len(left), len(hit), redundant, alone, *losses]
    for (part, order, step), values in out.items():
        name = order[step - 1]
        values.append(sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == name))
    return out


def audited(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = [r.asDict() for r in df.collect()]
    found = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in rows}
    assert len(found) == len(rows)
    return found


def test_awkward_rows_equal_plain_loops(spark):
    rows = awkward_rows() + [
        (300, "Loud WORDS & signs " * 80, "en", "s", 1),
        (301, "Loud WORDS & signs " * 80, "en", "s", 1),
        (302, " ".join(f"word{k}" for k in range(250)), "de", "s", 1),
        (303, "x\x1cy\x85z\xa0" * 300, "", "s", 1),
    ]
    marks = [(100, 1, None), (100, 0, 1), (105, 1, 1), (300, 1, 0), (None, 1, 1), (999, 1, 1), (302, None, None)]
    docs = frame(spark, rows, clash=True).withColumn("row", F.lit("a")).withColumn("filter", F.lit("b"))
    facts = fa.document_facts(docs.repartition(5))
    members = fa.with_labels(facts, spark.createDataFrame(marks, LABELS))
    found = audited(fa.audit(members, fa.failing_rows(facts)))
    good = [any(m[0] == r[0] and m[1] == 1 for m in marks) and r[0] is not None for r in rows]
    toxic = [any(m[0] == r[0] and m[2] == 1 for m in marks) and r[0] is not None for r in rows]
    assert found == plain_audit([r[2] or "" for r in rows], plain_failures(rows), good, toxic, "ABCDE")


def test_other_filters_and_rows_that_are_no_members(spark):
    members = spark.createDataFrame(
        [(k, "p" if k % 3 else "q", k % 2 == 0, k % 5 == 0) for k in range(30)], "row long, part string, good boolean, toxic boolean"
    )
    tables = {"x": [*range(0, 20), 3, 99], "y": list(range(10, 30, 2)), "z": [None]}
    failing = {n: spark.createDataFrame([(k,) for k in ks], "row long") for n, ks in tables.items()}
    failed = ["".join(n for n, ks in tables.items() if k in ks) for k in range(30)]
    expected = plain_audit(
        ["p" if k % 3 else "q" for k in range(30)], failed, [k % 2 == 0 for k in range(30)], [k % 5 == 0 for k in range(30)], "xyz"
    )
    assert audited(fa.audit(members, failing)) == expected


def test_empty_table_and_bad_names(spark):
    facts = fa.document_facts(frame(spark, []))
    members = fa.with_labels(facts, spark.createDataFrame([], LABELS))
    failing = fa.failing_rows(facts)
    assert fa.audit(members, failing).count() == 0
    with pytest.raises(ValueError):
        fa.audit(members, {"long name": failing["A"]})


def test_a_long_text_is_counted_by_pieces():
    data = b"some words and more of them " * 200_000 + b"x" * (3 << 20)
    assert fa.word_counts(data) == (1_200_001, 7)
