"""Line removal against plain loops."""

import collections

from stationcast.llm import line_dedup
from tests.llm.fixtures import awkward_rows, frame

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def expected_texts(rows, min_chars, min_docs):
    """Kept text and dropped lines per row; ids of None count as the smallest."""
    holders = collections.defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(float("-inf") if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        own = float("-inf") if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            found = holders.get(key_of(line), ())
            if len(key_of(line)) < min_chars or len(found) < min_docs or own == max(found):
                kept.append(line)
        left = text if len(kept) == len(lines) else "\n".join(kept)
        out.append((doc_id, left, len(lines) - len(kept)))
    return out


def rows_with_repeats():
    rows = awkward_rows()
    shared = "This line is held by a third of all documents"
    for i in range(200, 260):
        text = f"  {shared.upper() if i % 2 else shared}\t\nown line number {i} of this text\n{shared}\n\nx"
        rows.append((i, text, "en", "s0", 1))
    rows.append((300, f"{shared}\n{shared}", "en", "s0", 1))
    rows += [(301, "only in two documents, twice each", "en", "s0", 1)] * 2
    rows.append((302, "only in two documents, twice each", "en", "s0", 1))
    return rows


def check(spark, rows, min_chars, min_docs, clash=False):
    docs = frame(spark, rows, clash)
    bitmaps = line_dedup.keep_bitmaps(docs, min_chars, min_docs)
    got = line_dedup.apply_bitmaps(docs, bitmaps, dropped="lost")
    assert got.columns == [*docs.columns, "lost"]
    found = [(r.doc_id, r.text, r.lost) for r in got.collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected_texts(rows, min_chars, min_docs)))


def test_against_loops(spark):
    check(spark, rows_with_repeats(), 20, 3)
    check(spark, rows_with_repeats(), 1, 2, clash=True)
    check(spark, [], 20, 3)


def test_bitmaps_are_runs(spark):
    rows = [(i, "own\nthe line that is repeated\nown\n\nthe line that is repeated", None, None, 0) for i in (1, 2, 3)]
    found = line_dedup.keep_bitmaps(frame(spark, rows)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_lines, r.n_dropped) for r in found] == [(1, 5, 2), (2, 5, 2)]
    assert [tuple(x) for x in found[0].keep_runs] == [(0, 1), (2, 2)]


def test_plan_has_no_python_and_limits_before_the_shuffle(spark):
    docs = frame(spark, rows_with_repeats())
    found = line_dedup._occurrences(docs, 20)
    plan = line_dedup.repeated_lines(found, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before
