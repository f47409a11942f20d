"""Near duplicates and components against plain loops."""

import collections
import random

import numpy as np
import pytest

from stationcast.llm import near_dups
from stationcast.llm.components import components
from tests.llm.fixtures import awkward_rows, frame


def shingles(text, size=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def groups(sets, percent):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    for i, own in sets.items():
        for j, n in collections.Counter(j for s in own for j in holders[s] if j > i).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def check(spark, rows, join, clash=False):
    found = near_dups.near_duplicates(frame(spark, rows, clash), join).collect()
    expected = groups({r[0]: shingles(r[1], join.shingle) for r in rows if r[0] is not None}, join.percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert len(found) == len(got)
    assert got == expected


def edited(text, changes, rng):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
    return " ".join(words)


def crowded_rows():
    """Copies, a chain, a group of near copies, and a passage that unlike texts share."""
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(4000)]
    fresh = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = [fresh(80) for _ in range(60)]
    base = fresh(200)
    texts += [base] * 40 + [base.upper()] * 5
    texts += [edited(base, 2, rng) for _ in range(60)]
    link = fresh(300)
    for _ in range(12):
        texts.append(link)
        link = edited(link, 3, rng)
    passage = fresh(60)
    texts += [f"{fresh(60)} {passage} {fresh(40)}" for _ in range(80)]
    texts += ["few words", "few words", "Few Words", "few other words", "", " "]
    rng.shuffle(texts)
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize(
    "join",
    [
        near_dups.Join(percent=85),
        near_dups.Join(),
        # Leaves so small and branching so short that large nodes remain.
        near_dups.Join(percent=85, leaf=4, depth=2),
        near_dups.Join(percent=80, leaf=2, depth=0),
    ],
)
def test_against_loops(spark, join):
    check(spark, crowded_rows(), join)


def test_awkward_rows(spark):
    rows = [r for r in awkward_rows() if r[0] != 106]
    check(spark, rows, near_dups.Join(percent=85), clash=True)
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0
    # Several texts of one id: one row, and the text with the smallest digest counts.
    found = near_dups.near_duplicates(frame(spark, awkward_rows())).where("doc_id = 106").collect()
    assert len(found) == 1 and found[0].kept


def test_large_nodes_are_compared_in_blocks(spark):
    """The exact way for nodes that stay large: every two unconnected classes meet in a block."""
    rng = random.Random(2)
    base = " ".join(f"u{k}" for k in range(100))
    far = [edited(base, 30, rng) for _ in range(30)]
    rows = [(i, t, None, None, None) for i, t in enumerate([*far, edited(far[7], 1, rng)])]
    join = near_dups.Join(percent=60, leaf=6)
    docs = frame(spark, rows)
    classes = near_dups.signatures(docs, join).selectExpr(
        "doc_id AS class", "n_shingles AS n", "signature", "digest"
    )
    labels = spark.createDataFrame([(k, 10) for k in range(10, 25)], "node long, component long")
    large = classes.selectExpr("class", "n", "signature", "1 AS path")
    nodes = collections.defaultdict(set)
    for r in near_dups._blocks(large, labels, join).collect():
        nodes[r.node].add((r["class"], r.component))
    met = {frozenset((a[0], b[0])) for m in nodes.values() for a in m for b in m if a[1] != b[1]}
    part = {i: 10 if 10 <= i < 25 else i for i in range(len(rows))}
    assert met == {frozenset((a, b)) for a in part for b in part if part[a] != part[b]}
    texts = near_dups._class_texts(docs, classes, classes.select("class"), join)
    blocks = near_dups._blocks(large, spark.createDataFrame([], "node long, component long"), join)
    links = near_dups._links_in_nodes(blocks, texts, join)
    own = {r[0]: shingles(r[1]) for r in rows}
    found = {r.node: r.component for r in components(links).collect()}
    expected = groups(own, 60)
    assert {i: found.get(i, i) for i in own} == {i: g[1] for i, g in expected.items()}
    assert found[30] == 7


@pytest.mark.parametrize("leaf, most", [(64, 1), (16, 4), (8, 8)])
def test_leaves_that_share_classes_are_one(spark, leaf, most):
    """All that shared a leaf still do, in one leaf or in pairs of blocks, and in fewer leaves."""
    rng = random.Random(9)
    leaves = [sorted(rng.sample(range(30), 20)) for _ in range(25)] + [[100, 101], [101, 102], [200]]
    rows = spark.createDataFrame(
        [(n, c, 9, [c]) for n, own in enumerate(leaves) for c in own], "node long, class long, n long, signature array<int>"
    )
    found = collections.defaultdict(set)
    for r in near_dups._one_leaf(rows, near_dups.Join(leaf=leaf)).collect():
        assert r.n == 9 and r.signature == [r["class"]] and r["class"] not in found[r.node]
        found[r.node].add(r["class"])
    pairs = {(a, b) for own in leaves for a in own for b in own}
    assert pairs <= {(a, b) for own in found.values() for a in own for b in own}
    assert max(sum(c in own for own in found.values()) for c in range(30)) <= most


def test_a_dense_group_larger_than_a_leaf_is_seldom_copied(spark, monkeypatch):
    """3,000 near copies of one component in leaves of 256: each class meets full sets a few times."""
    rng = random.Random(3)
    base = [f"u{k}" for k in range(300)]
    texts = []
    for _ in range(3000):
        words = base[:]
        for at in rng.sample(range(300), 2):
            words[at] = f"w{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    met = []
    whole = near_dups._links_in_nodes

    def counted(rows, texts, join):
        met.append(rows.count())
        return whole(rows, texts, join)

    monkeypatch.setattr(near_dups, "_links_in_nodes", counted)
    found = near_dups.near_duplicates(frame(spark, rows), near_dups.Join(percent=85, leaf=256)).collect()
    assert len({r.component_id for r in found}) == 1
    assert sum(met) <= 4 * len(rows)


def test_labels_meet_classes_and_not_their_rows_in_leaves(spark, monkeypatch):
    """A passage puts a class in leaves of several trees; it gets its component once."""
    rng = random.Random(4)
    base = " ".join(f"u{k}" for k in range(200))
    passage = " ".join(f"p{k}" for k in range(100))
    texts = [edited(base, 1, rng) for _ in range(80)]
    texts += [" ".join([passage, *(f"w{rng.randrange(10**9)}" for _ in range(60))]) for _ in range(60)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    met = []
    whole = near_dups._labelled

    def counted(rows, labels, column, name):
        if "path" not in rows.columns:
            met.append(rows.count())
        return whole(rows, labels, column, name)

    monkeypatch.setattr(near_dups, "_labelled", counted)
    check(spark, rows, near_dups.Join(percent=85, leaf=64))
    assert met and max(met) <= len(rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_meet_at_full_depth(spark, percent):
    """Every node branches as often as ``depth`` allows, and yet hardly a pair meets in no tree."""
    rng = np.random.default_rng(7)
    join, pairs = near_dups.Join(percent=percent, leaf=1), 500
    first = rng.integers(0, 1 << 30, (pairs, join.places))
    other = np.where(rng.random(first.shape) < percent / 100, first, rng.integers(0, 1 << 30, first.shape))
    rows = [(2 * i + k, 100, s[i].tolist()) for i in range(pairs) for k, s in enumerate((first, other))]
    classes = spark.createDataFrame(rows, "class long, n long, signature array<int>")
    _, _, large = near_dups._tree_nodes(classes, join)
    nodes = collections.defaultdict(set)
    for r in large.select("path", "class").collect():
        nodes[r.path].add(r["class"] // 2)
    assert len({i for held in nodes.values() for i in held}) >= 0.994 * pairs


def test_table_of_links_equals_single_comparisons(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(40)]
    for cells in (1 << 20, 200):
        monkeypatch.setattr(near_dups, "CELLS", cells)
        table = near_dups._link_table(sets, 40)
        for i in range(len(sets)):
            for j in range(i):
                assert table[i, j] == near_dups._linked(sets[i], sets[j], 40)
    assert near_dups._link_table([], 40).shape == (0, 0)
    assert not near_dups._link_table([np.zeros(0, np.uint64)] * 2, 40).any()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    links = [*chain, *star, (9, 9), (300, 299), (299, 300), (160, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r.node: r.component for r in found}
    assert len(found) == len(got) == 61 + 61 + 1 + 2
    assert got[9] == 9 and got[300] == got[299] == 299
    assert {got[k] for pair in (*chain, *star) for k in pair} == {7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
