"""Near-duplicate documents by a chosen-path similarity join over minwise signatures.

1. Every text becomes its set of word shingles, a digest of the set, and a signature of minwise
   values. Documents with equal sets are one class; classes are compared, not copies.
2. Independent trees start from one signature place each: classes that share the minwise value
   there share a node. A node with more classes than a leaf may hold branches again by one or
   more other places, chosen by its path, so classes that only share a frequent passage soon
   part. Each branching makes up for the pairs it parts, see ``Join``.
3. Before nodes too large for a leaf branch, their classes are compared with a pivot, and what can
   be linked is confirmed on the full sets. A node of one component is done: it cannot connect
   anything more. One with few classes outside its largest component is settled by blocks, see
   below. So a huge group of near copies, which no branching parts, leaves the trees early.
4. In a leaf, every class is compared with all others by signature inside the task. Those that can
   be linked with one of another component name the most similar partner, and these are confirmed
   on the full sets. Leaves of several trees that share such classes are then one, as far as
   it is no larger than a leaf may be, so a group met in all trees is compared once from there on.
5. After some such rounds the leaves that still hold classes of several components compare these on
   their full sets, and return links that connect components, not all pairs. In nodes that are
   settled or stay large to the end, the classes outside the largest component are compared with all
   others in blocks of a leaf's size.

No step holds a group of copies in one task or lists the pairs of a group.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.components import components
from stationcast.llm.shingles import mix, words
from stationcast.llm.tables import documents, id_text, map_slices, partitions, slices
from stationcast.session import stage


# Cells of a table of sets and elements at most.
CELLS = 1 << 20
# Partners that a class of a leaf tries before all are compared.
ROUNDS = 2
# Classes of a leaf that are compared with all others of it at once.
CHUNK = 256


@dataclass(frozen=True)
class Join:
    """Parameters. ``percent``: linked if 100 * intersection >= percent * union.

    A pair at the threshold shares a place of the signature with probability p = percent/100. A
    node branches by 1/p places on average (``branching``, in hundredths), so that a branching
    keeps as many meetings of such a pair as it parts, and a tree finds it with similar odds at
    any depth. There are as many ``trees`` as let at most a share ``missed`` of the pairs at the
    threshold meet in none, even if every node branches ``depth`` times. ``slack`` is how many
    standard deviations fewer equal places than expected still count as a candidate.
    """

    percent: int = 80
    shingle: int = 5
    places: int = 64
    missed: float = 0.001
    leaf: int = 2048
    depth: int = 8
    slack: float = 5.0

    @property
    def branching(self) -> int:
        return -(-10000 // self.percent)

    @property
    def trees(self) -> int:
        return _trees(self)

    @property
    def least_equal(self) -> int:
        p = self.percent / 100
        return max(1, int(self.places * p - self.slack * (self.places * p * (1 - p)) ** 0.5))


@functools.lru_cache
def _trees(join: Join) -> int:
    """The fewest trees of ``join.depth`` branchings that miss no more than ``join.missed``.

    A pair at the threshold has k of its places equal with the odds of a binomial draw, and in
    every tree meets at a place with chance k of ``join.places``.
    """
    p, whole, rest = join.percent / 100, join.branching // 100, join.branching % 100 / 100
    odds, lost = [], []
    for k in range(join.least_equal, join.places + 1):
        odds.append(math.comb(join.places, k) * p**k * (1 - p) ** (join.places - k))
        share, below = k / join.places, 0.0
        for _ in range(join.depth):
            one = 1 - share + share * below
            below = one**whole * (1 - rest + rest * one)
        lost.append(1 - share + share * below)
    trees = 1
    while sum(o * q**trees for o, q in zip(odds, lost, strict=True)) > join.missed * sum(odds):
        trees += 1
    return trees


def _multipliers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[bytes], size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text; and all windows with their bounds."""
    windows, bounds = words(texts, lower=True).window(size)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = np.sort(windows[a:b])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        sets.append(own)
    return sets, windows, bounds


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _digest(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def signatures(docs: DataFrame, join: Join) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set (null if empty), ``signature``."""
    multipliers = _multipliers(join.places)

    def sign(batch: pa.RecordBatch) -> dict:
        sets, windows, bounds = shingle_sets(_texts(batch), join.shingle)
        filled = np.flatnonzero(np.diff(bounds))
        signed = np.zeros((len(sets), join.places), np.int32)
        if len(filled):
            for k, m in enumerate(multipliers):
                least = np.minimum.reduceat(mix(windows * m), bounds[filled])
                signed[filled, k] = (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
        offsets = np.arange(len(sets) + 1, dtype=np.int32) * join.places
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": np.fromiter(map(len, sets), np.int64, len(sets)),
            "digest": pa.array([_digest(s) for s in sets], pa.binary()),
            "signature": pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed.reshape(-1))),
        }

    schema = "doc_id long, n_shingles long, digest binary, signature array<int>"
    return map_slices(id_text(docs).where(F.col("doc_id").isNotNull()), sign, schema)


def _branch(path: Column, place: Column) -> Column:
    return F.xxhash64(path, place, F.get("signature", place))


def _children(path: str, level: int, join: Join) -> Column:
    """The nodes that a row of a large node goes to: as many as ``join.branching`` on average."""
    first, chance = (
        F.pmod(F.xxhash64(path, F.lit(2 * level + k)), F.lit(n)).cast("int")
        for k, n in ((0, join.places), (1, 100))
    )
    whole, rest = divmod(join.branching, 100)
    # Places side by side are as independent as any, and never the same one twice.
    nodes = [
        _branch(F.col(path), F.pmod(first + F.lit(k), F.lit(join.places)).cast("int"))
        for k in range(min(whole + 1, join.places))
    ]
    return F.when(chance < rest, F.array(*nodes)).otherwise(F.array(*nodes[:whole]))


def _alike(join: Join) -> Column:
    """Whether a row and the ``first`` class of its node can reach the threshold."""
    fits = 100 * F.least("n", "first.n") >= join.percent * F.greatest("n", "first.n")
    return fits & (F.col("equal") >= join.least_equal)


def _equal_places(a: str, b: str) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


Settle = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def _tree_nodes(classes: DataFrame, join: Join, settle: Settle | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves (``members``), and rows of the nodes that are settled and of those left large.

    ``settle`` parts the rows of large nodes into those to branch on and those to settle.
    """
    roots = F.array(*[_branch(F.lit(-1 - k), F.lit(k % join.places)) for k in range(join.trees)])
    rows = classes.select("class", F.explode(roots).alias("path"))
    leaves = classes.sparkSession.createDataFrame([], "members array<long>")
    settled = none = classes.limit(0).withColumn("path", F.lit(0).cast("long"))
    for level in range(join.depth + 1):
        if level:
            child = F.explode(_children("path", level, join)).alias("path")
            rows = stage(rows.select("class", "n", "signature", child), "children")
        nodes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        rows = stage(rows.join(stage(nodes, "nodes"), "path"), "paths")
        small = rows.where(F.col("held") <= join.leaf).groupBy("path")
        leaves = leaves.union(small.agg(F.sort_array(F.collect_list("class"))).drop("path"))
        rows = rows.where(F.col("held") > join.leaf).drop("held")
        if rows.isEmpty():
            return leaves, settled, none
        if level == 0:
            rows = stage(rows.join(classes, "class"), "large")
        if settle:
            rows, done = settle(rows)
            settled = settled.unionByName(done)
            if rows.isEmpty():
                return leaves, settled, none
    return leaves, settled, rows


class _Groups:
    """The links confirmed so far, and the component of every class that has one."""

    def __init__(self, docs: DataFrame, classes: DataFrame, join: Join):
        spark = docs.sparkSession
        self.docs, self.classes, self.join = docs, classes, join
        self.links = spark.createDataFrame([], "a long, b long")
        self.labels = spark.createDataFrame([], "node long, component long")
        self.any = False

    def label(self, rows: DataFrame) -> DataFrame:
        if not self.any:
            return rows.withColumn("component", F.col("class"))
        return _labelled(rows, self.labels, "class", "component")

    def texts(self, wanted: DataFrame) -> DataFrame:
        return stage(_class_texts(self.docs, self.classes, wanted.distinct(), self.join), "texts")

    def add(self, found: DataFrame) -> None:
        found = stage(found, "links")
        if not found.isEmpty():
            self.links = self.links.union(found)
            self.labels = components(self.links)
            self.any = True

    def add_partners(self, met: DataFrame, texts: DataFrame | None = None) -> None:
        """Confirm, for each class, the partner with the most equal places, the smallest of these."""
        best = F.max_by("partner", F.struct("equal", -F.col("partner"))).alias("partner")
        pairs = met.groupBy("class").agg(best)
        low, high = F.least("class", "partner").alias("a"), F.greatest("class", "partner").alias("b")
        pairs = stage(pairs.select(low, high).distinct(), "pairs")
        if not pairs.isEmpty():
            if texts is None:
                ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b"))
                texts = self.texts(ends)
            self.add(confirmed(pairs, texts, self.join))

    def settle(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Compare large nodes with a pivot; nodes to branch on, and those with a small rest."""
        held = self.label(rows)
        first = F.min(F.struct("class", "n", "signature", "component")).alias("first")
        pivots = stage(held.groupBy("path").agg(first), "pivots")
        met = held.join(pivots, "path").where(F.col("component") != F.col("first.component"))
        met = met.withColumn("equal", _equal_places("signature", "first.signature")).where(_alike(self.join))
        met = stage(met.select("class", F.col("first.class").alias("partner"), "equal"), "met")
        if met.isEmpty():
            return rows, rows.limit(0)
        self.add_partners(met)
        nodes = stage(_shares(self.label(rows)), "shares")
        rest = F.col("whole") - F.col("top")
        few = (rest <= max(1, self.join.leaf // 2)).alias("few")
        held = rows.join(nodes.where(rest > 0).select("path", few), "path")
        return stage(held.where(~F.col("few")).drop("few"), "large"), held.where("few").drop("few")


def _shares(held: DataFrame) -> DataFrame:
    """Per node: its largest component, and how many classes it and the whole node have."""
    counts = held.groupBy("path", "component").agg(F.count(F.lit(1)).alias("size"))
    return counts.groupBy("path").agg(
        F.max_by("component", F.struct("size", -F.col("component"))).alias("largest"),
        F.sum("size").alias("whole"),
        F.max("size").alias("top"),
    )


_MEMBER = "class long, n long, signature array<int>, component long"


def _open_members(rows: DataFrame, join: Join, turn: int = 0) -> DataFrame:
    """The rows of each ``node`` that can be linked with one of another component in it.

    With the ``partner`` that has the most ``equal`` places, the smallest of these; at a later
    ``turn`` so many better ones are passed over, as far as there are more.
    """
    names = [f.split()[0] for f in _MEMBER.split(", ")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            fields = lists.flatten()
            columns = {n: fields.field(n) for n in names}
            classes, sizes, parts = (columns[n].to_numpy(zero_copy_only=False) for n in ("class", "n", "component"))
            signed = columns["signature"].flatten().to_numpy(zero_copy_only=False)
            signed = signed.reshape(-1, join.places)
            bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = bounds - bounds[0]
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), np.diff(bounds))
            best = np.full(len(classes), -1, np.int64)
            equal = np.zeros(len(classes), np.int32)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                by_class = a + np.argsort(classes[a:b], kind="stable")
                own, n, part = signed[by_class], sizes[by_class], parts[by_class]
                for c in range(0, b - a, CHUNK):
                    some = by_class[c : c + CHUNK]
                    same = (signed[some][:, None, :] == own[None, :, :]).sum(axis=2, dtype=np.int32)
                    low, high = np.minimum(sizes[some][:, None], n), np.maximum(sizes[some][:, None], n)
                    fits = (same >= join.least_equal) & (100 * low >= join.percent * high)
                    same = np.where(fits & (parts[some][:, None] != part), same, 0)
                    for _ in range(turn + 1):
                        at = np.argmax(same, axis=1)
                        found = same[np.arange(len(some)), at]
                        equal[some] = np.where(found > 0, found, equal[some])
                        best[some] = np.where(found > 0, classes[by_class[at]], best[some])
                        same[np.arange(len(some)), at] = 0
            kept = np.flatnonzero(equal)
            taken = {n: column.take(pa.array(kept)) for n, column in columns.items()}
            yield pa.RecordBatch.from_pydict(
                {"node": nodes[kept], **taken, "partner": best[kept], "equal": equal[kept]}
            )

    grouped = rows.groupBy("node").agg(F.collect_list(F.struct(*names)).alias("members"))
    return grouped.mapInArrow(compare, f"node long, {_MEMBER}, partner long, equal int")


def _class_texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """``class`` and ``text`` of the classes ``wanted``."""

    def digest(batch: pa.RecordBatch) -> dict:
        sets, _, _ = shingle_sets(_texts(batch), join.shingle)
        found = pa.array([_digest(s) for s in sets], pa.binary())
        return {"class": batch.column("doc_id"), "digest": found, "text": batch.column("text")}

    texts = id_text(docs).join(wanted.select(F.col("class").alias("doc_id")), "doc_id", "left_semi")
    made = map_slices(texts, digest, "class long, digest binary, text string")
    # A doc_id that comes with several texts stands for the one its class was made from.
    return made.join(classes.select("class", "digest"), ["class", "digest"], "left_semi").drop("digest")


def _linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    sizes = len(first) + len(second)
    if 100 * min(len(first), len(second)) < percent * max(len(first), len(second)):
        return False
    shared = len(np.intersect1d(first, second, assume_unique=True))
    return shared > 0 and 100 * shared >= percent * (sizes - shared)


def confirmed(pairs: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """The ``pairs`` of ``a`` and ``b`` whose full sets reach the threshold."""

    def confirm(batch: pa.RecordBatch) -> dict:
        sets = [
            shingle_sets(batch.column(n).cast(pa.binary()).to_pylist(), join.shingle)[0]
            for n in ("text", "other")
        ]
        held = [_linked(x, y, join.percent) for x, y in zip(*sets, strict=True)]
        kept = pa.array(np.flatnonzero(held))
        return {n: batch.column(n).take(kept) for n in ("a", "b")}

    first = texts.select(F.col("class").alias("a"), "text")
    second = texts.select(F.col("class").alias("b"), F.col("text").alias("other"))
    return map_slices(pairs.join(first, "a").join(second, "b"), confirm, "a long, b long")


def _link_table(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of some sets are linked with which, all compared at once.

    Elements of several sets become columns of a table of ones; its product with itself counts
    what two sets share. Columns come in blocks, so the table stays small.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]])) if len(values) else owner
    common = np.bincount(column, minlength=1) > 1
    owner, column = owner[common[column]], (np.cumsum(common) - 1)[column[common[column]]]
    shared = np.zeros((len(sets), len(sets)), np.int32)
    step = max(1, CELLS // max(1, len(sets)))
    for start in range(0, int(common.sum()), step):
        a, b = np.searchsorted(column, [start, start + step])
        table = np.zeros((len(sets), min(step, int(common.sum()) - start)), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        shared += (table @ table.T).astype(np.int32)
    linked = np.zeros(shared.shape, bool)
    for i, row in enumerate(shared):
        row = row.astype(np.int64)
        linked[i] = (row > 0) & (100 * row >= percent * (sizes[i] + sizes - row))
    return linked


def _links_in_nodes(rows: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """Links on full sets between the components that meet in a ``node``.

    Only links of classes that are in different components by then are returned, fewer than the
    node has members.
    """

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def links() -> list[tuple[int, int]]:
            found, parts = [], np.array([part for _, part, _ in held])
            linked = np.argwhere(np.triu(_link_table([own for _, _, own in held], join.percent), 1))
            for i, j in linked[parts[linked[:, 0]] != parts[linked[:, 1]]].tolist():
                if parts[i] != parts[j]:
                    found.append((held[i][0], held[j][0]))
                    parts[parts == parts[j]] = parts[i]
            return found

        def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
            columns = zip(("a", "b"), zip(*found, strict=True), strict=True)
            return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in columns})

        for batch in batches:
            for piece in slices([batch]):
                found = []
                sets, _, _ = shingle_sets(_texts(piece), join.shingle)
                names = ("node", "class", "component")
                rows = zip(*(piece.column(n).to_pylist() for n in names), sets, strict=True)
                for at, member, part, own in rows:
                    if at != node and held:
                        found += links()
                        held = []
                    node = at
                    held.append((member, part, own))
                if found:
                    yield pairs(found)
        if held and (found := links()):
            yield pairs(found)

    # The text comes to a node once per member; a task holds the sets of one node.
    met = rows.select("node", "class", "component").join(texts, "class")
    dealt = met.select("node", "class", "component", "text").repartition(partitions(rows.sparkSession), "node")
    return dealt.sortWithinPartitions("node", "class").mapInArrow(connect, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the component of ``column``; a class without links is its own."""
    own = labels.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(own, column, "left").withColumn(name, F.coalesce(name, column))


def _one_leaf(rows: DataFrame, join: Join) -> DataFrame:
    """The rows of leaves that share classes as one leaf.

    Where that is too large, every two blocks of it become a leaf, unless its classes come in fewer
    leaves as it is. Either way all that shared a leaf still do.
    """
    least = rows.groupBy("node").agg(F.min("class").alias("b"))
    shared = components(rows.join(least, "node").select(F.col("class").alias("a"), "b"))
    # Every class has an edge here, if only to itself.
    wholes = shared.select(F.col("node").alias("class"), F.col("component").alias("whole"))
    joined = stage(rows.join(wholes, "class"), "joined")
    one = joined.dropDuplicates(["whole", "class"])
    held = one.groupBy("whole").agg(F.count(F.lit(1)).alias("held"))
    sizes = joined.groupBy("whole").agg(F.count(F.lit(1)).alias("copies")).join(held, "whole")
    half = max(1, join.leaf // 2)
    blocks = F.when(F.col("held") <= join.leaf, 1).otherwise(F.ceil(F.col("held") / half))
    merged = sizes.select("whole", blocks.cast("int").alias("blocks"), "held", "copies")
    merged = stage(merged.where("blocks * held <= copies"), "merged")
    others = joined.join(merged, "whole", "left_anti").select(*rows.columns)
    mine = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    dealt = one.join(merged.select("whole", "blocks"), "whole").withColumn(
        "node",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda k: F.xxhash64(F.lit("whole"), "whole", F.least(mine, k), F.greatest(mine, k)),
            )
        ),
    )
    return others.unionByName(dealt.select(*rows.columns))


def _blocks(large: DataFrame, labels: DataFrame, join: Join) -> DataFrame:
    """Rows of nodes left large, copied to blocks that a leaf could hold.

    Classes outside a node's largest component are dealt to blocks and so are all its classes;
    every two blocks of either kind become a node. Nodes of one component need no look.
    """
    held = stage(_labelled(large, labels, "class", "component"), "held")
    nodes = _shares(held)
    size = max(1, join.leaf // 2)
    nodes = nodes.where("whole > top").select(
        "path",
        "largest",
        F.ceil(F.col("whole") / size).alias("all_blocks"),
        F.ceil((F.col("whole") - F.col("top")) / size).alias("open_blocks"),
    )
    held = held.join(stage(nodes, "mixed"), "path").withColumn("hash", F.xxhash64("class", "path"))
    mine, other = F.pmod("hash", "open_blocks"), F.pmod("hash", "all_blocks")
    asking = held.where("component != largest").withColumn(
        "node", F.explode(F.transform(F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda k: F.xxhash64("path", mine, k)))
    )
    asked = held.withColumn(
        "node", F.explode(F.transform(F.sequence(F.lit(0), F.col("open_blocks") - 1), lambda k: F.xxhash64("path", k, other)))
    )
    both = asking.unionByName(asked).select("node", "class", "n", "signature", "component")
    return both.dropDuplicates(["node", "class"])


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Groups of near duplicates: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    A document's set has the distinct windows of ``join.shingle`` words of its whole text, A to
    Z lowered; with fewer words the whole sequence is the only element, and null, empty or
    blank texts have the empty set and are linked with nothing. ``component_id`` is the smallest
    ``doc_id`` reachable by links, and ``kept`` marks the document that bears it.

    Rows that repeat a ``doc_id`` are one document, of which the text with the smallest digest
    counts; the result has one row for it. Rows without ``doc_id`` are left out of the result.
    No rows: an empty result. Other columns are not read. A very long text is a batch of its own.
    """
    signed = signatures(docs, join)
    # One text per document, then one class per set.
    signed = signed.groupBy("doc_id").agg(
        F.min(F.struct("digest", "n_shingles", "signature")).alias("of")
    )
    signed = stage(signed.select("doc_id", "of.*"), "signatures")
    classes = stage(
        signed.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("of"))
        .select(
            F.col("of.doc_id").alias("class"),
            F.col("of.n_shingles").alias("n"),
            F.col("of.signature").alias("signature"),
            "digest",
        ),
        "classes",
    )
    shapes = classes.select("class", "n", "signature")
    groups = _Groups(docs, classes, join)
    leaves, settled, large = _tree_nodes(shapes, join, groups.settle)
    # Most trees find the same leaves; each is compared once.
    leaves = leaves.distinct().select(
        F.xxhash64("members").alias("node"), F.explode("members").alias("class")
    )
    names = ("node", "class", "n", "signature")
    # Classes are labelled, not the many rows they have in the leaves of all trees.
    rows = leaves.join(groups.label(shapes), "class").select(*names, "component")
    large = stage(settled.unionByName(large.select(*settled.columns)), "settled")
    if not large.isEmpty():
        rows = rows.unionByName(_blocks(large, groups.labels, join).select(*names, "component"))
    texts = None
    for turn in range(ROUNDS + 1):
        rows = stage(_open_members(rows if turn == 0 else groups.label(rows), join, turn), "open")
        if rows.isEmpty():
            break
        if turn < ROUNDS:
            if texts is None:
                # Whoever is a partner is open as well, now or never.
                texts = groups.texts(rows.select("class"))
            groups.add_partners(rows.select("class", "partner", "equal"), texts)
            rows = _one_leaf(rows.select(*names), join) if turn == 0 else rows.select(*names)
        else:
            groups.add(_links_in_nodes(rows, texts, join))
    labels = groups.labels

    members = signed.select("doc_id", "n_shingles", "digest").join(
        classes.select("digest", "class"), "digest", "left"
    )
    members = _labelled(
        members.withColumn("class", F.coalesce("class", "doc_id")), labels, "class", "component_id"
    )
    return members.select(
        "doc_id",
        "n_shingles",
        "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Join(percent=85))
