"""The cheapest edits that give every conversation a legal sequence of roles.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Its rows are kept, given
another role or deleted, and empty rows are inserted. The cheapest edits are found by a dynamic
program over the four states of that pattern, in the way that stores no table of all rows:

1. The rows are dealt to tasks by ranges of conversation and turn, so a long conversation is dealt
   to many, and bundled there into blocks of about the square root of the conversation's length.
   For each block a matrix tells what it costs at least to come from one state to another.
2. Backward over the blocks, the matrices give the vector of costs-to-go at every block's end.
   These checkpoints, as many as blocks, are all that is stored of the program.
3. Forward over the blocks, each block's vectors are computed again from its checkpoint, and of
   the edits whose cost is exactly what the vectors promise, the one with the least letter is
   taken. Only one block is held.

The second and third step stream over sorted blocks. The hash of a repaired conversation can
only be computed in order, so the third step of one conversation is one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.tables import partitions, prepare
from stationcast.session import stage

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
# States: nothing yet, after s, after u, after a. What may come next, and where it leads.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, None, None, 0)
# The role that an inserted row, or one that is given another role, has in each state.
WANTED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# Blocks have this many rows at least, and end beyond so many characters of text.
LEAST_BLOCK = 64
BLOCK_CHARS = 1 << 20


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


# What a row is to the program: the initial of its role, and whether it must go or is truncated.
Row = tuple[str, bool, bool]
# Costs-to-go from each state; None where no edits lead to the end.
Vector = tuple[int | None, ...]


def _least(*values: int | None) -> int | None:
    known = [v for v in values if v is not None]
    return min(known) if known else None


def _plus(a: int | None, b: int | None) -> int | None:
    return None if a is None or b is None else a + b


def with_inserts(vector: Vector, costs: Costs) -> Vector:
    """Costs-to-go before a row, given those without rows inserted there."""
    # Two inserts may follow each other; a third only leads back.
    user = _least(vector[2], _plus(vector[3], costs.insert))
    assistant = _least(vector[3], _plus(vector[2], costs.insert))
    start, system = (_least(vector[k], _plus(user, costs.insert)) for k in (0, 1))
    return start, system, user, assistant


def edits(row: Row, state: int, costs: Costs) -> list[tuple[str, int, int]]:
    """The edits of a row in a state, by letter: letter, cost, next state."""
    initial, must_go, truncated = row
    found = [("D", costs.delete, state)]
    if not must_go:
        more = costs.truncated if truncated else 0
        if initial in NEXT[state]:
            found.append(("K", more, NEXT[state][initial]))
        found.append(("R", costs.rerole + more, NEXT[state][WANTED[state]]))
    return found


def before(row: Row, after: Vector, costs: Costs) -> Vector:
    """Costs-to-go before a row from those after it."""
    plain = [_least(*[_plus(after[to], cost) for _, cost, to in edits(row, q, costs)]) for q in range(4)]
    return with_inserts(tuple(plain), costs)


def end_vector(costs: Costs) -> Vector:
    return with_inserts(FINAL, costs)


def block_matrix(rows: list[Row], costs: Costs) -> list[list[int | None]]:
    """The least cost from each state before the rows to each state after them.

    Inserts before the first row and between rows count, those after the last do not.
    """
    columns = []
    for to in range(4):
        vector: Vector = tuple(0 if q == to else None for q in range(4))
        for row in reversed(rows):
            vector = before(row, vector, costs)
        columns.append(vector)
    return [[columns[to][q] for to in range(4)] for q in range(4)]


def block_vector(matrix: list[list[int | None]], after: Vector) -> Vector:
    """Costs-to-go before a block from those after it."""
    return tuple(_least(*[_plus(matrix[q][to], after[to]) for to in range(4)]) for q in range(4))


def walk(rows: list[Row], state: int, after: Vector, costs: Costs) -> Iterator[tuple[str, int, int | None]]:
    """The edits of a block from a state on: letter, state before it, and its row if it has one.

    ``after`` holds the costs-to-go behind the block; those of its rows are computed again here.
    """
    vectors = [after]
    for row in reversed(rows):
        vectors.append(before(row, vectors[-1], costs))
    vectors.reverse()
    for i, row in enumerate(rows):
        while True:
            letter, _, to, used = _tight(edits(row, state, costs), state, vectors[i], vectors[i + 1], costs)
            yield letter, state, i if used else None
            state = to
            if used:
                break


def _tight(
    found: list[tuple[str, int, int]], state: int, here: Vector, after: Vector, costs: Costs
) -> tuple[str, int, int, bool]:
    """The edit of the least letter whose cost and what follows are what ``here`` promises."""
    target = NEXT[state][WANTED[state]]
    options = [(letter, cost, to, True) for letter, cost, to in found if _plus(after[to], cost) == here[state]]
    if _plus(here[target], costs.insert) == here[state]:
        options.append(("I", costs.insert, target, False))
    return min(options)


def closing(state: int) -> Iterator[tuple[str, int, None]]:
    """Inserts behind the last row."""
    while FINAL[state] is None:
        yield "I", state, None
        state = NEXT[state][WANTED[state]]


def next_state(letter: str, state: int, row: Row | None) -> int:
    if letter == "D":
        return state
    return NEXT[state][row[0] if letter == "K" else WANTED[state]]


# From a table of turns to blocks ------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Rows with the damage that a checksum of conversation and turn deals out, for tests of repair.

    By crc32 of ``conv_id:turn`` modulo 20, a missing one written as a space: 0 drops the row, 1
    empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 sets its role to user. Returns
    ``conv_id``, ``turn``, ``role`` and ``text``, a missing role or text as one space.
    """
    named = [F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv_id", "turn")]
    dealt = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20).alias("kind"),
    ).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return dealt.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """``conv`` and ``absent`` stand for ``conv_id`` in joins and sorts, a missing one too."""
    missing = F.col("conv_id").isNull()
    return rows.withColumns({"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "absent": missing})


_KEYS = ["absent", "conv"]
_BLOCK = (
    "absent boolean, conv string, part int, block int, roles array<string>, texts array<string>, "
    "marks binary, turns array<long>, matrix array<long>"
)
# Marks of rows.
_BLANK_MARK, _DUPLICATE, _TRUNCATED = 1, 2, 3


def _marked(rows: DataFrame) -> DataFrame:
    """Rows in the order that ``turn`` gives, with ``first_turn``, where the same row first stands.

    Rows of a conversation with equal role and text meet in a count that combines before it is
    shuffled; only texts that repeat are joined back.
    """
    same = [*_KEYS, "role", "digest"]
    keyed = _keyed(rows).withColumn("digest", F.sha2("text", 256))
    # A missing turn comes first.
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    counted = keyed.groupBy(*same).agg(F.count(F.lit(1)).alias("times"), F.min(order).alias("first"))
    repeated = stage(counted.where("times > 1").select(*same, F.lit(True).alias("repeats"), "first"), "repeated")
    lengths = stage(keyed.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n_rows")), "lengths")
    met = keyed.join(repeated, same, "left").join(lengths, _KEYS)
    later = F.col("repeats") & (order > F.col("first"))
    return met.select(
        *_KEYS, "turn", "role", "text", "n_rows", F.coalesce("repeats", F.lit(False)).alias("repeats"),
        F.coalesce(later, F.lit(False)).alias("later"),
    )


def _row_mark(text: str, duplicate: bool) -> int:
    bare = text.rstrip(BLANKS)
    if not bare:
        return _BLANK_MARK
    if duplicate:
        return _DUPLICATE
    return 0 if bare[-1] in ENDS else _TRUNCATED


def _plan_row(role: str, mark: int) -> Row:
    return role[:1], mark in (_BLANK_MARK, _DUPLICATE), mark == _TRUNCATED


def blocks_of(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The rows in blocks, each with its matrix; stored. See ``repair`` for the order of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, number = context.partitionId() if context else 0, 0
        key, limit, chars = None, 0, 0
        held: list[tuple] = []
        previous = None

        def flush() -> dict:
            nonlocal held, chars, number
            roles, texts, turns, marks = zip(*held, strict=True)
            matrix = block_matrix([_plan_row(r, m) for r, m in zip(roles, marks, strict=True)], costs)
            made = {
                "absent": key[0], "conv": key[1], "part": part, "block": number, "roles": roles, "texts": texts,
                "marks": bytes(marks), "turns": turns, "matrix": [v for line in matrix for v in line],
            }
            held, chars, number = [], 0, number + 1
            return made

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                own = (row["absent"], row["conv"])
                if held and (own != key or len(held) >= limit or chars >= BLOCK_CHARS):
                    done.append(flush())
                key, limit = own, max(LEAST_BLOCK, int(row["n_rows"] ** 0.5) + 1)
                # Rows of equal turn, role and text stand side by side.
                this = (own, row["turn"], row["role"], row["text"]) if row["repeats"] else None
                duplicate = row["later"] or (this is not None and this == previous)
                previous = this
                held.append((row["role"], row["text"], row["turn"], _row_mark(row["text"], duplicate)))
                chars += len(row["text"])
            if done:
                yield pa.RecordBatch.from_pylist(done, _ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([flush()], _ARROW)

    order = [*_KEYS, F.col("turn").asc_nulls_first(), "role", "text"]
    # Equal rows meet in one task, so that all but the first of them are seen to repeat.
    dealt = _marked(rows).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return stage(dealt.mapInArrow(run, _BLOCK), "blocks")


_ARROW = pa.schema(
    [
        ("absent", pa.bool_()),
        ("conv", pa.string()),
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("marks", pa.binary()),
        ("turns", pa.list_(pa.int64())),
        ("matrix", pa.list_(pa.int64())),
    ]
)


def checkpoints(blocks: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The costs-to-go at each block's end: ``vector``, by a pass backward over the matrices.

    A conversation has as many rows here as blocks, about the square root of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, vector = None, end_vector(costs)
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                own = (row["absent"], row["conv"])
                if own != key:
                    key, vector = own, end_vector(costs)
                found.append(list(vector))
                flat = row["matrix"]
                vector = block_vector([flat[4 * q : 4 * q + 4] for q in range(4)], vector)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(found, pa.list_(pa.int64()))], [*names, "vector"]
            )

    names = [*_KEYS, "part", "block"]
    light = blocks.select(*names, "matrix")
    order = [*_KEYS, F.col("part").desc(), F.col("block").desc()]
    sorted_blocks = light.repartition(partitions(blocks.sparkSession), *_KEYS).sortWithinPartitions(*order)
    return sorted_blocks.mapInArrow(run, "absent boolean, conv string, part int, block int, vector array<long>")


_REPAIRED = (
    "absent boolean, conv string, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string, n_repaired long"
)


class _Forward:
    """One conversation, block by block: its measures, edits and the hash of its repaired rows."""

    def __init__(self, costs: Costs):
        self.costs, self.state, self.cost = costs, 0, 0
        self.counts = [0, 0, 0, 0]
        self.illegal = self.distinct = self.n_repaired = 0
        self.first_turn = self.last_turn = self.initial = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def take(self, block: dict) -> None:
        marks, roles, texts = block["marks"], block["roles"], block["texts"]
        for mark, role, turn in zip(marks, roles, block["turns"], strict=True):
            self.counts[mark] += 1
            if self.initial is not None and self.initial + role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = role[:1]
            if turn is not None and turn != self.last_turn:
                self.distinct += 1
                self.first_turn = turn if self.first_turn is None else self.first_turn
                self.last_turn = turn
        rows = [_plan_row(r, m) for r, m in zip(roles, marks, strict=True)]
        self._apply(walk(rows, self.state, tuple(block["vector"]), self.costs), rows, roles, texts)

    def _apply(self, found: Iterable[tuple], rows: list[Row], roles: list[str], texts: list[str]) -> None:
        for letter, state, i in found:
            self.audit.append(letter)
            row = None if i is None else rows[i]
            self.state = next_state(letter, state, row)
            if letter == "D":
                self.cost += self.costs.delete
                continue
            role = roles[i] if letter == "K" else ROLES[WANTED[state]]
            self.cost += {"K": 0, "R": self.costs.rerole, "I": self.costs.insert}[letter]
            self.cost += self.costs.truncated if row and row[2] else 0
            text = "" if i is None else texts[i]
            self.digest.update(("\n" if self.n_repaired else "").encode() + f"{role}:{text}".encode())
            self.n_repaired += 1

    def result(self, key: tuple[bool, str]) -> dict:
        self._apply(closing(self.state), [], [], [])
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
        return {
            "absent": key[0], "conv": key[1], "gaps": min(gaps, MOST), "blank": self.counts[_BLANK_MARK],
            "duplicate": self.counts[_DUPLICATE], "truncated": self.counts[_TRUNCATED], "illegal": self.illegal,
            "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
            "n_repaired": self.n_repaired,
        }


# A gap that no long can hold is given as the largest one.
MOST = (1 << 63) - 1
_KINDS = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
_OUT = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in _REPAIRED.split(", "))])


def repair(turns: DataFrame, originals: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """What is wrong with each conversation, and the cheapest edits that make it legal.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; ``originals`` names the
    conversations to return, each once; one without turns has zeros, no edits and the hash of the
    empty string. Rows of a conversation stand in order of ``turn`` (missing ones first), then role
    and text. A row's first fault counts: ``blank``, ``duplicate`` (role and text stand earlier),
    ``truncated`` (its last character that is not blank is none of ``.!?``). ``gaps`` are turns
    that lack between the first and the last, ``illegal`` neighbours other than su, ua, au.

    ``audit`` has one letter per edit: K keep, R other role, D delete (a must for blank and
    duplicate rows), I insert an empty row. Among the cheapest edits the least string is taken. A
    role is known by its first letter, as it is written; a row of an empty or unknown one cannot
    be kept. ``repaired_sha256`` is the hash of the repaired ``role:text`` rows, joined by line
    feeds, and ``n_repaired`` their number. Missing roles and texts count as one space, missing
    ``conv_id`` as a conversation of its own; other columns are not read. No originals: no rows.
    """
    filled = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(n).cast("string"), F.lit(" ")).alias(n) for n in ("role", "text")],
    )
    blocks = blocks_of(filled, costs)
    vectors = stage(checkpoints(blocks, costs), "checkpoints")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own = (row["absent"], row["conv"])
                if own != key:
                    if held:
                        done.append(held.result(key))
                    key, held = own, _Forward(costs)
                held.take(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, _OUT)
        if held:
            yield pa.RecordBatch.from_pylist([held.result(key)], _OUT)

    keys = [*_KEYS, "part", "block"]
    ready = blocks.drop("matrix").join(vectors, keys)
    dealt = ready.repartition(partitions(turns.sparkSession), *_KEYS).sortWithinPartitions(*keys)
    done = dealt.mapInArrow(run, _REPAIRED)

    whole = _keyed(originals.select("conv_id")).groupBy(*_KEYS).agg(F.first("conv_id").alias("conv_id"))
    held = whole.join(done, _KEYS, "left")
    empty = hashlib.sha256(b"").hexdigest()
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return held.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
        F.coalesce("n_repaired", F.lit(0).cast("long")).alias("n_repaired"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damage(turns), turns)
