"""Conversations against a plain program over whole rows, and against a search of all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.llm import conversation_repair as cr

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
LEGAL = re.compile(r"(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        named = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(named.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """The rows of one conversation in order, each with its first fault."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, found = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return rows, found


def options(row, fault):
    """Edits of a row: letter, cost, initial that it leaves (None: deleted), role."""
    out = [("D", 2, None, None)]
    if fault not in ("blank", "duplicate"):
        more = 5 if fault == "truncated" else 0
        out.append(("K", more, row[2][:1], row[2]))
        out += [("R", 1 + more, r[0], r) for r in ("user", "assistant")]
    return out


def legal_start(initials):
    """Whether some legal sequence starts so."""
    return any(LEGAL.fullmatch(initials + rest) for rest in ("", "a", "ua"))


def search(rows, found):
    """The cheapest edits, then the least string, over all edits with two inserts side by side."""
    heap, best = [(0, "", 0, "", 0, ())], None
    while heap:
        cost, audit, i, initials, inserted, kept = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(rows) and LEGAL.fullmatch(initials):
            best = min(best or (cost, audit, kept), (cost, audit, kept))
        if inserted < 3:
            for role in ("user", "assistant"):
                if legal_start(initials + role[0]):
                    heapq.heappush(heap, (cost + 5, audit + "I", i, initials + role[0], inserted + 1, (*kept, f"{role}:")))
        if i < len(rows):
            for letter, price, initial, role in options(rows[i], found[i]):
                if initial is None:
                    heapq.heappush(heap, (cost + price, audit + letter, i + 1, initials, 0, kept))
                elif initial and legal_start(initials + initial):
                    line = f"{role}:{rows[i][3]}"
                    heapq.heappush(heap, (cost + price, audit + letter, i + 1, initials + initial, 0, (*kept, line)))
    return best


def program(rows, found):
    """The same by one table over all rows and the last initial that was left."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(table):
        for _ in range(3):
            for last in steps:
                for to in steps[last].replace("s", ""):
                    if table[to]:
                        cost, audit, kept = table[to]
                        option = (cost + 5, "I" + audit, (f"{names[to]}:", *kept))
                        table[last] = min(filter(None, [table[last], option]), key=lambda t: t[:2])
        return table

    table = inserted({"": (0, "", ()), "s": None, "u": None, "a": (0, "", ())})
    for row, fault in zip(reversed(rows), reversed(found), strict=True):
        now = {}
        for last in steps:
            tried = []
            for letter, price, initial, role in options(row, fault):
                to = last if initial is None else initial
                if (initial is None or (initial and initial in steps[last])) and table[to]:
                    cost, audit, kept = table[to]
                    line = () if initial is None else (f"{role}:{row[3]}",)
                    tried.append((cost + price, letter + audit, (*line, *kept)))
            now[last] = min(tried, key=lambda t: t[:2]) if tried else None
        table = inserted(now)
    return table[""]


def expected(rows, damaged, solve):
    out = {}
    for conv in {r[0] for r in rows}:
        own, found = faults([r for r in damaged if r[0] == conv])
        cost, audit, kept = solve(own, found)
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{name: found.count(name) for name in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
            "n_repaired": len(kept),
        }
    return out


def by_conversation(df):
    return {r.pop("conv_id"): r for r in (row.asDict() for row in df.collect())}


def made_rows(count, longest, seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choices(["user", "assistant", "system", "tool", "", None, "User"], [8, 8, 2, 1, 1, 1, 1])[0]
            text = draw.choice(["One.", "Two!", "three", " \t", "", None, "Four? ", "five\n", "Six. \n"]) or ""
            rows.append((conv, None if draw.random() < 0.05 else turn, role, text if draw.random() < 0.95 else None))
    return rows


def test_equals_search_of_all_edits(spark):
    rows = made_rows(150, 4, 1)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert by_conversation(cr.repair(df, df)) == expected(rows, plain, search)


def test_equals_plain_program_with_blocks(spark, monkeypatch):
    """Long conversations go through many blocks and tasks."""
    rows = made_rows(6, 1200, 2) + [(None, 3, "user", "No id."), (None, 4, "assistant", "None?")]
    rows += [(77, 5, "user", "The same.")] * 300
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    damaged = plain_damage(rows)
    found = cr.damage(df)
    assert sorted(map(str, damaged)) == sorted(str(tuple(r)) for r in found.collect())
    blocks = cr.blocks_of(found)
    held = blocks.groupBy("absent", "conv").agg(F.count("*").alias("n"), F.max(F.size("roles")).alias("most")).collect()
    assert max(r.n for r in held) > 8 and max(r.most for r in held) <= 65
    assert by_conversation(cr.repair(found, df)) == expected(rows, damaged, program)


def test_conversations_without_rows_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair(empty, empty).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "A.")], SCHEMA).withColumn("part", F.lit(1)).withColumn("block", F.lit(2))
    row = cr.repair(df.limit(0), df).first().asDict()
    assert row["audit"] == "" and row["cost"] == 0 and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert cr.repair(df, df).first().audit == "D"


def test_a_long_text_and_an_extreme_turn(spark):
    rows = [(1, -(1 << 63), "user", "x" * 3_000_000 + "."), (1, (1 << 63) - 1, "assistant", "y.")]
    row = cr.repair(*[spark.createDataFrame(rows, SCHEMA)] * 2).first()
    assert row.audit == "KK" and row.gaps == (1 << 63) - 1


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_query_equals_plain_program(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(*SCHEMA.names).collect()]
    found = by_conversation(cr.op13_conversation_repair(spark, folder))
    assert found == expected(rows, plain_damage(rows), program)
