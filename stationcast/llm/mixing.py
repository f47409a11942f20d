"""Mixing sources to target weights, in built-in Spark functions only.

Documents are counted once into cells of source, language and topic. Iterative proportional
fitting then rakes the cells' token weights to the target share of every source, language and
topic: each margin keeps one factor per value, and a step divides a target by the weight that the
other margins' factors give its value. The cells are a table like any other: a step is a combining
aggregate over them, and only its factors are written down.

A document is kept with the probability of its cell, which a number drawn from its id decides. A
probability ends at one, so a large budget keeps less of the raised values than their targets say;
``repeated`` sampling gives each document a number of repeats instead, which meets the targets at
any budget.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.tables import documents
from stationcast.session import stage

MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"
MARKS = "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_form(text: Column, n_words: Column) -> Column:
    """A topic for tables that bring none: how a text is written, and how long it is."""
    text = F.coalesce(text, F.lit(""))
    marks = F.char_length(text) - F.char_length(F.translate(text, MARKS, ""))
    cries = F.char_length(text) - F.char_length(F.translate(text, "!", ""))
    return (
        F.when(2 * marks > n_words, "marked")
        .when(2 * cries > n_words, "loud")
        .when(n_words < 150, "short")
        .when(n_words < 600, "medium")
        .otherwise("long")
    )


def document_facts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the three margins and ``n_tokens`` (words), from the whole text."""
    counted = docs.select("doc_id", "source", "lang", "text", word_count(F.col("text")).alias("n_tokens"))
    topic = text_form(F.col("text"), F.col("n_tokens"))
    return counted.select("doc_id", "source", "lang", topic.alias("topic"), "n_tokens")


def flattened(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its token shares raised to ``power`` and made to add to one."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
    raised = sums.select("value", F.pow("tokens", F.lit(power)).alias("share"))
    total = raised.agg(F.sum("share")).first()[0] or 1.0
    return raised.select("value", (F.col("share") / F.lit(total)).alias("share"))


def _with_factors(cells: DataFrame, factors: Mapping[str, DataFrame], names: list[str]) -> DataFrame:
    for name in names:
        one = factors[name].select(F.col("value").alias("_value"), F.col("factor").alias(f"of_{name}"))
        cells = cells.join(one, F.col(name).eqNullSafe(F.col("_value"))).drop("_value")
    return cells


def _weight(names: list[str]) -> Column:
    return functools.reduce(operator.mul, [F.col("tokens"), *[F.col(f"of_{n}") for n in names]])


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 8) -> DataFrame:
    """``cells`` with ``weight``: their tokens times one factor per margin value.

    ``targets`` has a table of ``value`` and ``share`` for each margin. After ``rounds`` rounds
    the last margin is met exactly and the others to the last change. Values a target does
    not name, or whose cells have no tokens, get no weight. Missing values are values.
    """
    margins = list(targets)
    cells = stage(cells.where("tokens > 0"), "cells")
    goals = functools.reduce(
        DataFrame.unionByName,
        [targets[m].select(F.lit(m).alias("margin"), "value", "share") for m in margins],
    )
    goals = stage(goals, "targets")
    factors = {
        m: goals.where(F.col("margin") == m).select("value", F.lit(1.0).alias("factor")) for m in margins
    }
    for _ in range(rounds):
        for m in margins:
            others = [n for n in margins if n != m]
            sums = (
                _with_factors(cells, factors, others)
                .groupBy(F.col(m).alias("_value"))
                .agg(F.sum(_weight(others)).alias("held"))
            )
            goal = goals.where(F.col("margin") == m)
            scaled = goal.join(sums, F.col("value").eqNullSafe(F.col("_value"))).where("held > 0")
            factors[m] = stage(
                scaled.select("value", (F.col("share") / F.col("held")).alias("factor")), "factors"
            )
    return (
        _with_factors(cells, factors, margins)
        .withColumn("weight", _weight(margins))
        .drop(*[f"of_{m}" for m in margins])
    )


def cell_probabilities(raked: DataFrame, budget_share: float) -> DataFrame:
    """``probability`` per cell: in proportion to weight over tokens, one at most.

    The scale is the one at which the kept tokens are expected to be ``budget_share`` of all.
    It is found by setting aside the cells that reach one, until no other does.
    """
    raked = stage(raked.withColumn("ratio", F.col("weight") / F.col("tokens")), "raked")
    total = raked.agg(F.sum("tokens")).first()[0]
    if not total:
        return raked.select(*MARGINS, F.lit(1.0).alias("probability"))
    limit = float("inf")
    while True:
        capped = F.col("ratio") >= limit
        found = raked.agg(
            F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("whole"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        left = budget_share * total - found["whole"]
        if not found["weight"] or left <= 0:
            break
        lower = found["weight"] / left
        if lower >= limit:
            break
        limit = lower
    return raked.select(*MARGINS, F.least(F.lit(1.0), F.col("ratio") / F.lit(limit)).alias("probability"))


def cell_repeats(raked: DataFrame, budget_share: float) -> DataFrame:
    """``expected`` repeats per cell: in proportion to weight over tokens, also above one.

    The repeated tokens are expected to be ``budget_share`` of all, in the shares of the weights.
    """
    raked = stage(raked, "raked")
    found = raked.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    scale = F.lit(budget_share * found["tokens"] / found["weight"] if found["weight"] else 1.0)
    return raked.select(*MARGINS, (F.col("weight") / F.col("tokens") * scale).alias("expected"))


def drawn(doc_id: Column, seed: int) -> Column:
    """A number from 0 to below 1 that depends on the document's id and the seed only."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def mix(
    facts: DataFrame,
    powers: Mapping[str, float],
    budget_share: float,
    seed: int = 1,
    rounds: int = 8,
    repeated: bool = False,
) -> DataFrame:
    """``facts`` with ``probability`` and ``sampled``, if ``repeated`` also ``expected`` and ``repeats``.

    ``facts`` has the three margins, ``n_tokens`` and ``doc_id``; further columns pass through,
    unless they are called like the new ones. The target shares are the corpus's own token
    shares flattened by ``powers``. Missing sources, languages and topics are values of their
    own. Documents without tokens have no weight and are never kept, save when no document has
    any: then all are. Equal ids share their draw; a missing id draws as an empty one.
    No rows: an empty result.

    ``repeats`` is the whole part of ``expected`` and one more if the draw is below the rest;
    ``probability`` and ``sampled`` then tell whether a document is in the sample at all.
    """
    cells = stage(
        facts.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")),
        "margins",
    )
    filled = cells.where("tokens > 0")
    targets = {m: flattened(filled, m, powers[m]) for m in MARGINS}
    raked = rake(cells, targets, rounds)
    made = cell_repeats(raked, budget_share) if repeated else cell_probabilities(raked, budget_share)
    chances = stage(made, "chances")
    value = F.col("expected" if repeated else "probability").alias("_p")
    chances = chances.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], value)
    same = functools.reduce(operator.and_, [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in MARGINS])
    empty = chances.isEmpty()
    chance = F.lit(1.0) if empty else F.when(F.col("n_tokens") > 0, F.coalesce("_p", F.lit(0.0))).otherwise(0.0)
    draw, used = drawn(F.col("doc_id"), seed), ["_p", *[f"_{m}" for m in MARGINS]]
    if not repeated:
        return (
            facts.drop("probability", "sampled")
            .join(chances, same, "left")
            .withColumn("probability", chance)
            .withColumn("sampled", draw < F.col("probability"))
            .drop(*used)
        )
    whole = F.floor("expected")
    return (
        facts.drop("probability", "sampled", "expected", "repeats")
        .join(chances, same, "left")
        .withColumn("expected", chance)
        .withColumn("repeats", (whole + (draw < F.col("expected") - whole).cast("long")).cast("int"))
        .withColumn("probability", F.least(F.lit(1.0), F.col("expected")))
        .withColumn("sampled", F.col("repeats") > 0)
        .drop(*used)
    )


# Production parameters of the query and of the pipeline's stage.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
BUDGET = 0.8
ROUNDS = 8


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = stage(document_facts(documents(spark, sf_dir)), "facts")
    mixed = mix(facts, POWERS, BUDGET, rounds=ROUNDS, repeated=True)
    return mixed.withColumns({c: F.round(c, 6) for c in ("probability", "expected")})
