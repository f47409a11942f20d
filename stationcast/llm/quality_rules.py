"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule calls a text good or bad, or abstains. Texts with the same votes are one pattern, and
there are at most three to the number of rules of these, so the counts of all patterns, over all
documents, fit on the driver. Expectation-maximisation over them finds the share of good texts and
how often each rule is right about good and about bad ones; the posterior of a pattern is the
probability that its texts are good.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.features import text_counts
from stationcast.llm.tables import documents
from stationcast.session import stage

GOOD, BAD, ABSTAIN = "+", "-", "0"


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, BAD).when(self.good, GOOD).otherwise(ABSTAIN)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def rules() -> list[Rule]:
    """Several rules for each kind of bad text, so that their agreement can be learned from."""
    length = _share("word_chars", "n_words")
    distinct = _share("n_distinct_words", "n_words")
    return [
        Rule("symbols", _share("n_symbols", "n_words") > 0.3, _share("n_symbols", "n_words") < 0.05),
        Rule("letters", _share("n_letters", "word_chars") < 0.8, _share("n_letters", "word_chars") > 0.9),
        Rule("bars", _share("n_bars", "n_words") > 0.15, _share("n_bars", "n_words") < 0.02),
        Rule("same_lines", _share("n_dup_lines", "n_lines") > 0.3, F.col("n_dup_lines") == 0),
        Rule("same_words", _share("n_repeat_words", "n_words") > 0.3, _share("n_repeat_words", "n_words") < 0.1),
        Rule("distinct_words", (distinct < 0.3) & (F.col("n_words") < 2000), distinct > 0.5),
        Rule("capitals", _share("n_upper", "n_letters") > 0.4, _share("n_upper", "n_letters") < 0.15),
        Rule("cries", _share("n_cries", "n_words") > 0.3, _share("n_cries", "n_words") < 0.05),
        Rule("sentences", _share("n_ended_lines", "n_lines") < 0.3, _share("n_ended_lines", "n_lines") > 0.6),
        Rule("word_length", (length < 2.5) | (length > 12), length.between(3, 9)),
    ]


@dataclass(frozen=True)
class Estimate:
    """Share of good texts, and each rule's rate of right votes on good and on bad texts."""

    prior: float
    right_on_good: np.ndarray
    right_on_bad: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        votes = np.array([list(p) for p in patterns]).reshape(len(patterns), len(self.right_on_good))
        good, bad = votes == GOOD, votes == BAD
        log = np.log(self.prior / (1 - self.prior))
        log = log + good @ np.log(self.right_on_good / (1 - self.right_on_bad))
        log = log + bad @ np.log((1 - self.right_on_good) / self.right_on_bad)
        return 1 / (1 + np.exp(-np.clip(log, -500, 500)))


# Where the estimation starts, and what it keeps a little of: most texts are good, good texts
# pass nearly every rule, and a rule sees only some kinds of bad text.
START = Estimate(0.7, np.array(0.99), np.array(0.3))


def estimate(
    patterns: list[str], counts: np.ndarray, rounds: int = 200, trust: float = 0.02
) -> Estimate:
    """Expectation-maximisation over vote patterns.

    ``START`` keeps the weight of ``trust`` of all texts, so a rule that hardly votes keeps its
    rates and the classes cannot trade places. A bad vote always speaks against a text: bad texts
    get it at least twice as often as good ones.
    """
    number = len(patterns[0]) if patterns else 0
    right_on_good, right_on_bad = START.right_on_good.repeat(number), START.right_on_bad.repeat(number)
    found = Estimate(START.prior, right_on_good, right_on_bad)
    total = counts.sum()
    if not total:
        return found
    votes = np.array([list(p) for p in patterns])
    weight = trust * total
    for _ in range(rounds):
        good = counts * found.posterior(patterns)
        bad = counts - good
        cast = votes != ABSTAIN
        on_good = (good @ (votes == GOOD) + weight * right_on_good) / (good @ cast + weight)
        on_bad = (bad @ (votes == BAD) + weight * right_on_bad) / (bad @ cast + weight)
        on_good = on_good.clip(0.6, 0.999)
        on_bad = np.maximum(on_bad, 2 * (1 - on_good)).clip(0.02, 0.999)
        prior = float(((good.sum() + weight * START.prior) / (total + weight)).clip(0.01, 0.99))
        moved = max(
            abs(prior - found.prior),
            abs(on_good - found.right_on_good).max(),
            abs(on_bad - found.right_on_bad).max(),
        )
        found = Estimate(prior, on_good, on_bad)
        if moved < 1e-9:
            break
    return found


def judge(counts: DataFrame, rules: list[Rule], least: float = 0.5) -> DataFrame:
    """``counts`` with ``votes``, ``posterior`` and ``good`` (posterior at least ``least``).

    Accuracies are estimated from the votes on all rows. Columns with these names are replaced,
    others pass through. No rows: an empty result.
    """
    voted = counts.drop("votes", "posterior", "good").withColumn(
        "votes", F.concat(*[r.vote() for r in rules])
    )
    seen = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("votes")
    patterns = seen["votes"].tolist()
    chances = estimate(patterns, seen["n"].to_numpy(float)).posterior(patterns)
    # At most three to the number of rules rows.
    table = counts.sparkSession.createDataFrame(
        [(p, float(c)) for p, c in zip(patterns, chances, strict=True)], "votes string, posterior double"
    )
    judged = voted.join(F.broadcast(table), "votes")
    return judged.withColumn("good", F.col("posterior") >= least)


def base_failed() -> Column:
    """Too short, or mostly made of repeated word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior, ``base_failed`` and ``kept`` of every document's whole text.

    A null, empty or blank text has no words and fails the base rules. Repeated rows are judged
    each, and vote once per row.
    """
    counts = stage(text_counts(docs), "counts")
    return (
        judge(counts, rules())
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.col("good"))
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "votes",
        "posterior",
    )
