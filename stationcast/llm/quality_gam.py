"""A generalised additive model with pairwise interactions for text quality.

Every feature is cut into bins, and the model is a lookup table per feature plus one per chosen
pair of features. Boosting goes round the features: each turn fits a shallow tree to what the
model still misses, as a function of one feature's bins, and adds it to that feature's table.
Then pairs are ranked by how much a tree over both would still explain, and the best are boosted
alike. A text's score is the sum of the table entries of its bins, through the logistic function.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm.features import counts_of
from stationcast.llm.tables import documents, fold, id_text, labels, map_slices
from stationcast.session import stage

NAMES = (
    "words",
    "word_length",
    "symbols",
    "same_lines",
    "same_words",
    "distinct_words",
    "line_length",
    "ended_lines",
    "capitals",
    "digits",
    "cries",
    "bars",
)


def features_of(texts: list[str]) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = {name: values.astype(float) for name, values in counts_of(texts).items()}
    per = {name: np.maximum(n[name], 1) for name in ("n_words", "n_lines", "n_letters", "word_chars")}
    columns = (
        np.log1p(n["n_words"]),
        n["word_chars"] / per["n_words"],
        n["n_symbols"] / per["n_words"],
        n["n_dup_lines"] / per["n_lines"],
        n["n_repeat_words"] / per["n_words"],
        n["n_distinct_words"] / per["n_words"],
        np.log1p(n["n_words"] / per["n_lines"]),
        n["n_ended_lines"] / per["n_lines"],
        n["n_upper"] / per["n_letters"],
        n["n_digits"] / per["word_chars"],
        n["n_cries"] / per["n_words"],
        n["n_bars"] / per["n_words"],
    )
    return np.stack(columns, axis=1) if texts else np.zeros((0, len(NAMES)))


@dataclass(frozen=True)
class Boosting:
    """``sample``: labelled texts fitted on at most, the first by a hash of their ids."""

    sample: int = 20_000
    bins: int = 32
    rounds: int = 120
    pairs: int = 6
    pair_rounds: int = 60
    rate: float = 0.15
    leaves: int = 4
    pair_bins: int = 8
    smooth: float = 5.0


@dataclass
class Gam:
    """Bin edges of each feature, the tables, and the chosen pairs with their coarse edges."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(features), self.start)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, features[:, k], side="right")]
        coarse = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_cut(slope: np.ndarray, weight: np.ndarray, smooth: float) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    left, mass = np.cumsum(slope)[:-1], np.cumsum(weight)[:-1]
    if not len(left):
        return 0.0, 0
    rest, others = slope.sum() - left, weight.sum() - mass
    gain = left**2 / (mass + smooth) + rest**2 / (others + smooth)
    gain = gain - slope.sum() ** 2 / (weight.sum() + smooth)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(slope: np.ndarray, weight: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Step over a feature's bins with at most ``leaves`` levels, grown by the best gain."""
    parts = [(0, len(slope))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(slope[a:b], weight[a:b], smooth), k) for k, (a, b) in enumerate(parts)]
        gain, at, k = max(cuts)
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + at), (a + at, b)]
    out = np.zeros(len(slope))
    for a, b in parts:
        out[a:b] = slope[a:b].sum() / (weight[a:b].sum() + smooth)
    return out


def _pair_tree(slope: np.ndarray, weight: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """A tree over a table of two features: a cut of one, then a cut of the other on each side."""
    best, found = 0.0, np.zeros_like(slope)
    for turned in (False, True):
        s, w = (slope.T, weight.T) if turned else (slope, weight)
        for at in range(1, len(s)):
            out, gain = np.zeros_like(s), -s.sum() ** 2 / (w.sum() + smooth)
            for rows in (slice(0, at), slice(at, len(s))):
                column, mass = s[rows].sum(axis=0), w[rows].sum(axis=0)
                _, cut = _best_cut(column, mass, smooth)
                for columns in (slice(0, cut), slice(cut, None)):
                    value, under = column[columns].sum(), mass[columns].sum() + smooth
                    out[rows, columns] = value / under
                    gain += value**2 / under
            if gain > best:
                best, found = float(gain), out.T if turned else out
    return best, found


def fit(features: np.ndarray, target: np.ndarray, how: Boosting = Boosting()) -> Gam:
    """Fit to rows of features and their labels of 0 and 1.

    Without rows the score is one half; with one class only it is that class's smoothed share.
    """
    share = (target.sum() + 1) / (len(target) + 2)
    start = float(np.log(share / (1 - share)))
    if not len(target) or target.min() == target.max():
        return Gam(start if len(target) else 0.0)
    edges = [_edges(features[:, k], how.bins) for k in range(features.shape[1])]
    bins = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(target), start)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return target - chance, chance * (1 - chance)

    for _ in range(how.rounds):
        for k, own in enumerate(bins):
            slope, weight = gradients()
            size = len(tables[k])
            step = how.rate * shallow_tree(
                np.bincount(own, slope, size), np.bincount(own, weight, size), how.leaves, how.smooth
            )
            tables[k] += step
            total += step[own]
    coarse_edges = [_edges(features[:, k], how.pair_bins) for k in range(features.shape[1])]
    coarse = [np.searchsorted(e, features[:, k], side="right") for k, e in enumerate(coarse_edges)]
    sizes = [len(e) + 1 for e in coarse_edges]

    def table_of(a: int, b: int, values: np.ndarray) -> np.ndarray:
        cells = np.bincount(coarse[a] * sizes[b] + coarse[b], values, sizes[a] * sizes[b])
        return cells.reshape(sizes[a], sizes[b])

    slope, weight = gradients()
    ranked = sorted(
        itertools.combinations(range(len(bins)), 2),
        key=lambda ab: -_pair_tree(table_of(*ab, slope), table_of(*ab, weight), how.smooth)[0],
    )
    pairs = ranked[: how.pairs]
    pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in pairs]
    for _ in range(how.pair_rounds):
        for k, (a, b) in enumerate(pairs):
            slope, weight = gradients()
            _, step = _pair_tree(table_of(a, b, slope), table_of(a, b, weight), how.smooth)
            pair_tables[k] += how.rate * step
            total += how.rate * step[coarse[a], coarse[b]]
    return Gam(start, edges, tables, coarse_edges, pairs, pair_tables)


def labelled_features(docs: DataFrame, marks: DataFrame, label: str, how: Boosting) -> pd.DataFrame:
    """Features and label of at most ``how.sample`` labelled documents.

    ``marks`` has ``doc_id`` and ``label``; rows without either are skipped, and of several labels
    of a document the smallest counts. Documents are taken in the order of a hash of their ids.
    """
    known = marks.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    chosen = (
        known.groupBy("doc_id")
        .agg(F.min(label).cast("double").alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(how.sample)
    )

    def rows(batch: pa.RecordBatch) -> dict:
        made = features_of(batch.column("text").to_pylist())
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(len(made) + 1, dtype=np.int32) * len(NAMES)), pa.array(made.reshape(-1))
        )
        return {"doc_id": batch.column("doc_id"), "target": batch.column("target"), "features": flat}

    texts = id_text(docs).join(stage(chosen, "labelled"), "doc_id").select("doc_id", "text", "target")
    made = map_slices(texts, rows, "doc_id long, target double, features array<double>")
    return made.toPandas().sort_values("doc_id", ignore_index=True)


def train(docs: DataFrame, marks: DataFrame, label: str = "quality", how: Boosting = Boosting()) -> Gam:
    found = labelled_features(docs, marks, label, how)
    made = np.array(found["features"].tolist(), dtype=float).reshape(len(found), len(NAMES))
    return fit(made, found["target"].to_numpy(float), how)


def score(docs: DataFrame, model: Gam) -> DataFrame:
    """``doc_id`` and ``score`` of every whole text; null, empty and blank texts have zero counts.

    Rows, also repeated ones, are scored each; other columns are not read.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        made = features_of(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "score": model.score(made)}

    return map_slices(id_text(docs), rows, "doc_id long, score double")


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without an id are none of those held out; labels without one are not learnt."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold(4) == 2, F.lit(False))
    model = train(docs, labels(spark, sf_dir).where(~held_out))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )
