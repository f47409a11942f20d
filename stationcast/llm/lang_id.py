"""Language identification by the nearest of several centroids per language.

A text is lowered, everything but letters becomes a blank, and its byte bigrams and trigrams are
counted in hashed places. Counts are damped, weighted with the inverse document frequency over
all training documents, and normalised. From a bounded sample of each language's training
documents, spherical k-means finds a few centroids. A text gets the language of the centroid
with the largest cosine, and is rejected if it is farther from it than nearly all of the sample's
texts of that length are, by a margin that is fitted with each language held back once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.llm.tables import documents, fold, slices
from stationcast.session import stage

PLACES = 1 << 13
BLOCK = 128
BINS = 40
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


@dataclass(frozen=True)
class Training:
    """``per_language`` bounds the documents whose vectors are clustered, for each language.

    ``quantile``: a text is judged by this low quantile of the cosines of the language's sample
    texts of about its length, which a single odd text does not move. It is rejected below a share
    of it. The share is fitted: the smallest of ``shares`` that rejects ``held_back`` of the texts
    of languages the others do not know, or else the largest that rejects no more than ``lost`` of
    the known ones. Texts of fewer than ``reject_from`` grams (about two a letter) are too short to
    tell and not rejected.
    """

    per_language: int = 500
    centroids: int = 4
    iterations: int = 10
    quantile: float = 0.02
    shares: tuple[float, ...] = (0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8)
    held_back: float = 0.99
    lost: float = 0.001
    reject_from: int = 100


@dataclass(frozen=True)
class Model:
    """Centroids as rows with their language, document weights, and least cosines by length."""

    languages: list[str]
    centroids: np.ndarray
    weights: np.ndarray
    lowest: np.ndarray
    reject_from: int


def gram_counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Counts of hashed bigrams and trigrams, for ``BLOCK`` texts at a time."""
    for first in range(0, len(texts), BLOCK):
        parts = [t.lower().encode("utf-8", "replace") for t in texts[first : first + BLOCK]]
        sizes = np.fromiter((len(p) + 2 for p in parts), np.int64, len(parts))
        data = _PLAIN[np.frombuffer(b"  " + b"  ".join(parts) + b"  ", np.uint8)].astype(np.uint32)
        owner = np.repeat(np.arange(len(parts)), sizes)
        owner = np.concatenate([owner, [len(parts) - 1, len(parts) - 1]])
        blank = data == 0x20
        two = (data[:-1] << np.uint32(8)) | data[1:]
        pairs = np.flatnonzero(~(blank[:-1] & blank[1:]))
        twos = ((two[pairs] + np.uint32(1)) * np.uint32(0x9E3779B1)) >> np.uint32(19)
        three = (two[:-1] << np.uint32(8)) | data[2:]
        triples = np.flatnonzero(~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:])))
        threes = (three[triples] * np.uint32(0x85EBCA6B)) >> np.uint32(19)
        cells = np.concatenate(
            [owner[pairs + 1] * PLACES + twos, owner[triples + 1] * PLACES + threes]
        )
        counts = np.bincount(cells, minlength=len(parts) * PLACES)[: len(parts) * PLACES]
        yield first, counts.reshape(len(parts), PLACES)


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Damped, weighted and normalised counts; a text without grams is the zero vector."""
    damped = np.log1p(counts).astype(np.float32) * weights
    length = np.sqrt((damped * damped).sum(axis=1, keepdims=True))
    return damped / np.maximum(length, 1e-12)


def _length_bin(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts.sum(axis=1)).astype(np.int64).clip(0, BINS - 1)


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def document_weights(training: DataFrame) -> np.ndarray:
    """Inverse document frequency of every place, over all training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(PLACES, np.int64), 0
        for piece in slices(batches):
            for _, counts in gram_counts(piece.column("text").to_pylist()):
                held += (counts > 0).sum(axis=0)
                total += len(counts)
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(np.arange(PLACES + 1)), "held": pa.array(np.append(held, total))}
        )

    sums = training.select("text").mapInArrow(count, "place long, held long")
    found = sums.groupBy("place").agg(F.sum("held").alias("held")).toPandas()
    held = np.zeros(PLACES + 1)
    held[found["place"].to_numpy(np.int64)] = found["held"].to_numpy(np.float64)
    return np.log((1 + held[-1]) / (1 + held[:-1])).astype(np.float32) + np.float32(1)


def _sample(training: DataFrame, per_language: int) -> DataFrame:
    """``lang`` and ``text`` of up to ``per_language`` documents of each language.

    They are those of the smallest hashes of id and text. Only rows with a hash below a cut are
    ranked, which leaves about four times as many as wanted of a language, however many it has; equal
    rows count once. Should a cut leave too few, it is raised until all of the language are below.
    """
    keyed = training.withColumn("order", F.xxhash64("doc_id", "text"))
    share = F.col("order") / F.lit(float(1 << 64)) + 0.5
    sizes = keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("held"))
    cuts = stage(sizes.select("lang", (F.lit(4.0 * per_language) / F.col("held")).alias("cut")), "cuts")
    while True:
        below = keyed.join(cuts, "lang").where(share <= F.col("cut"))
        below = stage(below.select("lang", "text", "order", "cut").dropDuplicates(["lang", "order"]), "below")
        found = below.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        met = cuts.join(found, "lang", "left").where("cut < 1")
        if met.where(F.coalesce("found", F.lit(0)) < per_language).isEmpty():
            break
        # One row per language.
        cuts = stage(cuts.select("lang", (F.col("cut") * 64).alias("cut")), "cuts")
    order = Window.partitionBy("lang").orderBy("order")
    ranked = below.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    return stage(ranked.select("lang", "text"), "sample")


def cluster(rows: np.ndarray, count: int, iterations: int) -> np.ndarray:
    """Spherical k-means, started from rows that lie far from each other."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(count, len(rows)):
        nearest = (rows @ rows[chosen].T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(np.argmin(nearest)))
    centres = rows[chosen]
    for _ in range(iterations):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack(
            [rows[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))]
        )
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centres.astype(np.float32)


def train(docs: DataFrame, training: Training = Training()) -> Model:
    """Learn from the rows of ``docs`` that have both ``text`` and ``lang``.

    One task clusters a language's sample, whose size ``training`` bounds; the driver gets the
    centroids and the weights.
    """
    rows = _training(docs)
    weights = document_weights(rows)

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            langs = piece.column("lang")
            for first, counts in gram_counts(piece.column("text").to_pylist()):
                made = vectors(counts, weights)
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": langs.slice(first, len(counts)),
                        "bin": pa.array(_length_bin(counts)),
                        "vector": pa.array([v.tobytes() for v in made], pa.binary()),
                    }
                )

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        made = np.stack([np.frombuffer(v, np.float32) for v in group["vector"]])
        filled = (made != 0).any(axis=1)
        if not filled.any():
            return pd.DataFrame({"lang": [], "vector": []})
        centres = cluster(made[filled], training.centroids, training.iterations)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "vector": [c.tobytes() for c in centres]})

    sampled = _sample(rows, training.per_language)
    made = stage(sampled.mapInArrow(vectorise, "lang string, bin long, vector binary"), "vectors")
    found = (
        made.groupBy("lang")
        .applyInPandas(centroids, "lang string, vector binary")
        .toPandas()
        .sort_values(["lang", "vector"], ignore_index=True)
    )
    languages = found["lang"].tolist()
    shape = (len(found), PLACES)
    centres = np.array([np.frombuffer(v, np.float32) for v in found["vector"]], np.float32).reshape(shape)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float32).reshape(-1, PLACES)
            cosines = (held @ centres.T).astype(np.float64)
            offsets = np.arange(len(held) + 1, dtype=np.int32) * len(centres)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cosines.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("bin"), lists], ["lang", "bin", "cosines"])

    # As many rows as the samples have, of a number for each centroid.
    seen = made.mapInArrow(compare, "lang string, bin long, cosines array<double>").toPandas() if languages else None
    return Model(
        languages=languages,
        centroids=centres,
        weights=weights,
        lowest=least_cosines(seen, languages, training) if languages else np.zeros((0, BINS)),
        reject_from=training.reject_from,
    )


def _quantiles(best: np.ndarray, bins: np.ndarray, quantile: float) -> np.ndarray:
    """A low quantile of cosines for each length, over the lengths about it if there are any."""
    near = [abs(bins - b) <= 2 for b in range(BINS)]
    return np.array([np.quantile(best[n] if n.any() else best, quantile) for n in near])


def least_cosines(seen: pd.DataFrame, languages: list[str], training: Training) -> np.ndarray:
    """For each centroid and length, the cosine below which a text is rejected.

    ``seen`` has ``lang``, ``bin`` and the ``cosines`` with all centroids of the sample's texts. With
    a single language the share is the smallest, as none can be held back.
    """
    owners, langs, bins = np.array(languages), seen["lang"].to_numpy(str), seen["bin"].to_numpy(np.int64)
    cosines = np.array(seen["cosines"].tolist()).reshape(len(seen), len(languages))
    bounds = np.zeros((len(languages), BINS))
    for lang in set(languages):
        own = langs == lang
        best = cosines[own][:, owners == lang].max(axis=1)
        bounds[owners == lang] = _quantiles(best, bins[own], training.quantile)
    own_share, foreign_share = [], []
    for lang in set(languages):
        at = np.flatnonzero(langs == lang)
        for places, shares in ((owners == lang, own_share), (owners != lang, foreign_share)):
            if places.any():
                nearest = np.flatnonzero(places)[cosines[at][:, places].argmax(axis=1)]
                shares.append(cosines[at, nearest] / np.maximum(bounds[nearest, bins[at]], 1e-12))
    own = np.concatenate(own_share)
    known = [s for s in training.shares if (own < s).mean() <= training.lost] or [min(training.shares)]
    if not foreign_share:
        return bounds * min(training.shares)
    foreign = np.concatenate(foreign_share)
    enough = [s for s in known if (foreign < s).mean() >= training.held_back]
    return bounds * (min(enough) if enough else max(known))


def identify(docs: DataFrame, model: Model, prefix: str = "lang") -> DataFrame:
    """``docs`` with ``<prefix>_pred``, ``<prefix>_score`` and ``<prefix>_rejected``.

    The score is the cosine with the nearest centroid. A text that is null or has no letter is
    ``und`` with score 0 and rejected; so is every text if no language was learned. Otherwise the
    prediction is a learned language, ties going to the first, and ``rejected`` tells that the
    text is long enough to judge and too far from it. Nothing but the whole text is looked at; rows and other columns
    pass through.
    """

    def predict(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        best = np.zeros(len(texts), np.int64)
        score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        for first, counts in gram_counts(texts):
            cosines = vectors(counts, model.weights) @ model.centroids.T
            own = np.argmax(cosines, axis=1)
            here = slice(first, first + len(counts))
            best[here] = own
            score[here] = cosines[np.arange(len(own)), own].clip(0, 1)
            far = score[here] < model.lowest[own, _length_bin(counts)]
            rejected[here] = far & (counts.sum(axis=1) >= model.reject_from)
        return best, score, rejected

    languages = pa.array([*model.languages, UNKNOWN], pa.string())
    kind = pa.struct([("pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<pred string, score double, rejected boolean>")
    def nearest(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for piece in slices(iter([batch])):
            known = piece.column(0).to_pylist()
            lettered = np.array([t is not None and bool(_LETTER.search(t)) for t in known])
            usable = np.flatnonzero(lettered) if model.languages else np.zeros(0, np.int64)
            best = np.full(len(known), len(model.languages))
            score, rejected = np.zeros(len(known)), np.ones(len(known), bool)
            if len(usable):
                found = predict([known[i] for i in usable])
                best[usable], score[usable], rejected[usable] = found
            parts.append(
                pa.StructArray.from_arrays(
                    [languages.take(pa.array(best)), pa.array(score), pa.array(rejected)],
                    fields=list(kind),
                )
            )
        return pa.concat_arrays(parts)

    made = nearest.asNondeterministic()(F.col("text").cast("string"))
    return docs.withColumn("__found", made).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in {f"{prefix}_{x}" for x in ("pred", "score", "rejected")}],
        F.col("__found.pred").alias(f"{prefix}_pred"),
        F.col("__found.score").alias(f"{prefix}_score"),
        F.col("__found.rejected").alias(f"{prefix}_rejected"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # A document without an id is none of those held out.
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    model = train(docs.where(~held_out))
    found = identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select(
        "doc_id",
        "held_out",
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )
