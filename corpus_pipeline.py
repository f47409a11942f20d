"""From raw documents to token ids: five stages, each of which reads what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.llm import bpe, lang_id, line_dedup, mixing, near_dups
from stationcast.llm.tables import documents, prepare
from stationcast.session import discard, scratch_path, stage, staging

NEAR = near_dups.Join(percent=80)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the language model, trained on all that have a label, rejects.

    Those are null texts, texts without a letter, and texts far from every learned language.
    """
    prepare(spark)
    found = lang_id.identify(docs, lang_id.train(docs), prefix="__lang")
    return found.where(~F.col("__lang_rejected")).select(*_columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out lines that repeat across documents; every document stays, also an emptied one."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that with the smallest id, a missing one last.

    Every row is compared under a number of its own, so rows that repeat an id, or have none, are
    too. The rows are stored with their numbers, which must not change between the passes.
    """
    prepare(spark)
    numbered = docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*_columns(docs)).alias("__document"))
    numbered = stage(numbered, "numbered")
    texts = numbered.select(F.col("__row").alias("doc_id"), F.col("__document.text").alias("text"))
    groups = stage(near_dups.near_duplicates(texts, NEAR).select("doc_id", "component_id"), "groups")
    ids = numbered.select(F.col("__row").alias("doc_id"), F.col("__document.doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first")
    kept = groups.join(ids, "doc_id").groupBy("component_id").agg(first)
    # Stored by itself, so that its own size decides whether the texts are shuffled for it.
    left_out = groups.select(F.col("doc_id").alias("__row")).join(
        kept.select(F.col("first.doc_id").alias("__row")), "__row", "left_anti"
    )
    return numbered.join(stage(left_out, "left-out"), "__row", "left_anti").select("__document.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents by the probabilities that meet the target weights.

    Documents without a word go, unless there are no others.
    """
    n_tokens = mixing.word_count(F.col("text"))
    facts = docs.select(
        F.struct(*_columns(docs)).alias("__document"),
        "doc_id",
        "source",
        "lang",
        n_tokens.alias("n_tokens"),
    ).withColumn("topic", mixing.text_form(F.col("__document.text"), F.col("n_tokens")))
    mixed = mixing.mix(facts, mixing.POWERS, mixing.BUDGET, rounds=mixing.ROUNDS)
    return mixed.where("sampled").select("__document.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and checksums of the ids and the decoded text."""
    prepare(spark)
    return bpe.digests(docs, bpe.vocabulary(), keep_ids=True, remember=False)


def _columns(docs: DataFrame) -> list[F.Column]:
    return [F.col(f"`{name}`") for name in docs.columns]


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

# The trained language model and the pre-tokeniser's pattern are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage stored for itself, and its input, go when its result is stored."""
    docs, earlier = documents(spark, sf_dir), None
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, name)
        with staging(spark):
            made = function(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if earlier:
            discard(spark, earlier)
        earlier = path
    return STAGES[-1][1](spark, docs, sf_dir)
