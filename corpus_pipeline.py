"""A training corpus from raw documents, in five stages.

Each stage reads what the one before has written and returns the columns of
``documents``; the last returns the mix.  Nulls, empty texts and repeated rows are
handled as the operators say; documents without an id are near duplicates like others,
and one with an id is kept before them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, quality_model, registry, suffix_dedup, winnowing
from tidemark.session import scratch_path, use_utc

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = ("lang", "source", "n_chars")
#: What a word of the join has: a character that is no ASCII blank.
_WORD = r"[^\x20\x09-\x0D]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    weights, _ = quality_model.train(docs, registry.table(spark, sf_dir, "labels"))
    scored = quality_model.score_quality(docs, weights, keep_cols=("text", *_OTHERS))
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, nulls last, and of these the least text.

    Membership is a matter of rows, not of ids: rows that share an id but are not similar all
    stay.  Texts without words are similar to nothing and stay; only a repeated id and text,
    which is the same document, is there once.
    """
    others = F.struct(*_OTHERS)
    docs = docs.select(*COLUMNS)
    has_words = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    worded = docs.where(has_words).withColumn("_key", F.md5("text"))
    groups = ngram_join.near_duplicates(worded, keep_cols=("_key",), component_col="_component")
    # The rows that have the smallest id of their group, known by their texts.
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.col("doc_id").alias("_id"), "_key", "_component").distinct()
    rows = worded.join(first, worded["doc_id"].eqNullSafe(first["_id"]) & (worded["_key"] == first["_key"]))
    kept = rows.groupBy("_component").agg(F.min(F.struct("doc_id", "text", *_OTHERS)).alias("row")).select("row.*")
    wordless = docs.where(~has_words)
    named = wordless.where("doc_id IS NOT NULL").groupBy("doc_id", "text").agg(F.min(others).alias("rest"))
    named = named.select("doc_id", "text", "rest.*")
    return kept.unionByName(named).unionByName(wordless.where("doc_id IS NULL"))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that a document of a smaller id has too; emptied ones go."""
    cut = suffix_dedup.remove_strings(docs, keep_cols=_OTHERS, with_text=True)
    emptied = (F.col("n_removed") > 0) & (F.trim("kept_text") == "")
    touched = F.col("n_removed") > 0
    return cut.where(~emptied).select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.when(touched, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = registry.table(spark, sf_dir, "benchmark")
    judged = winnowing.decontaminate(docs.select(*COLUMNS), benchmark, keep_cols=("text", *_OTHERS))
    return judged.where("n_hit = 0").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

# A trained classifier, components and exact repeats over all documents have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the input of the next."""
    docs = registry.table(use_utc(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
