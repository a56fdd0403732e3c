"""The corpus pipeline: each stage works on all that the one before it kept.

Stages return the columns of ``documents``, the last one pieces of packed windows. Rows without an id stay
until they are packed: they have no part in links or repeats. An empty table passes as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import language, ngram_join, packing, repeats
from stratalake.llm.queries import vocabulary
from stratalake.llm.store import reachable, small_batches, split_few, stored


def _ready(spark: SparkSession) -> None:
    reachable(spark)
    small_batches(spark)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told; ``lang`` becomes the language found."""
    _ready(spark)
    judged = language.classify(docs, language.fit(docs)).where("not rejected")
    return judged.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id stays (with all rows of that id)."""
    _ready(spark)
    gone = ngram_join.join(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    may, stay = split_few(docs.withColumn("_id", F.col("doc_id").cast("long")), gone, ["_id"])
    return may.join(gone, "_id", "left_anti").unionByName(stay).select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that a document with a smaller id has; documents that lose all their words go."""
    _ready(spark)
    kept = repeats.remove(docs, repeats.find(docs))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows; the last stage."""
    _ready(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("packing", pack_windows),
]

#: Tokenizing and compression can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
