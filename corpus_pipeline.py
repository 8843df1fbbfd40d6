"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import decontamination, language, near_duplicates, packing, surrogates
from lakeops.session import scratch_path, ship_package, tune

#: Documents whose best language knows a smaller share of their n-grams are in no known language.
LEAST_SCORE = 0.2
SURROGATE_KEY = "test tables"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages their own labels teach; those without a letter or a known language go."""
    docs = _tuned(spark, docs)
    model = language.learn(docs.select("text", "lang"))
    return language.keep_known(docs, model, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.drop_near_duplicates(_tuned(spark, docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(_tuned(spark, docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""
    replaced = surrogates.replace_entities(_tuned(spark, docs), SURROGATE_KEY)
    if "n_chars" not in docs.columns:
        return replaced
    kind = docs.schema["n_chars"].dataType
    return replaced.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    return packing.pack(_tuned(spark, docs), public_tokenizers.path("byte_bpe_50k.json"))


def _tuned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship_package(tune(spark))
    return docs


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("pii", without_personal_data),
    ("packing", packed),
]

# SQL expresses none of the stages: tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
