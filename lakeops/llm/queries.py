"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    bounded_kmeans,
    decontamination,
    fill_in_middle,
    language,
    near_duplicates,
    packing,
    quotations,
    secret_scan,
    sharding,
    spot_signatures,
    surrogates,
    token_counts,
    weak_quality,
)
from lakeops.session import scratch_path, ship_package, tune

#: The key that surrogates depend on. A real run gets its own from its secret store.
SURROGATE_KEY = "test tables"

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(spark, sf_dir)``."""

    def add(run):
        QUERIES[name] = lambda spark, sf_dir: run(ship_package(tune(spark)), sf_dir)
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_secret_scans")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    counts = token_counts.count_tokens(docs, path, scratch_path(spark, "token-cache"))
    return counts.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 2048 AS over_limit")


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op9_spot_signatures")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprint_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_pii_surrogates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replacement_report(table(spark, sf_dir, "documents"), SURROGATE_KEY)


@query("op11_centroid_clustering")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_kmeans.kmeans(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, seed=3)


@query("op12_fill_in_middle")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=42)
    rebuilt = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(rebuilt, 256).alias("restored_sha256"),
    )


@query("op13_quality_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return weak_quality.judged(table(spark, sf_dir, "documents")).select(*base, "kept", "quality")


OP2_SQL = """
WITH one AS (
    SELECT conv_id, turn, regexp_replace(min(coalesce(text, '')), '^\\s+|\\s+$', '', 'g') AS text
    FROM conversations GROUP BY conv_id, turn
), linked AS (
    SELECT a.conv_id, a.turn, a.text, b.turn AS reply_turn,
           CASE WHEN b.turn IS NULL THEN 0 WHEN c.turn IS NULL THEN 1 ELSE 2 END AS n_linked
    FROM one a
    LEFT JOIN one b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 AND b.text <> ''
    LEFT JOIN one c ON c.conv_id = a.conv_id AND c.turn = a.turn - 2 AND c.text <> ''
), rooted AS (
    SELECT *, max(CASE WHEN reply_turn IS NULL THEN turn END)
              OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS root_turn
    FROM linked
)
SELECT conv_id, turn, reply_turn, root_turn, turn - root_turn AS depth, turn - root_turn + 1 AS position,
       CAST(n_linked AS BIGINT) AS n_linked, text
FROM rooted
"""


@query("op2_quotation_linking", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = quotations.quoting_messages(table(spark, sf_dir, "conversations"))

    def turn(column: str):
        return F.substring_index(column, ":", -1).cast("bigint")

    return quotations.reply_ordered(messages).select(
        F.col("thread").alias("conv_id"),
        F.col("sent").alias("turn"),
        turn("reply_to").alias("reply_turn"),
        turn("root").alias("root_turn"),
        F.col("depth").cast("bigint").alias("depth"),
        F.col("position").cast("bigint").alias("position"),
        "n_linked",
        F.col("own").alias("text"),
    )
