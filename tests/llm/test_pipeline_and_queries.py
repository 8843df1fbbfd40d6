"""The pipeline stage by stage, and the registered queries of this subpackage."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from check import compare
from lakeops.llm import queries

from .conftest import WORDS, prose

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Three languages, copies, near copies, benchmark passages, personal data, and rows to be rejected."""
    langs = list(WORDS)
    rows = [(k, prose(k, 60, langs[k % 3]), langs[k % 3]) for k in range(240)]
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(5)]
    rows += [(1010 + k, rows[20 + k][1] + " ending", rows[20 + k][2]) for k in range(5)]
    bench = [prose(900 + k, 30) for k in range(4)]
    rows += [(2000 + k, f"{prose(800 + k, 40)} {bench[k % 4]} {prose(850 + k, 40)}", "en") for k in range(8)]
    rows += [(3000 + k, f"{prose(950 + k, 50)} call +1 (0{k}7) 555-7713 or a.b{k}@mail.example.com", "en") for k in range(6)]
    rows += [(4000, None, "en"), (4001, "", None), (4002, "12345 !!!", "en"), (4003, "日本語の文章です", None)]
    root = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame(rows, schema).withColumns(
        {"source": F.lit("s"), "n_chars": F.coalesce(F.char_length("text"), F.lit(0)).cast("long")}
    )
    docs.repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_in_turn(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == columns and docs.count() == len(seen[name])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    everything = {r["doc_id"] for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()}
    assert everything - set(seen["language_id"]) == {4000, 4001, 4002, 4003}
    assert set(seen["language_id"]) - set(seen["near_dedup"]) == {*range(1000, 1005), *range(1010, 1015)}
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == set(range(2000, 2008))
    assert set(seen["decontamination"]) == set(seen["pii"]) == set(seen["packing"])
    for doc, row in seen["pii"].items():
        before = seen["decontamination"][doc]
        assert row["n_chars"] == len(row["text"])
        assert (row["text"] == before["text"]) == (doc < 3000)
        assert not re.search(r"555-7713|mail\.example", row["text"])
    packed = spark.read.parquet(str(tmp_path / "packing"))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").isEmpty()


def test_run_is_all_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus)
    assert {r["doc_id"] for r in rows.select("doc_id").collect()} == {*range(240), *range(3000, 3006)}


def test_stages_on_no_rows_and_odd_rows(spark, corpus, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, corpus).count() == 0, name
        got = stage(spark, odd_docs, corpus)
        assert got.count() <= odd_docs.count() if name != "packing" else got.count() >= odd_docs.count()
        if name != "packing":
            assert got.columns == odd_docs.columns


def test_every_operator_is_registered_once():
    names = list(spark_entry.queries())
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names and len(names) == len(set(names))


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in ("documents", "conversations", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, DATA), queries.ORACLE_SQL[name], con).startswith("ok ")


SCHEMAS = {
    "op1": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op4": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op8": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, next_doc_id bigint",
    "op12": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string,"
    " restored_sha256 string",
    "op13": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean, quality double",
}


@pytest.mark.parametrize("prefix", sorted(SCHEMAS))
def test_queries_return_what_their_contracts_say(spark, prefix):
    (name,) = [n for n in queries.QUERIES if n.startswith(f"{prefix}_")]
    got = queries.QUERIES[name](spark, DATA)
    assert [f"{c} {k}" for c, k in got.dtypes] == SCHEMAS[prefix].split(", ")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert got.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("prefix", ["op2", "op9", "op10", "op13"])
def test_native_operators_run_no_python(spark, prefix, monkeypatch):
    """No step of them, the written ones included, has a Python node."""
    from pyspark.sql import DataFrame

    for name in ("mapInArrow", "mapInPandas", "toPandas"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **b: pytest.fail("Python in a native operator"))
    (name,) = [n for n in queries.QUERIES if n.startswith(f"{prefix}_")]
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InPandas|InArrow", plan)
