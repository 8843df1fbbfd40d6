"""Secret scan and token counts: results by brute force, and what a second run still has to do."""

from __future__ import annotations

import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import secret_scan, token_counts
from lakeops.session import scratch_path

TEXTS = [
    'x token = "abcdefgh1234" y',
    "API_KEY: short api-key=longenough1 apikey=longenough1 Password='abc.def-ghi'",
    "token=secret=abcdefgh and AKIAABCDEFGHIJKL then AKIASHORT",
    "hex " + "0a" * 16 + " " + "0a" * 15 + " é " + "f" * 40,
    "ſecret=abcdefgh12 toKen=abcdefgh",
    "",
]


def brute(text: str):
    spans = []
    rules = (
        ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
        ("access", r"AKIA[A-Z0-9]+"),
        ("hex", r"[0-9a-f]+"),
    )
    for place, (kind, rule) in enumerate(rules):
        for m in re.finditer(rule, text, re.I | re.A if kind == "assign" else 0):
            size = len(m.group(2)) if kind == "assign" else m.end() - m.start()
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                spans.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(spans)]


def test_scan_agrees_with_the_rules_word_by_word(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in secret_scan.scan_report(docs, scratch_path(spark, "t")).collect()}
    for i, text in enumerate(TEXTS):
        wanted = brute(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert [s for s in got[i]["spans"].split(",") if s.split(":")[0] in secret_scan.BASE_KINDS] == wanted
        for kind in secret_scan.BASE_KINDS:
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind) for s in wanted)


def test_added_kinds_are_listed_beside_the_base_ones():
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.abc"
    assert [k for k, _, _ in secret_scan.find(f"-----BEGIN RSA PRIVATE KEY----- {jwt}")] == ["pem", "jwt"]


def test_a_second_version_scans_only_new_contents_and_new_rules_scan_all(spark):
    path = scratch_path(spark, "ledger")
    first = spark.createDataFrame([("a", 1, TEXTS[0]), ("b", 1, TEXTS[0]), ("c", 1, None)], "path string, version int, text string")
    assert secret_scan.scan_ledger(first, path).count() == 3
    assert spark.read.parquet(path).count() == 2  # one text, and the empty one
    second = first.union(spark.createDataFrame([("a", 2, TEXTS[2])], first.schema))
    found = {(r["path"], r["version"]): r["findings"] for r in secret_scan.scan_ledger(second, path).collect()}
    assert spark.read.parquet(path).count() == 3
    assert found["a", 1] == found["b", 1] and len(found["a", 2]) == 2 and found["c", 1] == []
    secret_scan.scan_ledger(second, path, rules="other").count()
    assert spark.read.parquet(path).groupBy("version").count().count() == 2
    assert spark.read.parquet(path).count() == 6


def test_scan_of_odd_and_of_no_rows(spark, odd_docs, no_docs):
    rows = secret_scan.scan_report(odd_docs, scratch_path(spark, "t")).collect()
    assert len(rows) == odd_docs.count() and all(r["spans"] == "" for r in rows)
    assert secret_scan.scan_report(no_docs, scratch_path(spark, "t")).count() == 0
    with pytest.raises(ValueError):
        secret_scan.scan_ledger(odd_docs.withColumn("digest", F.lit(1)), scratch_path(spark, "t"))


PATH = public_tokenizers.path("word_bpe_49k.json")


def test_counts_are_the_librarys(spark, odd_docs, no_docs):
    draw = random.Random(5)
    letters = "abcdeABCÉéßñıİΣσςſK'’,.!?<|> \t\n \u0085\x1c日本٣ⅷ́\x000123-_"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(600)]
    texts += ["don't <|endoftext|>, <|ENDOFTEXT|>. x<|startoftext|>y", "ÉCOLE, École. école"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(odd_docs.select("doc_id", "text"))
    library = Tokenizer.from_file(PATH)
    for row in token_counts.count_tokens(docs.withColumn("t", F.col("text")), PATH, scratch_path(spark, "c")).collect():
        assert row["n_tokens"] == len(library.encode(row["t"] or "", add_special_tokens=False).ids), row["t"]
        assert row["n_bytes"] == len((row["t"] or "").encode())
    assert token_counts.count_tokens(no_docs, PATH, scratch_path(spark, "c")).count() == 0


def test_small_memory_gives_the_same_counts():
    counter, small = token_counts.ChunkCounter(PATH), token_counts.ChunkCounter(PATH, entries=4)
    texts = ["one two three, four. Five", "six seven", "one. two, THREE"]
    assert [small.count([t])[0] for t in texts] == counter.count(texts)


def test_cache_holds_distinct_contents_and_grows_by_misses(spark):
    cache = scratch_path(spark, "cache")
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b\n"), (3, "c")], "doc_id long, text string")
    token_counts.count_tokens(docs, PATH, cache).count()
    assert spark.read.parquet(cache).count() == 2
    more = docs.union(spark.createDataFrame([(4, "d"), (5, "c")], docs.schema))
    assert token_counts.count_tokens(more, PATH, cache).count() == 5
    assert spark.read.parquet(cache).count() == 3


def test_a_second_run_moves_and_encodes_new_texts_only(spark, tmp_path, monkeypatch):
    from lakeops.llm import ledger

    path, done = str(tmp_path / "ledger"), []
    rows = [(f"text number {k}",) for k in range(400)]
    first = spark.createDataFrame(rows, "text string")
    later = spark.createDataFrame(rows[:390] + [("a new one",)] * 30 + [("another",), (None,), (None,)], "text string")

    def work(unseen):
        table = unseen.select("digest", F.lit("v").alias("version"), F.length("text").alias("n"))
        done.append((unseen.count(), unseen._jdf.queryExecution().executedPlan().toString()))
        return table

    def run(texts):
        addressed = texts.select(ledger.content_digest(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
        return ledger.extend(addressed, path, "digest binary, version string, n int", "v", work)

    assert run(first).count() == 400
    assert run(later).count() == 403 and run(later).count() == 403
    assert [n for n, _ in done] == [400, 3, 0]
