"""Centroid clustering, fill-in-the-middle and quality votes, against plain versions of what they compute."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import bounded_kmeans, fill_in_middle, queries, weak_quality

from .conftest import ODD, prose

DATA = "/root/testdata/sf0.001"


# ---- centroid clustering


def plain_kmeans(rows, clusters=8, rounds=10, seed=3):
    """Lloyd's rounds with every distance worked out, in Python's own integers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [
            [sum(column) // len(groups[k]) for column in zip(*groups[k])] if k in groups else c
            for k, c in enumerate(centres)
        ]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, cluster, distance in found:
        inertia[cluster] += distance
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, c, d in found)


VECTORS = "vec_id long, embedding array<double>, cluster string, point int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS).repartition(3)


def clustered(df, **changes):
    settings = {"clusters": 8, "rounds": 10, "seed": 3} | changes
    return sorted(tuple(r) for r in bounded_kmeans.kmeans(df, **settings).collect())


def test_kmeans_against_all_distances(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = [tuple(r) for r in queries.QUERIES["op11_centroid_clustering"](spark, DATA).collect()]
    assert sorted(got) == plain_kmeans(rows)


def test_kmeans_keeps_valid_vectors_only_and_settles_ties(spark):
    draw = random.Random(5)
    point = [draw.uniform(-3, 3) for _ in range(64)]
    rows = [(k, [draw.gauss(k % 5, 1) for _ in range(64)]) for k in range(60)]
    rows += [(100 + k, point) for k in range(30)] + [(7, rows[7][1])]  # copies of one vector, a repeated row
    # Halfway between others, large, and whole numbers that are already on the grid.
    rows += [(200, [0.0] * 64), (201, [1.0] * 64), (202, [0.5] * 64), (203, [90_000.25] * 64), (204, [-1 / 2048] * 64)]
    bad = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63)]
    bad += [(305, [math.nan] + [1.0] * 63), (306, [math.inf] + [1.0] * 63), (307, [-math.inf] * 64)]
    assert clustered(vectors(spark, rows + bad)) == plain_kmeans(rows)


def test_kmeans_on_few_vectors(spark):
    assert clustered(vectors(spark, [])) == []
    assert clustered(vectors(spark, [(1, None), (2, [0.0])])) == []
    few = [(k, [float(k % 2)] * 64) for k in range(3)]
    assert clustered(vectors(spark, few)) == plain_kmeans(few)
    same = [(k, [0.25] * 64) for k in range(12)]
    assert clustered(vectors(spark, same)) == plain_kmeans(same)
    assert clustered(vectors(spark, few), rounds=0) == plain_kmeans(few, rounds=0)
    with_null = bounded_kmeans.kmeans(vectors(spark, [(None, [1.0] * 64), (4, [2.0] * 64)]), 8, 2, 3)
    assert {r["vec_id"] for r in with_null.collect()} == {None, 4}
    with pytest.raises(Exception, match="larger"):
        clustered(vectors(spark, [(1, [1e30] * 64)]))


def test_loosening_holds_for_every_point_of_the_sphere_and_beats_the_drift():
    draw, tighter = np.random.default_rng(1), 0
    for _ in range(300):
        size = int(draw.integers(2, 6))
        centre, old = draw.normal(size=size) * 4, draw.normal(size=size)
        new, radius = old + draw.normal(size=size) * draw.uniform(0.01, 2), draw.uniform(0, 4)
        bound = bounded_kmeans.loosening(centre, radius, old, new)
        ray = draw.normal(size=(4000, size))
        points = centre + ray / np.linalg.norm(ray, axis=1, keepdims=True) * radius * draw.uniform(0, 1, (4000, 1)) ** 0.1
        nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        assert nearer.max() <= bound + 1e-9 <= np.linalg.norm(new - old) + 2e-9
        tighter += bound < 0.9 * np.linalg.norm(new - old)
    assert tighter > 100


def test_bounds_leave_most_points_unscanned_and_change_no_result():
    draw = np.random.default_rng(2)
    middles = draw.normal(size=(8, 64)) * 400
    points = (middles[draw.integers(0, 8, 4000)] + draw.normal(size=(4000, 64)) * 150).astype(np.int64)
    centroids = points[:8].copy()
    cluster, upper, lower = bounded_kmeans.scanned(points, centroids)
    looked_at = 0
    for _ in range(10):
        radius = np.array([upper[cluster == k].max(initial=0) for k in range(8)])
        new = np.stack([points[cluster == k].sum(0) // max(1, (cluster == k).sum()) for k in range(8)])
        move = bounded_kmeans.Move(centroids, new, radius)
        cluster, upper, lower, looked = bounded_kmeans.reassigned(points, cluster, upper, lower, move)
        centroids, looked_at = new, looked_at + looked.sum()
        assert (cluster == bounded_kmeans.squared_distances(points, new).argmin(1)).all()
    assert looked_at < 0.5 * 10 * len(points)


def test_squared_distances_are_exact_beyond_doubles():
    points = np.array([[2**27, -(2**27)], [2**27 - 1, 3]])
    centroids = np.array([[-(2**27), 2**27 - 1], [2**27, -(2**27) + 1]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in centroids] for p in points]
    assert bounded_kmeans.squared_distances(points, centroids).tolist() == want


# ---- fill in the middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_cut(id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_against_plain_cuts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    got = queries.QUERIES["op12_fill_in_middle"](spark, DATA).collect()
    assert len(got) == len(texts) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for row in got:
        n, form, prefix, middle, output = plain_cut(row["doc_id"], texts[row["doc_id"]])
        assert tuple(row)[:5] == (row["doc_id"], n, form, prefix, middle)
        assert (row["output_sha256"], row["restored_sha256"]) == (sha(output), sha(texts[row["doc_id"]]))


def test_fill_in_middle_on_odd_texts(spark, odd_docs, no_docs):
    draw = random.Random(9)
    marks = ["<", ">", "P", "S", "M", "<P", "S>", "<M>", " ", "\n", "\x0b", "\u0085", " ", "é", "日本", "😀", "x"]
    rows = [(k, "".join(draw.choices(marks, k=draw.randint(0, 40)))) for k in range(400)]
    rows += [(k, " ".join("ab"[: draw.randint(1, 2)] for _ in range(70_000))) for k in (500, 501, 502)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, n int")
    for docs, texts in ((frame, dict(rows)), (odd_docs, dict(ODD) | {None: "a text without an id", 9011: "twice"})):
        made = fill_in_middle.fill_in_middle(docs).withColumn(
            "restored", fill_in_middle.restored(F.col("output"), F.col("form"))
        )
        got = made.collect()
        assert len(got) == docs.count()
        for row in got:
            text = texts[row["doc_id"]] or ""
            assert tuple(row)[1:6] == plain_cut("null" if row["doc_id"] is None else row["doc_id"], text)
            assert row["restored"] == text
    assert fill_in_middle.fill_in_middle(no_docs).count() == 0


def test_boundary_set_finds_every_rank_in_every_form():
    draw = random.Random(4)
    few = sorted(draw.sample(range(300_000), 500))
    many = sorted(draw.sample(range(200_000), 90_000))
    runs = [k for start in range(0, 400_000, 5_000) for k in range(start, start + draw.randint(1, 4_000))]
    edges = [0, 63, 64, 65_535, 65_536, 131_071, 131_072, 5_000_000]
    full = list(range(65_536 * 2 + 3))
    seen = set()
    for positions in (few, many, runs, edges, full, [7], []):
        held = fill_in_middle.BoundarySet(np.array(positions, np.int64))
        seen |= {type(chunk).__name__ for chunk in held.chunks}
        assert len(held) == len(positions)
        ranks = range(len(positions)) if len(positions) < 1000 else draw.sample(range(len(positions)), 500)
        for rank in (*ranks, *([0, len(positions) - 1] if positions else [])):
            assert held.select(rank) == positions[rank]
    assert seen == {"ListChunk", "BitChunk", "RunChunk"}


# ---- quality votes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {place for k, window in enumerate(windows) if often[window] > 1 for place in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_against_plain_counts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = queries.QUERIES["op13_quality_rules"](spark, DATA).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row)[1:7] == plain_base(texts[row["doc_id"]]), row["doc_id"]
        assert not (row["kept"] and row["base_failed"])


def test_quality_counts_on_odd_texts(spark, odd_docs, no_docs):
    draw = random.Random(3)
    parts = ["a", "b", "c d", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x0c", "\r", " ", "#", "$x", "É", "日本", "😀"]
    rows = [(k, " ".join(draw.choices(parts[: draw.randint(2, 17)], k=draw.randint(0, 60)))) for k in range(300)]
    rows += [(400, "one two three four five six seven eight " * 900), (401, " ".join(f"w{k}" for k in range(60_000)))]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, votes string, n_words int")
    for docs, texts in ((frame, dict(rows)), (odd_docs, dict(ODD) | {None: "a text without an id", 9011: "twice"})):
        got = weak_quality.judged(docs).collect()
        assert len(got) == docs.count()
        for row in got:
            base = [row[name] for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
            assert tuple(base) == plain_base(texts[row["doc_id"]]), row["doc_id"]
    assert weak_quality.judged(no_docs).count() == 0
    kept = weak_quality.keep_good(odd_docs.withColumn("row", F.lit(1)))
    assert kept.columns == [*odd_docs.columns, "row"] and kept.filter("text IS NULL").isEmpty()


def plain_em(votes):
    """The rounds of expectation-maximisation over all documents, one by one."""
    known, weight = weak_quality.believed(), weak_quality.BELIEF_WEIGHT
    share, bad, good = known.good_share, list(known.on_bad), list(known.on_good)
    start_bad, start_good = list(bad), list(good)
    belief = weight * len(votes)
    for _ in range(weak_quality.MOST_ROUNDS):
        chances = []
        for cast in votes:
            odds = math.log(share / (1 - share))
            for vote, b, g in zip(cast, bad, good):
                odds += math.log(g / b) if vote else math.log((1 - g) / (1 - b))
            chances.append(1 / (1 + math.exp(-odds)))
        total = sum(chances)
        before = [share, *bad, *good]
        share = (total + belief * weak_quality.GOOD_SHARE) / (len(votes) + belief)
        for j in range(len(bad)):
            on_good = sum(p for p, cast in zip(chances, votes) if cast[j])
            on_all = sum(1 for cast in votes if cast[j])
            bad[j] = (on_all - on_good + belief * start_bad[j]) / (len(votes) - total + belief)
            good[j] = (on_good + belief * start_good[j]) / (total + belief)
        if max(abs(x - y) for x, y in zip(before, [share, *bad, *good])) < weak_quality.SETTLED:
            break
    return share, bad, good


@pytest.fixture(scope="module")
def measured(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("quality"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weak_quality.measured(docs).withColumn("votes", weak_quality.votes()).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_accuracies_are_those_of_plain_rounds(measured):
    known = weak_quality.estimate(measured)
    share, bad, good = plain_em([r["votes"] for r in measured.select("votes").collect()])
    assert known.good_share == pytest.approx(share)
    assert known.on_bad == pytest.approx(bad) and known.on_good == pytest.approx(good)
    assert min(known.accuracies()) > 0.5


def test_verdicts_against_labels_nothing_has_learnt_from(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    judged = queries.QUERIES["op13_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    counts = {(r["label"], r["kept"]): r["count"] for r in judged.filter("NOT base_failed").groupBy("label", "kept").count().collect()}
    assert counts[1, True] > 0.98 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] > 0.95 * (counts[0, False] + counts.get((0, True), 0))


def test_one_vote_for_a_fault_need_not_sink_a_text(spark):
    """A rule that often errs weighs less than all-must-pass would have it."""
    rates = weak_quality.Rates(0.8, (-1, -1, 1), (0.6, 0.3, 0.3), (0.01, 0.25, 0.9))
    rows = spark.createDataFrame([([0, -1, 1],), ([-1, 0, 0],), ([-1, -1, 1],), ([0, 0, 1],)], "votes array<tinyint>")
    noisy, sure, both, none = (r[0] for r in rows.select(rates.quality(F.col("votes"))).collect())
    assert noisy > 0.5 > sure and none > noisy > both


def test_no_documents_leave_what_is_believed(spark):
    empty = spark.createDataFrame([], "votes array<tinyint>")
    known, start = weak_quality.estimate(empty), weak_quality.believed()
    assert known.on_bad == pytest.approx(start.on_bad) and known.good_share == pytest.approx(start.good_share)


def test_prose_is_kept_and_noise_goes(spark):
    good = [(k, prose(k, 120)) for k in range(80)]
    bad = [(100 + k, " ".join(f"{w}###" for w in prose(k, 80).split())) for k in range(8)]
    bad += [(200 + k, prose(k, 80).upper().replace(" ", "!! ")) for k in range(8)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    assert {r["doc_id"] for r in weak_quality.keep_good(docs).collect()} == set(range(80))
