"""Near-duplicate classes, their parts, and the classes of signatures, against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lakeops.llm import near_duplicates as nd
from lakeops.llm import spot_signatures
from lakeops.llm.components import components
from lakeops.llm.leaders import candidate_pairs
from lakeops.llm.words import shingles, word_hashes

from .conftest import prose


def edited(text: str, edits: int, seed: int) -> str:
    words, draw = text.split(" "), random.Random(seed)
    for place in draw.sample(range(len(words)), edits):
        words[place] = f"edit{seed}x{place}"
    return " ".join(words)


def shingle_set(text: str) -> frozenset:
    words = re.findall(r"\w+", text.lower())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def classes_of(texts: dict, similar) -> dict:
    """Brute force: connected components of all similar pairs, named by the smallest id."""
    label = {i: i for i in texts}
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and similar(a, b):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if n == old else n for i, n in label.items()}
    return label


def test_words_are_runs_of_word_characters():
    texts = ["The, cat_1 sat!", "the CAT_1 sat", None, "", "“été” — l’été", "été l été", "a"]
    hashes, bounds = word_hashes(texts)
    parts = [hashes[bounds[k] : bounds[k + 1]].tolist() for k in range(len(texts))]
    assert parts[0] == parts[1] and len(parts[0]) == 3
    assert parts[2] == parts[3] == [] and parts[4] == parts[5] and len(parts[6]) == 1


def test_shingles_are_all_runs_of_five_and_never_span_texts():
    texts = ["a b c d e f", "b c d e f g h", "x y", "", "x y", "y x"]
    value, owner = shingles(*word_hashes(texts), 5)
    sets = [set(value[owner == k].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [2, 3, 1, 0, 1, 1]
    assert len(sets[0] & sets[1]) == 1 and sets[2] == sets[4] != sets[5]


def test_samples_agree_as_often_as_the_weighted_similarity():
    draw = np.random.default_rng(4)
    shingle = np.sort(draw.integers(1, 1 << 48, 400, dtype=np.uint64))
    weight = draw.uniform(0.5, 3, 400).astype(np.float32)
    for cut in (40, 150, 300):
        first, second = slice(0, 400 - cut), slice(cut, 400)
        wanted = nd.weighted_jaccard(shingle[first], weight[first], shingle[second], weight[second])
        got = []
        for shift in range(40):
            one, two = (
                nd.samples(shingle[s] ^ np.uint64(shift << 20), weight[s], np.array([0])) for s in (first, second)
            )
            got.append(np.mean(one == two))
        assert abs(np.mean(got) - wanted) < 0.05


def test_samples_agree_as_the_weights_do_where_only_they_differ():
    draw = np.random.default_rng(5)
    shingle = np.sort(draw.integers(1, 1 << 48, 300, dtype=np.uint64))
    one, two = (draw.uniform(0.5, 3, 300).astype(np.float32) for _ in range(2))
    wanted = nd.weighted_jaccard(shingle, one, shingle, two)
    got = [
        np.mean(nd.samples(shingle ^ np.uint64(s << 20), one, np.array([0])) == nd.samples(shingle ^ np.uint64(s << 20), two, np.array([0])))
        for s in range(60)
    ]
    assert abs(np.mean(got) - wanted) < 0.05


def test_weights_count_all_documents(spark):
    texts = ["common words that all share here"] * 600 + [prose(i, 30) for i in range(600)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(20)
    weights = nd.idf_weights(frame)
    value = nd.features(texts[:1])[1]
    assert set(value.tolist()) <= set(weights.shingle.tolist())
    at = np.searchsorted(weights.shingle, value)
    share = 1 - np.log(0.5) / np.log(nd.RARE_SHARE)
    assert np.allclose(weights.weight[at], 1 - (1 - nd.LEAST_WEIGHT) * share)
    assert nd.idf_weights(frame.limit(0)).shingle.size == 0


def test_classes_agree_with_brute_force(spark):
    texts, draw = {}, random.Random(7)
    for k in range(60):
        base = prose(k, draw.randint(30, 120))
        for c in range(draw.choice([1, 1, 2, 4])):
            texts[k * 10 + c] = edited(base, draw.randint(0, 4), k * 10 + c) if c else base
    texts |= {2000 + i: t for i, t in enumerate([texts[0], texts[0].upper(), texts[20] + "!"])}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    wanted = classes_of(texts, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(frame).collect()}
    unlike = {i for i in texts if got[i] != wanted[i]}
    # Weights may move pairs that lie at the threshold, and nothing else.
    assert all(
        any(0.76 < len(sets[i] & sets[j]) / len(sets[i] | sets[j]) < 0.84 for j in texts if j != i and sets[i] & sets[j])
        for i in unlike
    ) and len(unlike) <= 4


def test_a_large_group_of_copies_is_one_class(spark):
    base = prose(1, 150)
    rows = [(i, edited(base, i % 3, i) if i else base) for i in range(400)] + [(1000 + i, prose(100 + i, 60)) for i in range(600)]
    got = nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    found = {r["doc_id"]: r["class_id"] for r in got.collect()}
    assert all(found[i] == 0 for i in range(400))
    assert all(found[1000 + i] == 1000 + i for i in range(600))


def test_links_between_texts_that_are_like_no_leader_are_found(spark, monkeypatch):
    """All share one band; pairs are like each other and like none of the leaders, which are the first texts."""
    pairs = {2 * k: prose(40 + k, 80) for k in range(10, 40)}
    texts = {k: prose(k, 80) for k in range(10)} | pairs | {k + 1: edited(t, 1, k) for k, t in pairs.items()}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(nd, "samples", lambda shingle, weight, starts: np.ones((len(starts), nd.ROWS * nd.BANDS), np.uint32))
    for texts_a_block in (nd.BLOCK_TEXTS, 16):
        monkeypatch.setattr(nd, "BLOCK_TEXTS", texts_a_block)
        got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(frame).collect()}
        assert got == {k: k - (k >= 20 and k % 2) for k in texts}


def test_shared_weights_are_never_underrated():
    draw = np.random.default_rng(8)
    sets = [np.sort(draw.choice(200, draw.integers(1, 90), replace=False)) for _ in range(20)]
    weights = [draw.uniform(0.9, 3, len(s)).astype(np.float32) for s in sets]
    bound = nd.most_shared(sets[:8], weights[:8], sets[8:], weights[8:])
    for a in range(8):
        for b in range(8, 20):
            both, at, to = np.intersect1d(sets[a], sets[b], return_indices=True)
            assert bound[a, b - 8] >= np.minimum(weights[a][at], weights[b][to]).sum() - 1e-3


def test_odd_rows(spark, odd_docs, no_docs):
    rows = nd.near_duplicate_classes(odd_docs).collect()
    found = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == odd_docs.count() and found[9010] == 9009 and found[None] is None
    assert all(found[i] == i for i in (9001, 9002, 9003, 9004, 9005, 9006, 9007, 9008, 9009, 9011))
    assert nd.near_duplicate_classes(no_docs).count() == 0
    marks = spark.createDataFrame([(1, "!!! ?"), (2, "!!! ?"), (3, "!!!")], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(marks).collect()} == {1: 1, 2: 1, 3: 3}


def test_one_of_each_class_stays_with_all_columns(spark, odd_docs, no_docs):
    kept = nd.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [9001, 9002, 9003, 9004, 9005, 9006, 9007, 9008, 9009, 9011] and ids.count(None) == 1
    assert nd.drop_near_duplicates(no_docs).count() == 0


def test_rows_of_one_id_with_unlike_texts_each_stay_or_go_by_their_own(spark):
    one, two, three = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(1, one), (1, two), (2, two + " more"), (3, three), (3, three), (4, one), (None, one), (5, None), (5, three)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("row", F.lit(0))
    kept = nd.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())) == sorted(
        [(1, one), (1, two), (3, three), (0, one), (5, "")]
    )
    classes = [tuple(r) for r in nd.near_duplicate_classes(frame).collect()]
    assert sorted(classes, key=str) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 1), (None, None), (5, 5), (5, 3)], key=str
    )


def test_characters_of_unspaced_scripts_are_words():
    hashes, bounds = word_hashes(["日本語。テスト", "ab日本cd", "ไทย", "한국어 말", "日 本", "日本", "a，b！c", "𠀀𠀁x"])
    assert np.diff(bounds).tolist() == [6, 4, 3, 2, 2, 2, 3, 3]
    assert hashes[bounds[4] : bounds[5]].tolist() == hashes[bounds[5] : bounds[6]].tolist()


def test_near_copies_in_chinese_are_found(spark):
    draw = random.Random(6)
    texts = ["".join(chr(draw.randint(0x4E00, 0x9000)) for _ in range(400)) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t[:200] + "改" + t[201:]) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k % 100 for k in got}


def test_components_by_minimum_labels(spark):
    draw = random.Random(3)
    chain = [(k, k + 1) for k in range(200)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    loose = [(draw.randint(2000, 2400), draw.randint(2000, 2400)) for _ in range(150)]
    links = spark.createDataFrame(chain + star + loose + star[:5], "a long, b long")
    got = {r["id"]: r["label"] for r in components(links).collect()}
    near = defaultdict(set)
    for a, b in chain + star + loose:
        near[a].add(b)
        near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[start] == min(seen)
    assert components(links.limit(0)).count() == 0


def test_buckets_give_few_pairs_and_small_ones_all(spark):
    rows = [(i, [1]) for i in range(500)] + [(i, [2, 2]) for i in (3, 7, 11, 600)]
    pairs = {(r["a"], r["b"]) for r in candidate_pairs(spark.createDataFrame(rows, "id long, bands array<long>")).collect()}
    assert {(3, 7), (3, 11), (3, 600), (7, 11), (7, 600), (11, 600)} <= pairs
    assert len(pairs) <= 3 * 500 + 6 and all(any((min(i, j), max(i, j)) in pairs for j in (3, 7, 11)) for i in range(500))


# --- signatures after common words


ANCHORS = set(spot_signatures.ANCHORS)


def brute_signatures(text) -> frozenset:
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    found = set()
    for k, word in enumerate(words):
        if word in ANCHORS:
            chain = [w for w in words[k + 1 : k + 1 + spot_signatures.REACH] if w not in ANCHORS][: spot_signatures.CHAIN]
            if len(chain) == spot_signatures.CHAIN:
                found.add((word, *chain))
    return frozenset(found or {tuple(words)})


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_report_agrees_with_brute_force(spark, odd_docs):
    import hashlib

    texts = {10 * i: prose(i, 10 + 3 * i, ("en", "de", "fr")[i % 3]) for i in range(60)}
    texts |= {7: texts[30], 9001: None, 9002: "", 9004: "!!!", 9005: "x", 9008: "word the stone " * 4000, 9009: "Äé the ﬁne 日本"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in spot_signatures.fingerprint_report(docs).collect()}
    order = sorted(texts)
    assert sorted(got) == order
    for doc, after in zip(order, [*order[1:], order[0]], strict=True):
        text, following = texts[doc] or "", texts[after] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        row = got[doc]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        own, theirs = brute_signatures(text), brute_signatures(changed)
        assert abs(row["near_edited"] - jaccard(own, theirs)) < 1e-9, doc
        assert abs(row["near_next"] - jaccard(own, brute_signatures(following))) < 1e-9
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (own == theirs)
    assert got[7]["fingerprint"] == got[30]["fingerprint"]


def test_report_of_repeated_null_and_no_rows(spark, odd_docs, no_docs):
    rows = spot_signatures.fingerprint_report(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["near_next"] <= 1 for r in rows)
    assert spot_signatures.fingerprint_report(no_docs).count() == 0
    one = spark.createDataFrame([(1, "the quick brown fox")], "doc_id long, text string")
    assert spot_signatures.fingerprint_report(one).first()["near_next"] == 1.0


def test_signature_classes_agree_with_brute_force(spark, odd_docs, no_docs):
    texts, draw = {}, random.Random(9)
    for k in range(50):
        base = prose(k, draw.randint(20, 200))
        for c in range(draw.choice([1, 2, 3])):
            texts[k * 10 + c] = edited(base, draw.randint(0, 6), k * 10 + c) if c else base
    sets = {i: brute_signatures(t) for i, t in texts.items()}
    wanted = classes_of(texts, lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)
    prints = spot_signatures.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in spot_signatures.like_classes(prints).collect()} == wanted
    odd = spot_signatures.like_classes(spot_signatures.fingerprints(odd_docs)).collect()
    assert len(odd) == odd_docs.count() and {r["class_id"] for r in odd if r["doc_id"] in (9009, 9010)} == {9009}
    assert spot_signatures.like_classes(spot_signatures.fingerprints(no_docs)).count() == 0


def test_signature_classes_of_sets_that_share_their_first_signatures(spark):
    """The signatures all sets share come first by hash; those of a pair are like each other and like no other set."""
    rows = []
    for k in range(20):
        own = [1000 * (k + 1) + j for j in range(90)]
        rows += [(2 * k, [*range(40), *own]), (2 * k + 1, [*range(40), *own[1:], 1000 * (k + 1) + 500])]
    prints = spark.createDataFrame(rows, "doc_id long, signatures array<long>")
    got = {r["doc_id"]: r["class_id"] for r in spot_signatures.like_classes(prints).collect()}
    assert got == {k: k - k % 2 for k in range(40)}


def test_signature_classes_of_few_signatures_that_all_share(spark):
    """Sets of ten of twelve signatures: no signature is rare, and leaders alone would leave links out."""
    from itertools import combinations

    sets = {k: frozenset(c) for k, c in enumerate(list(combinations(range(14), 10))[::9])}
    wanted = classes_of(sets, lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)
    prints = spark.createDataFrame([(k, sorted(c)) for k, c in sets.items()], "doc_id long, signatures array<long>")
    assert {r["doc_id"]: r["class_id"] for r in spot_signatures.like_classes(prints).collect()} == wanted


def test_filter_holds_what_was_put_in_and_little_else(spark):
    from lakeops.llm.bits import hash_filter, may_hold

    held = spark.range(20_000).selectExpr("xxhash64(id) AS h")
    bits = hash_filter(held, "h")
    assert may_hold(bits, np.array([r["h"] for r in held.collect()], np.int64)).all()
    others = np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 200_000)
    assert may_hold(bits, others).mean() < 1e-4
    assert not may_hold(hash_filter(held.limit(0), "h"), others).any()
