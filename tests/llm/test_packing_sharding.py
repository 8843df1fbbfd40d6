"""Packing and sharding against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import packing, places, sharding

from .conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Z'srdéß\n\t  .,1٣ⅷ日<|endoftx> \u0085́"), max_size=40))
def test_ids_are_the_librarys(text):
    encoder = test_ids_are_the_librarys.__dict__.setdefault("encoder", packing.Encoder(PATH))
    assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def fill(counts, patterns, capacity):
    used, sequences = Counter(), 0
    for p in patterns:
        assert sum(n * m for n, m in p.parts) <= capacity
        assert p.first == sequences
        sequences += p.times
        for n, m in p.parts:
            used[n] += m * p.times
    assert used == Counter(counts)
    return sequences


def best_fit_decreasing(counts, capacity):
    room = Counter()  # sequences by what is left in them
    for n in sorted(Counter(counts).elements(), reverse=True):
        fit = min((r for r in room if r >= n), default=capacity)
        if room[fit]:
            room[fit] -= 1
            if not room[fit]:
                del room[fit]
        room[fit - n] += 1
    return sum(room.values())


def test_plan_uses_every_piece_once_and_no_more_sequences_than_best_fit():
    draw = random.Random(1)
    for most in (3, 20):
        counts = {n: draw.randint(1, most) for n in draw.sample(range(1, 1025), 300)}
        assert fill(counts, packing.minimum_slack(counts, 1024), 1024) <= best_fit_decreasing(counts, 1024) * 1.003
    many = {n: draw.randint(1, 10**7) for n in range(1, 513)}
    least = sum(n * c for n, c in many.items()) / 1024
    assert fill(many, packing.minimum_slack(many, 1024), 1024) <= least * 1.001


def test_fullest_combination_is_the_best_of_all():
    draw = random.Random(2)
    for _ in range(60):
        counts = Counter(draw.randint(1, 20) for _ in range(draw.randint(1, 9)))
        room = draw.randint(0, 60)
        sums = {0}
        for n in counts.elements():
            sums |= {s + n for s in sums}
        chosen = packing._fullest(counts, room)
        assert sum(n * m for n, m in chosen.items()) == max(s for s in sums if s <= room)
        assert all(m <= counts[n] for n, m in chosen.items())


def check_packed(rows, texts, capacity=1024):
    library = Tokenizer.from_file(PATH)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts.items()}
    place = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and len(part) == r["length"]
        place[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for parts in place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return pieces, ids, place


def test_pieces_cover_documents_and_sequences_have_no_gaps(spark, odd_docs, no_docs):
    texts = {i: prose(i, 5 + 37 * i) for i in range(60)} | {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    rows = [(i, t) for i, t in texts.items() if i != 9011]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(docs, PATH, keep_ids=True).cache()
    pieces, ids, place = check_packed(packed.collect(), texts)
    for doc, parts in pieces.items():
        assert [(p, s) for p, s, _ in sorted(parts)] == [
            (k, s) for k, s in enumerate([0, *range(len(ids[doc]) % 1024 or 1024, len(ids[doc]), 1024)])
        ]
        assert all(length == 1024 for _, _, length in sorted(parts)[1:])
    assert pieces[9001] == [(0, 0, 1)] and len(pieces) == len(rows)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(map(len, whole.values())) == sum(len(ids[d]) for d in pieces)
    assert all(len(whole[s]) == sum(n for _, n in parts) for s, parts in place.items())
    assert packing.pack(no_docs, PATH).count() == 0
    assert packing.pack(odd_docs, PATH).filter("doc_id = 9011").count() == 2


def test_numbers_are_gapless_in_groups_of_any_size(spark):
    rows = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS g")
    got = places.numbered(rows, ["g"], ["id"], "n", bucket_rows=50).groupBy("g").agg(F.sort_array(F.collect_list("n")).alias("n"))
    assert all(r["n"] == list(range(len(r["n"]))) for r in got.collect())


def sharded(df, **how):
    return sharding.kd_shards(df, **how).collect()


def test_shards_are_near_equal_keep_copies_together_and_are_numbered(spark):
    rows = [(i, prose(i, 20 + i % 90), f"s{i % 5}", "en") for i in range(1200)] + [(5000 + i, "the same text", "s0", "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(5)
    got = sharded(docs, shards=12)
    texts = dict((r[0], r[1]) for r in rows)
    size, slots, home = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        text = texts[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 16 and r["text_crc32"] == zlib.crc32(text.encode())
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        home[text].add(r["shard"])
    assert len(got) == len(rows) and sorted(size) == list(range(12))
    assert max(size.values()) < 1.1 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())


def test_a_group_larger_than_a_shard_is_alone_and_the_rest_is_even(spark):
    rows = [(i, "copy " * 20) for i in range(300)] + [(1000 + i, prose(i, 17)) for i in range(600)]
    got = sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=8)
    of_copies = {r["shard"] for r in got if r["doc_id"] < 1000}
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    others = [size[s] for s in range(8) if s not in of_copies]
    assert len(of_copies) == 1 and max(others) < 1.1 * min(others)


def test_splits_follow_the_widest_dimension(spark):
    """Two languages of equal weight and otherwise alike texts: one shard each."""
    rows = [(7, f"{k:04d} text", "s", "en" if k < 50 else "de") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = docs.select("text", "lang", F.crc32(F.col("text").cast("binary")).alias("text_crc32")).join(
        sharding.kd_shards(docs, shards=2), "text_crc32"
    )
    assert got.select("lang", "shard").distinct().count() == 2


def test_target_bytes_and_odd_rows(spark, odd_docs, no_docs):
    got = sharded(odd_docs, target_bytes=50_000)
    assert len(got) == odd_docs.count() and {r["shard"] for r in got} <= set(range(4))
    assert {r["size"] for r in got if r["doc_id"] in (9001, 9002)} == {16}
    assert len({r["shard"] for r in got if r["doc_id"] in (9009, 9010)}) == 1
    assert sharded(no_docs, shards=3) == []
    assert len(sharded(odd_docs, shards=40)) == odd_docs.count()
