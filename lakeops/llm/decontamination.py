"""Benchmark decontamination by spaced seeds over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.bits import divided, hash_filter, may_hold
from lakeops.llm.words import blocks, mix, word_hashes
from lakeops.session import written

#: From this length on an item has the rule of LEAST_EQUAL words; a shorter one must be equal in four fifths of its own.
LONG = 12
# Word positions that count (1) or are ignored (0). A window of words hits if the counted ones are equal. The masks of a
# length hit every pattern of equal and differing words that its rule accepts: a stretch of 24 words or more has a part
# of 12 or more that is accepted, and the shorter patterns were all tried (the tests try them again).
LONG_MASKS = ("1110111", "11010010011", "11010001101")
MIDDLE_MASKS = ("1111000011", "1100101011", "1110111", "1011111", "1111101", "111001011")
#: Items of this many words and up to LONG have MIDDLE_MASKS; shorter ones forgive one word, each in turn.
MIDDLE = 8
#: An item of fewer words is too short to be told from chance inside another text: it matches a text of the same words.
LEAST_WORDS = 5
#: The aligned stretch must have this many equal words (or four fifths of a shorter item) ...
LEAST_EQUAL = 10
#: ... and this share of equal words, which is one differing word for every EQUAL_PER_OTHER equal ones.
LEAST_SHARE = 0.8
EQUAL_PER_OTHER = 4

HITS = "array<struct<seed:bigint,at:bigint>>"


def masks_of_length(words: int) -> tuple[str, ...]:
    """The masks for an item of that many words; none for one that is too short."""
    if words < LEAST_WORDS:
        return ()
    if words < MIDDLE:
        whole = "1" * (words - 1)
        return (whole, *(whole[:k] + "0" + whole[k:] for k in range(1, words - 1)))
    return MIDDLE_MASKS if words < LONG else LONG_MASKS


#: All masks; a mask's number is its place here, the same for items of every length.
MASKS = tuple(sorted({mask for words in range(LEAST_WORDS, LONG + 1) for mask in masks_of_length(words)}))


def masks_for(words: int) -> list[tuple[int, str]]:
    """The numbered masks for an item of that many words."""
    return [(MASKS.index(mask), mask) for mask in masks_of_length(min(words, LONG))]


def windows(hashes: np.ndarray, bounds: np.ndarray, number: int, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows under one mask, and their seeds: hashes of the words that count."""
    counts = np.maximum(np.diff(bounds) - len(mask) + 1, 0)
    first = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(bounds[:-1], counts)
    value = np.full(len(first), number + 1, np.uint64)
    for place, counted in enumerate(mask):
        if counted == "1":
            value = value * np.uint64(0x9E3779B97F4A7C15) + hashes[first + place]
    return first, mix(value)


def whole_seeds(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the texts of under LEAST_WORDS words, but at least one, and a seed of all their words."""
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < LEAST_WORDS))
    value = counts[short].astype(np.uint64) + np.uint64(len(MASKS) + 1)
    for place in range(LEAST_WORDS - 1):
        held = counts[short] > place
        value[held] = value[held] * np.uint64(0x9E3779B97F4A7C15) + hashes[bounds[:-1][short[held]] + place]
    return bounds[:-1][short], mix(value)


def _hits(numbers: list[int], filter_bits, key: str):
    """Per text its words and the windows to be joined: all of an item's, those that pass the filter of a document's."""
    of_length = np.zeros((len(MASKS), LONG + 1), bool)
    for words in range(LONG + 1):
        of_length[[number for number, _ in masks_for(words)], words] = True

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if filter_bits is None else filter_bits.value
        kind = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int64())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in blocks(texts):
                hashes, bounds = word_hashes(texts[begin:end])
                counts = np.diff(bounds)
                owner, seeds, ats = [], [], []
                for number in numbers:
                    first, seed = windows(hashes, bounds, number, MASKS[number])
                    who = np.searchsorted(bounds, first, "right") - 1
                    if bits is None:  # an item: only the masks for its own length
                        whole = of_length[number, np.minimum(counts[who], LONG)]
                    else:
                        whole = may_hold(bits, seed)
                    kept = np.flatnonzero(whole)
                    owner.append(who[kept])
                    seeds.append(seed[kept].view(np.int64))
                    ats.append(first[kept] - bounds[who[kept]])
                first, seed = whole_seeds(hashes, bounds)
                kept = np.arange(len(first)) if bits is None else np.flatnonzero(may_hold(bits, seed))
                owner.append(np.searchsorted(bounds, first[kept], "right") - 1)
                seeds.append(seed[kept].view(np.int64))
                ats.append(np.zeros(len(kept), np.int64))
                who, seed, at = (np.concatenate(x) for x in (owner, seeds, ats))
                order = np.argsort(who, kind="stable")
                who, seed, at = who[order], seed[order], at[order]
                present = np.unique(who)
                cuts = np.searchsorted(who, present)
                offsets = pa.array(np.append(cuts, len(who)).astype(np.int32))
                pairs = pa.StructArray.from_arrays([pa.array(seed), pa.array(at)], names=["seed", "at"])
                words = [hashes[bounds[t] : bounds[t + 1]].view(np.int64) for t in present]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(present + begin)),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(offsets, pairs).cast(kind),
                    ],
                    names=[key, "words", "hits"],
                )

    return hits


def overlap(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, stop, equal words) of the stretch with the most equal words among all that have LEAST_SHARE of them.

    Of several the shortest, and then the first. A stretch has the share if its sum of 1 per equal word less
    EQUAL_PER_OTHER per other is not negative; for each stop the earliest start with such a sum is the best one.
    """
    points = np.concatenate(([0], np.cumsum(np.where(equal, 1, -EQUAL_PER_OTHER))))
    low = np.minimum.accumulate(points)
    begin = np.searchsorted(-low, -points, "left")
    before = np.concatenate(([0], np.cumsum(equal)))
    counts = before - before[begin]
    most = int(counts.max())
    if not most:
        return 0, 0, 0
    places = np.flatnonzero(equal)  # differing words at the ends go
    stops = np.flatnonzero(counts == most)
    starts, ends = places[before[begin[stops]]], places[before[stops] - 1] + 1
    best = int(np.argmin(ends - starts))
    return int(starts[best]), int(ends[best]), most


def accepted(start: int, stop: int, equal: int, item_words: int) -> bool:
    needed = LEAST_EQUAL if item_words >= LONG else int(np.ceil(LEAST_SHARE * item_words))
    return equal >= needed and equal >= LEAST_SHARE * (stop - start)


VERIFIED = "doc_start bigint, item_start bigint, n_words bigint, n_equal bigint, item_words bigint"


def _verify(key: str, item: str):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifts = batch.column("shift").to_pylist()
            documents, items = batch.column("words"), batch.column("item_words")
            kept, rows = [], []
            for row, shift in enumerate(shifts):
                theirs = items[row].values.to_numpy()
                mine = documents[row].values.to_numpy()
                first, last = max(0, -shift), min(len(theirs), len(mine) - shift)
                start, stop, equal = overlap(theirs[first:last] == mine[first + shift : last + shift])
                # A short item is met by texts of the same words only.
                if equal == len(mine) == len(theirs) if len(theirs) < LEAST_WORDS else accepted(start, stop, equal, len(theirs)):
                    kept.append(row)
                    rows.append((first + start + shift, first + start, stop - start, equal, len(theirs)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)]
            index = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(index), batch.column(item).take(index), *columns],
                names=[key, item, "doc_start", "item_start", "n_words", "n_equal", "item_words"],
            )

    return verify


def _content(text: str) -> Column:
    """128 bits that stand for a text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("b"), whole).alias("b"))


CONTENT = "struct<a:bigint,b:bigint>"


def _content_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The best verified overlap of every content of ``docs`` (doc, text) with every one of ``benchmark`` (item, text)."""
    spark = docs.sparkSession
    items = written(
        benchmark.dropDuplicates(["item"]).mapInArrow(
            _hits(list(range(len(MASKS))), None, "item"), f"item {CONTENT}, words array<bigint>, hits {HITS}"
        ),
        "benchmark-seeds",
    )
    seeds = items.select("item", F.inline("hits"))
    lengths = items.agg(F.collect_set(F.least(F.size("words"), F.lit(LONG)))).first()[0]
    used = sorted({number for words in lengths for number, _ in masks_for(words)})
    shared = spark.sparkContext.broadcast(hash_filter(seeds, "seed"))
    # Texts without a hit are gone here; of those with one, copies are looked at once.
    found = docs.mapInArrow(_hits(used, shared, "doc"), f"doc {CONTENT}, words array<bigint>, hits {HITS}")
    found = written(found.dropDuplicates(["doc"]), "document-seeds")
    lying = (
        found.select("doc", F.inline("hits"))
        .join(seeds.withColumnRenamed("at", "item_at"), "seed")
        .select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    pairs = (
        lying.join(items.select("item", F.col("words").alias("item_words")), "item")
        .join(found.select("doc", "words"), "doc")
        .mapInArrow(_verify("doc", "item"), f"doc {CONTENT}, item {CONTENT}, {VERIFIED}")
    )
    best = F.struct("n_equal", *(-F.col(c) for c in ("doc_start", "item_start", "n_words")), "item_words")
    top = pairs.groupBy("doc", "item").agg(F.max(best).alias("best"))
    return top.select(
        "doc",
        "item",
        (-F.col("best.col2")).alias("doc_start"),
        (-F.col("best.col3")).alias("item_start"),
        (-F.col("best.col4")).alias("n_words"),
        F.col("best.n_equal").alias("n_equal"),
        F.col("best.item_words").alias("item_words"),
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """The best verified overlap of every document with every benchmark item it shares one with.

    Rows: ``key``, ``item``, where the overlap begins in both (word numbers), its words, how many are equal, and the
    item's words. Windows of both sides are hashed under the masks and joined; a fixed-size filter of the benchmark's
    hashes keeps other windows out of the shuffle. A hit fixes how the two texts lie; along it words are compared, and
    some stretch with LEAST_SHARE of equal words must have LEAST_EQUAL of them. Every text is read whole. Null and empty
    texts overlap nothing; an item under LEAST_WORDS words overlaps texts of the same words only. Texts are compared by
    content: rows that share an id and not the text are each looked at, and of a pair of ids the best overlap is
    returned. An empty table on either side gives an empty result. Rows with a null id are left out.
    """
    doc_rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc_key"), _content("text").alias("doc"), "text")
    item_rows = benchmark.filter(F.col(item).isNotNull()).select(
        F.col(item).alias("item_key"), _content("text").alias("item"), "text"
    )
    found = written(_content_overlaps(doc_rows.drop("doc_key"), item_rows.drop("item_key")), "overlaps")
    named = found.join(doc_rows.select("doc_key", "doc"), "doc").join(item_rows.select("item_key", "item"), "item")
    rest = ["n_equal", "doc_start", "item_start", "n_words", "item_words"]
    order = F.struct("n_equal", *(-F.col(c) for c in rest[1:4]))
    best = F.max_by(F.struct(*rest), order).alias("best")
    return named.groupBy("doc_key", "item_key").agg(best).select(
        F.col("doc_key").alias(key),
        F.col("item_key").alias(item),
        *[f"best.{name}" for name in ("doc_start", "item_start", "n_words", "n_equal", "item_words")],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with all columns, without the rows whose text overlaps a text of the benchmark, whatever the ids of both.
    Null and empty texts stay."""
    rows = docs.select(F.struct("*").alias("row"), _content("text").alias("doc"))
    theirs = benchmark.select(_content("text").alias("item"), "text")
    found = _content_overlaps(docs.select(_content("text").alias("doc"), "text"), theirs)
    gone = written(found.select("doc").distinct(), "contaminated")
    staying, others = divided(rows, "doc", gone)
    return staying.unionByName(others.join(gone, "doc", "left_anti")).select("row.*")
