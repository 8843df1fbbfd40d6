"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakeops.llm.bits import divided, hash_filter, may_hold
from lakeops.llm.components import components
from lakeops.llm.leaders import candidates, unlike
from lakeops.llm.words import blocks, mix, shingles, word_hashes
from lakeops.session import written

#: Words in a shingle, and the weighted Jaccard similarity from which two texts are near duplicates.
WIDTH = 5
THRESHOLD = 0.8
#: Samples per band and bands: a pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 3) ** 12 > 0.9998.
ROWS, BANDS = 3, 12
# IDF: shingles in less than this share of documents weigh 1. Above, the weight falls with the logarithm of the share,
# down to LEAST_WEIGHT for a shingle of all documents: a group of copies that makes up much of the corpus makes its own
# shingles frequent, and copies must stay near duplicates whatever the size of their group.
RARE_SHARE = 1 / 256
LEAST_WEIGHT = 0.9
#: Cells of the sketch of document frequencies, and parts it travels in. Fixed: the share that a cell counts by mistake
#: is the mean number of shingles of a text over the cells, at any number of documents.
CELLS = 1 << 20
PARTS = 16
#: Parts of the sketch that one task adds up.
FAN_IN = 16

#: Shingles and texts of a bucket that one task holds at most (two such blocks); texts and shingles compared at a time.
BLOCK_SHINGLES, BLOCK_TEXTS = 1 << 20, 1 << 12
CHUNK_TEXTS, CHUNK_SHINGLES = 256, 1 << 16

SET_BITS = np.uint64(16)  # shingles are 48-bit numbers, so that a text's number fits beside them


@dataclass
class Weights:
    """Frequent shingles in order and what they weigh; all others weigh 1."""

    shingle: np.ndarray
    weight: np.ndarray
    cells: np.ndarray  # per cell, whether it may hold a frequent shingle


def _cell(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(CELLS - 1)).astype(np.int64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per text: number of the text, shingle and how often it occurs, by text and shingle."""
    value, owner = shingles(*word_hashes(texts), WIDTH)
    keys, times = np.unique((owner.astype(np.uint64) << np.uint64(48)) | (value >> SET_BITS), return_counts=True)
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1), times


def weigh(shingle: np.ndarray, times: np.ndarray, weights: Weights) -> np.ndarray:
    """TF (1 + ln of the occurrences) times IDF."""
    idf = np.ones(len(shingle), np.float32)
    maybe = np.flatnonzero(weights.cells[_cell(shingle)])
    if len(maybe) and len(weights.shingle):
        at = np.minimum(np.searchsorted(weights.shingle, shingle[maybe]), len(weights.shingle) - 1)
        hit = weights.shingle[at] == shingle[maybe]
        idf[maybe[hit]] = weights.weight[at[hit]]
    return idf * (1 + np.log(times.astype(np.float32)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of documents per cell over all of a task's texts, in PARTS rows."""
    counts = np.zeros(CELLS, np.uint64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for start, stop in blocks(texts):
            _, shingle, _ = features(texts[start:stop])
            counts += np.bincount(_cell(shingle), minlength=CELLS).astype(np.uint64)
    slot = TaskContext.get().partitionId()
    rows = [{"part": k, "slot": slot, "counts": part.tobytes()} for k, part in enumerate(np.split(counts, PARTS))]
    yield pa.RecordBatch.from_pylist(rows, SKETCH)


SKETCH = pa.schema([("part", pa.int32()), ("slot", pa.int64()), ("counts", pa.binary())])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(row.as_py(), np.uint64) for row in table.column("counts"))
    row = {"part": table.column("part")[0].as_py(), "slot": table.column("slot")[0].as_py() // FAN_IN, "counts": total.tobytes()}
    return pa.Table.from_pylist([row], SKETCH)


def _document_frequency(texts: DataFrame) -> np.ndarray:
    """The sketch over all texts: at least the number of documents with a shingle of the cell."""
    schema = "part int, slot bigint, counts binary"
    parts = texts.mapInArrow(_sketch, schema)
    tasks = texts.rdd.getNumPartitions()
    while tasks > 1:
        parts = parts.groupBy("part", F.expr(f"slot div {FAN_IN}").alias("to")).applyInArrow(_summed, schema)
        tasks = -(-tasks // FAN_IN)
    counts = np.zeros((PARTS, CELLS // PARTS), np.uint64)
    for row in parts.collect():
        counts[row["part"]] += np.frombuffer(row["counts"], np.uint64)
    return counts.reshape(-1)


def _frequent(shared):
    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in blocks(texts, 8 << 20):
                found = [features(texts[start + a : start + b])[1] for a, b in blocks(texts[start:stop])]
                found = np.concatenate([part[cells[_cell(part)]] for part in found])
                shingle, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shingle.astype(np.int64)), pa.array(n)], names=["shingle", "n"])

    return frequent


def idf_weights(texts: DataFrame) -> Weights:
    """Weights of the shingles in at least RARE_SHARE of all documents, by exact counts over all of them.

    The sketch finds cells that may hold such shingles, a second pass counts the shingles of those cells. At most
    (mean shingles of a text) / RARE_SHARE can be that frequent, whatever the number of documents.
    """
    spark = texts.sparkSession
    total = texts.count()
    least = max(2, int(np.ceil(total * RARE_SHARE)))
    cells = _document_frequency(texts) >= least
    counts = (
        texts.mapInArrow(_frequent(spark.sparkContext.broadcast(cells)), "shingle bigint, n bigint")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .toPandas()
        .sort_values("shingle")
    )
    share = np.minimum(counts["n"].to_numpy(np.float64) / max(total, 1), 1)
    fallen = np.clip(1 - np.log(share) / np.log(RARE_SHARE), 0, 1)
    weight = (1 - (1 - LEAST_WEIGHT) * fallen).astype(np.float32)
    return Weights(counts["shingle"].to_numpy(np.int64).astype(np.uint64), weight, cells)


def _gamma_quantiles(size: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, whose distribution function is 1 - (1 + x) exp(-x)."""
    wanted = (np.arange(size) + 0.5) / size
    low, high = np.zeros(size), np.full(size, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return low


_GAMMA = _gamma_quantiles(1 << 16)
_RATE = _GAMMA.astype(np.float32)
_LOG_SIZE = np.log(_GAMMA).astype(np.float32)


def samples(shingle: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """ROWS * BANDS consistent weighted samples of each text whose shingles begin at ``starts``.

    Two texts share a sample with a probability of their weighted Jaccard similarity. A sample is the smallest
    ln a = ln c - r (t - b + 1) over the text, t = floor(ln w / r + b), with r, c from Gamma(2, 1) and b uniform, all by
    the shingle's hash with 16 bits each. The value stands for the shingle and t it comes from.
    """
    log_weight = np.log(weight)
    out = np.empty((len(starts), ROWS * BANDS), np.uint32)
    for k in range(ROWS * BANDS):
        u = mix(shingle + np.uint64((k + 1) << 48))
        r = _RATE[(u & np.uint64(0xFFFF)).astype(np.int64)]
        c = _LOG_SIZE[((u >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        b = ((u >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2.0**-16) + np.float32(2.0**-17)
        t = np.floor(log_weight / r + b)
        out[:, k] = np.minimum.reduceat(c - r * (t - b + 1), starts).view(np.uint32)
    return out


SIGNED = "key_a bigint, key_b bigint, bands array<bigint>"


def _sign(shared, id_name: str):
    """Per text the key of its exact content and its band hashes. Blank and null texts are left out."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in blocks(texts):
                part = texts[start:stop]
                owner, shingle, times = features(part)
                present, starts = np.unique(owner, return_index=True)
                ids, keys, bands = [*present], [], []
                if len(present):
                    mixed = [mix(shingle * np.uint64(odd) + times.astype(np.uint64)) for odd in (3, 5)]
                    keys = np.stack([np.add.reduceat(m, starts) for m in mixed], 1).view(np.int64).tolist()
                    drawn = samples(shingle, weigh(shingle, times, weights), starts).astype(np.uint64)
                    drawn = drawn.reshape(len(present), BANDS, ROWS)
                    hashed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), drawn.shape[:2])
                    for k in range(ROWS):
                        hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + drawn[:, :, k])
                    bands = list(hashed.view(np.int64))
                for place in sorted(set(range(len(part))).difference(ids)):  # no words: copies only
                    if text := (part[place] or "").strip():
                        code = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint64)
                        code = mix(code + (np.arange(1, len(code) + 1, dtype=np.uint64) << np.uint64(8)))
                        ids.append(place)
                        keys.append([int(mix(code * np.uint64(odd)).sum().view(np.int64)) for odd in (3, 5)])
                        bands.append([])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([start + int(i) for i in ids], pa.int64())),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=[id_name, "key_a", "key_b", "bands"],
                )

    return sign


def _described(shared, wanted):
    """Shingles and weights of the texts whose id may be wanted."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bits = shared.value, wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(bits, batch.column(2).to_numpy())))
            texts = batch.column(1).to_pylist()
            for start, stop in blocks(texts):
                owner, shingle, times = features(texts[start:stop])
                weight = weigh(shingle, times, weights)
                bounds = np.searchsorted(owner, np.arange(stop - start + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(shingle.astype(np.int64))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(weight)),
                    ],
                    names=["id", "shingles", "weights"],
                )

    return described


def weighted_jaccard(one: np.ndarray, one_weight: np.ndarray, two: np.ndarray, two_weight: np.ndarray) -> float:
    """Sum of smaller over sum of larger weights; the shingles of each text are distinct and in order."""
    both, at, to = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    shared = np.minimum(one_weight[at], two_weight[to]).sum(dtype=np.float64)
    whole = one_weight.sum(dtype=np.float64) + two_weight.sum(dtype=np.float64) - shared
    return float(shared / whole) if whole else 0.0


def _verified(threshold: float):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in ("a_shingles", "a_weights", "b_shingles", "b_weights")]
            kept = [
                weighted_jaccard(*(column[row].values.to_numpy() for column in columns)) >= threshold
                for row in range(len(batch))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return verified


def _chunks(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of up to CHUNK_TEXTS texts and CHUNK_SHINGLES shingles, one text at least."""
    cuts, held = [0], 0
    for place, size in enumerate(sizes):
        if place > cuts[-1] and (place - cuts[-1] == CHUNK_TEXTS or held + size > CHUNK_SHINGLES):
            cuts.append(place)
            held = 0
        held += size
    return list(zip(cuts, [*cuts[1:], len(sizes)])) if len(sizes) else []


def most_shared(one: list[np.ndarray], one_weights: list[np.ndarray], two: list[np.ndarray], two_weights: list[np.ndarray]) -> np.ndarray:
    """For each text of ``one`` and of ``two`` the sum over shared shingles of the root of both weights' product.

    At least the sum of the smaller weights, and equal to it where the weights of both agree.
    """
    known = np.intersect1d(np.unique(np.concatenate(one)), np.unique(np.concatenate(two)), assume_unique=True)
    sides = []
    for shingles_of, weights_of in ((one, one_weights), (two, two_weights)):
        dense = np.zeros((len(shingles_of), len(known)), np.float32)
        if len(known):
            value, row = np.concatenate(shingles_of), np.repeat(np.arange(len(shingles_of)), [len(s) for s in shingles_of])
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            held = known[at] == value
            dense[row[held], at[held]] = np.sqrt(np.concatenate(weights_of)[held])
        sides.append(dense)
    return sides[0] @ sides[1].T


def _compared(threshold: float, kind: pa.DataType):
    """Links between all members of different labels of a bucket, or between two blocks of one."""

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        one, two = table["one"][0].as_py(), table["two"][0].as_py()
        ids, block = table["id"], table["block"].to_numpy()
        numbers: dict[str, int] = {}
        label = np.array([numbers.setdefault(repr(name), len(numbers)) for name in table["label"].to_pylist()])
        found, weights = ([row.values.to_numpy() for row in table[name]] for name in ("shingles", "weights"))
        total = np.array([w.sum(dtype=np.float64) for w in weights])
        first, second = np.flatnonzero(block == one), np.flatnonzero(block == two)
        links = []
        cuts = [[side[a:b] for a, b in _chunks(np.array([len(found[k]) for k in side]))] for side in (first, second)]
        for i, mine in enumerate(cuts[0]):
            for theirs in cuts[1][i if one == two else 0 :]:
                parts = [[values[k] for k in side] for side in (mine, theirs) for values in (found, weights)]
                shared = most_shared(*parts).astype(np.float64)
                # The rounding of the product is far below this allowance.
                near = shared * (1 + threshold) >= threshold * (total[mine][:, None] + total[theirs]) * (1 - 1e-4)
                near &= label[mine][:, None] != label[theirs]
                for a, b in zip(mine[np.nonzero(near)[0]], theirs[np.nonzero(near)[1]]):
                    if weighted_jaccard(found[a], weights[a], found[b], weights[b]) >= threshold:
                        links.append((a, b))
        sides = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
        return pa.table({name: ids.take(side).cast(kind) for name, side in zip("ab", sides)})

    return compared


def _missing_links(rest: DataFrame, labels: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between bucket members that no leader has brought into one class; every such pair is compared.

    A member's shingles travel once per bucket, whatever its size; a bucket of more than a block is cut into blocks and
    each pair of blocks is a task's work.
    """
    open_ = written(unlike(rest, labels), "buckets-open")
    sized = open_.join(features.select("id", F.size("shingles").alias("size")), "id")
    counts = sized.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks_of = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("size") / BLOCK_SHINGLES))
    dealt = open_.join(counts.select("band", blocks_of.alias("blocks")), "band")
    dealt = dealt.withColumn("block", F.expr("pmod(xxhash64(id, 1), blocks)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = dealt.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    work = dealt.select("band", "one", "two", "block", "id", "label").join(features, "id")
    schema = ", ".join(f"{name} {features.schema['id'].dataType.simpleString()}" for name in "ab")
    kind = to_arrow_type(features.schema["id"].dataType)
    return work.groupBy("band", "one", "two").applyInArrow(_compared(threshold, kind), schema).distinct()


def _row_id() -> Column:
    """What a row is known by: its id and a hash of its text, so that unlike texts of one id are not taken for each other.
    Null where the id is. Ids order rows before hashes do."""
    whole = F.coalesce("text", F.lit(""))
    return F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(whole).alias("text_hash")))


def _classes(rows: DataFrame, threshold: float) -> DataFrame:
    """``id`` and ``class_id`` (the smallest id of its class) for every different ``id`` of ``rows`` (id, text) whose text
    has more than blanks."""
    spark = rows.sparkSession
    weights = spark.sparkContext.broadcast(idf_weights(rows.select("text")))
    kind = rows.schema["id"].dataType.simpleString()
    signed = written(rows.mapInArrow(_sign(weights, "id"), f"id {kind}, {SIGNED}"), "signatures")
    texts = written(
        signed.groupBy("key_a", "key_b").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "contents"
    )
    pairs, rest = candidates(texts)
    pairs = written(pairs, "candidates")
    # Few texts are candidates: a filter of their ids keeps the others out of the shuffle, the join is exact.
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = written(wanted.withColumn("hash", F.xxhash64("id")), "candidate-ids")
    bits = spark.sparkContext.broadcast(hash_filter(wanted, "hash"))
    described = written(
        rows.withColumn("hash", F.xxhash64("id"))
        .mapInArrow(_described(weights, bits), f"id {kind}, shingles array<bigint>, weights array<float>")
        .join(wanted, "id", "left_semi")
        .dropDuplicates(["id"]),
        "described",
    )
    sides = [described.select(*(F.col(c).alias(f"{s}_{c}" if c != "id" else s) for c in described.columns)) for s in "ab"]
    compared = pairs.join(sides[0], "a").join(sides[1], "b")
    links = written(compared.mapInArrow(_verified(threshold), f"a {kind}, b {kind}"), "verified")
    labels = components(links)
    # Every open bucket's members are candidates with its leaders, so they are described.
    missing = written(_missing_links(rest, labels, described, threshold), "missing")
    if not missing.isEmpty():
        labels = components(links.union(missing))
    contents = texts.join(labels, "id", "left").select("key_a", "key_b", F.coalesce("label", "id").alias("class_id"))
    return signed.join(contents, ["key_a", "key_b"]).groupBy("id").agg(F.min("class_id").alias("class_id"))


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``class_id`` (the smallest id of its class) for every row of ``docs``.

    Texts of equal content are one text from the start. Others become linked if they share a band and
    reach ``threshold``: first with their buckets' leaders, then with all members that are still in another class; classes
    are the connected components of the links. Null and blank texts are alone; texts without a word equal only their
    copies. A null id has a null class. Repeated rows have a row each, and rows of one id with unlike texts each the
    class of its text. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", _row_id().alias("id"), "text")
    classes = _classes(rows.filter(F.col("id").isNotNull()).select("id", "text"), threshold)
    return rows.select("doc_id", "id").join(classes, "id", "left").select(
        "doc_id", F.coalesce("class_id.doc_id", "doc_id").alias("class_id")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns and one row of each class, the one with the smallest id; rows with a null id stay.

    Only rows of equal or similar text go for each other: rows that share an id but not the text each stay or go by
    their own class. Of rows that repeat id and text, one stays.
    """
    rows = docs.select(F.struct("*").alias("row"), _row_id().alias("id"))
    ids = docs.select(_row_id().alias("id"), "text").filter(F.col("id").isNotNull())
    found = ids.groupBy("id").agg(F.count("*").alias("n")).join(_classes(ids, THRESHOLD), "id", "left")
    found = written(found.select("id", "n", F.coalesce("class_id", "id").alias("class_id")), "classes")
    gone = found.filter("class_id <> id OR n > 1").select("id")
    again = found.filter("class_id = id AND n > 1").select("id")
    staying, others = divided(rows, "id", gone)
    others = written(others, "may-go")
    once = others.join(again, "id", "left_semi").dropDuplicates(["id"])
    return staying.unionByName(others.join(gone, "id", "left_anti")).unionByName(once).select("row.*")
