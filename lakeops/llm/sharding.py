"""K-d tree partitioning: shards of nearly equal bytes that are close in their metadata."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.places import numbered
from lakeops.session import written

#: Bytes a document takes besides its text.
ROW_BYTES = 16
#: A dimension is scaled to this many bits, and as many bits of the text's hash settle ties.
BITS = 24
#: Bits of the key that one histogram resolves.
STEP_BITS = 12
#: A median is good enough when the bin it lies in has at most this share of a shard.
TOLERANCE = 0.002
DIMENSIONS = ("d_size", "d_source", "d_lang", "d_order")
ENDS = pa.schema(
    [("node", pa.int64()), ("w", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]
)
BINS = pa.schema([("node", pa.int64()), ("bin", pa.int64()), ("w", pa.int64())])


@dataclass
class Node:
    """A part of the tree that is to become ``shards`` shards, or a split of it at ``cut`` along a dimension."""

    number: int
    shards: int
    dimension: int = 0
    cut: int = 0
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def splits(self) -> list[tuple[int, int, int, int, int]]:
        """(node, dimension, cut, left, right) of every split, from the root down."""
        if self.left is None:
            return []
        mine = (self.number, self.dimension, self.cut, self.left.number, self.right.number)
        return [mine, *self.left.splits(), *self.right.splits()]


class Batch:
    """Numpy columns of some groups and the node each belongs to."""

    def __init__(self, batch: pa.RecordBatch, splits: list[tuple[int, int, int, int, int]]):
        self.weight, self.tie = (batch.column(name).to_numpy() for name in ("weight", "tie"))
        self.places = [batch.column(name).to_numpy() for name in DIMENSIONS]
        self.node = np.zeros(len(batch), np.int64)
        for number, dimension, cut, left, right in splits:
            mine = np.flatnonzero(self.node == number)
            self.node[mine] = np.where(self.key(dimension, mine) < cut, left, right)

    def key(self, dimension: int, rows: np.ndarray) -> np.ndarray:
        return (self.places[dimension][rows] << BITS) + self.tie[rows]


def _coded(column: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(column, F.lit(""))), F.lit(1 << BITS))


def _described(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("bigint") + ROW_BYTES

    def extra(name: str) -> Column:
        return F.col(name).cast("string") if name in docs.columns else F.lit("")

    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_a"),
        F.xxhash64(F.lit("b"), text).alias("text_b"),
        _coded(extra("source")).alias("d_source"),
        _coded(extra("lang")).alias("d_lang"),
    )


def _groups(described: DataFrame) -> DataFrame:
    """One row per text with its weight and its place in each dimension, all from 0 to 2^BITS - 1."""
    ends = described.agg(
        *(f(c).alias(f"{n}_{c}") for n, f in (("lo", F.min), ("hi", F.max)) for c in ("size", "doc_id"))
    ).first()

    def scaled(value: Column, low, high) -> Column:
        span = max(float(high or 0) - float(low or 0), 1e-9)
        return F.least(((value - F.lit(float(low or 0))) / span * (1 << BITS)).cast("bigint"), F.lit((1 << BITS) - 1))

    low, high = (F.log2(F.lit(float(ends[f"{n}_size"] or 1))) for n in ("lo", "hi"))
    grown = (F.log2(F.col("one")) - low) / F.greatest(high - low, F.lit(1e-9)) * (1 << BITS)
    return described.groupBy("text_a", "text_b").agg(
        F.sum("size").alias("weight"),
        F.max("size").alias("one"),
        F.min("d_source").alias("d_source"),
        F.min("d_lang").alias("d_lang"),
        F.min("doc_id").alias("first"),
    ).select(
        "text_a",
        "text_b",
        "weight",
        F.least(grown.cast("bigint"), F.lit((1 << BITS) - 1)).alias("d_size"),
        "d_source",
        "d_lang",
        F.coalesce(scaled(F.col("first").cast("double"), ends["lo_doc_id"], ends["hi_doc_id"]), F.lit(0)).alias("d_order"),
        F.pmod(F.col("text_a"), F.lit(1 << BITS)).alias("tie"),
    )


def _ends(splits):
    """Per node of a batch the weight and the range of every dimension."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            batch = Batch(record, splits)
            rows = []
            for number in np.unique(batch.node):
                mine = batch.node == number
                low, high = ([int(f(p[mine])) for p in batch.places] for f in (np.min, np.max))
                rows.append({"node": int(number), "w": int(batch.weight[mine].sum()), "low": low, "high": high})
            yield pa.RecordBatch.from_pylist(rows, ENDS)

    return ends


def _histogram(splits, asked: dict[int, tuple[int, int]], shift: int):
    """Weight by bin in each node asked for, among the keys that begin like its key so far."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            batch = Batch(record, splits)
            rows = []
            for number, (dimension, begun) in asked.items():
                mine = np.flatnonzero(batch.node == number)
                key = batch.key(dimension, mine)
                inside = (key >> (shift + STEP_BITS)) == (begun >> (shift + STEP_BITS))
                bins, weight = (key[inside] >> shift) & ((1 << STEP_BITS) - 1), batch.weight[mine][inside]
                found, at = np.unique(bins, return_inverse=True)
                sums = np.zeros(len(found), np.int64)
                np.add.at(sums, at, weight)
                rows += [{"node": number, "bin": int(b), "w": int(w)} for b, w in zip(found, sums, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, BINS)

    return histogram


def _medians(groups: DataFrame, splits, wanted: dict[int, tuple[int, float, float]]) -> dict[int, int]:
    """For each node the key below which about the wanted weight lies; all nodes by the same passes.

    A pass counts the weight by the next bits of the key, among the rows in the bin where the cut lies. ``wanted`` has
    dimension, weight to the left and the weight of a bin that need not be resolved further.
    """
    begun, goal = dict.fromkeys(wanted, 0), {n: w[1] for n, w in wanted.items()}
    cuts: dict[int, int] = {}
    shift = 2 * BITS
    while left := [n for n in wanted if n not in cuts]:
        shift -= STEP_BITS
        asked = {n: (wanted[n][0], begun[n]) for n in left}
        counted = groups.mapInArrow(_histogram(splits, asked, shift), "node bigint, bin bigint, w bigint")
        found: dict[int, list] = {n: [] for n in left}
        for row in counted.groupBy("node", "bin").agg(F.sum("w").alias("w")).collect():
            found[row["node"]].append((row["bin"], row["w"]))
        for n in left:
            for place, weight in sorted(found[n]):
                if weight <= goal[n]:
                    goal[n] -= weight
                    continue
                start = begun[n] + (place << shift)
                if weight <= wanted[n][2] or shift == 0:
                    cuts[n] = start + ((1 << shift) if 2 * goal[n] >= weight else 0)
                else:
                    begun[n] = start
                break
            else:  # all of it lies to the left
                cuts[n] = begun[n] + (1 << (shift + STEP_BITS))
    return cuts


def _grown(groups: DataFrame, shards: int) -> Node:
    """The tree over ``groups``, split level by level until every leaf is one shard."""
    root, numbers = Node(0, shards), 1
    while broad := [leaf for leaf in root.leaves() if leaf.shards > 1]:
        splits = root.splits()
        parts = groups.mapInArrow(_ends(splits), "node bigint, w bigint, low array<bigint>, high array<bigint>")
        spread = [f(F.col(c)[k]).alias(f"{c}{k}") for c, f in (("low", F.min), ("high", F.max)) for k in range(len(DIMENSIONS))]
        seen = {r["node"]: r for r in parts.groupBy("node").agg(F.sum("w").alias("w"), *spread).collect()}
        wanted = {}
        for node in broad:
            if row := seen.get(node.number):
                node.dimension = max(range(len(DIMENSIONS)), key=lambda k, r=row: r[f"high{k}"] - r[f"low{k}"])
                share = row["w"] / node.shards
                wanted[node.number] = (node.dimension, share * (node.shards // 2), share * TOLERANCE)
        cuts = _medians(groups, splits, wanted)
        for node in broad:
            node.cut = cuts.get(node.number, 0)
            half = node.shards // 2
            node.left, node.right = Node(numbers, half), Node(numbers + 1, node.shards - half)
            numbers += 2
    return root


def _assigned(splits, shard_of: dict[int, int]):
    """The shard of every text."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            shard = [shard_of[n] for n in Batch(record, splits).node.tolist()]
            yield pa.RecordBatch.from_arrays(
                [record.column("text_a"), record.column("text_b"), pa.array(shard, pa.int32())], names=["text_a", "text_b", "shard"]
            )

    return assigned


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Documents with ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Equal texts stay together. Give ``shards``, or ``target_bytes`` for as many as the whole size needs. A group of
    copies as large as a shard becomes one by itself; all others are split at weighted medians along the widest of four
    metadata dimensions (size, source, language, order), found by histograms over all nodes of a level at once. What
    the driver sees is at most 2^STEP_BITS numbers per node. Null texts count as empty, a null id as the lowest; fewer
    texts than shards leave shards empty, an empty table gives an empty result, other columns are ignored.
    """
    described = written(_described(docs), "shard-rows")
    groups = written(_groups(described), "shard-groups")
    total = groups.agg(F.sum("weight")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // max(1, target_bytes)))
    largest = groups.select("text_a", "text_b", "weight").orderBy(F.desc("weight"), "text_a", "text_b").limit(shards - 1)
    alone, rest, left = [], total, shards
    for row in largest.collect():
        if left > 1 and row["weight"] * left >= rest:
            alone.append(row)
            rest, left = rest - row["weight"], left - 1
    own = [(F.col("text_a") == row["text_a"]) & (F.col("text_b") == row["text_b"]) for row in alone]
    others = written(groups.filter(~reduce(operator.or_, own)), "shard-others") if own else groups
    tree = _grown(others, left)
    order = {leaf.number: place for place, leaf in enumerate(tree.leaves())}
    placed = others.mapInArrow(_assigned(tree.splits(), order), "text_a bigint, text_b bigint, shard int")
    for place, mine in enumerate(own):
        placed = placed.union(groups.filter(mine).select("text_a", "text_b", F.lit(left + place)))
    sharded = described.join(placed, ["text_a", "text_b"])
    stored = written(sharded.select("doc_id", "size", "text_crc32", "shard", "text_a", "text_b"), "shard-docs")
    return numbered(stored, ["shard"], ["doc_id", "text_a", "text_b"], "slot").drop("text_a", "text_b")
