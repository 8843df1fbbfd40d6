"""A filter of hashes with a fixed size, built on the executors and broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2 MiB, whatever is put in. A fuller filter lets more through, which only costs time.
FILTER_BITS = 1 << 24
#: Where in a hash the numbers of its bits begin.
PROBES = (0, 20, 40)


def hash_filter(hashes: DataFrame, name: str) -> np.ndarray:
    """The bits of all values of the bigint column ``name``. They are set per byte on the executors, so the driver gets
    FILTER_BITS / 8 bytes at most."""
    slots = [F.shiftrightunsigned(name, probe).bitwiseAND(F.lit(FILTER_BITS - 1)) for probe in PROBES]
    each = hashes.select(F.explode(F.array(*slots)).alias("slot"))
    bit = F.bit_or(F.expr("shiftleft(1, CAST(slot & 7 AS INT))")).alias("bits")
    found = each.groupBy(F.shiftright("slot", 3).alias("byte")).agg(bit).toPandas()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    bits[found["byte"].to_numpy(np.int64)] = found["bits"].to_numpy(np.uint8)
    return bits


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each 64-bit hash whether it may have been put in; never false for one that was."""
    held = np.ones(len(hashes), bool)
    for probe in PROBES:
        left = np.flatnonzero(held)  # most are ruled out by the first look
        slot = (hashes.view(np.uint64)[left] >> np.uint64(probe)) & np.uint64(FILTER_BITS - 1)
        held[left] = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return held


def divided(docs: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows whose ``key`` is certainly not among ``ids``, and rows whose key may be.

    The second part is to be joined with ``ids``; the first, most of the rows where few are meant, need not move. A row
    with a null key is in one of the parts. A column ``_key_hash`` would clash and is refused.
    """
    if "_key_hash" in docs.columns:
        raise ValueError("column in use: _key_hash")
    bits = hash_filter(ids.select(F.xxhash64(key).alias("hash")), "hash")
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    hashed = docs.withColumn("_key_hash", F.xxhash64(key))

    def part(wanted: bool) -> DataFrame:
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *columns, hashes = batch.columns
                rows = pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))
                yield rows.filter(pa.array(may_hold(shared.value, hashes.to_numpy()) == wanted))

        return hashed.mapInArrow(kept, docs.schema)

    return part(False), part(True)
