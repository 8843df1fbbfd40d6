"""Token sequences of one length, packed by minimum bin slack."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.places import numbered
from lakeops.session import written

# Fixed value: the pattern by which byte-level tokenizers of this kind split text before they merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Finds characters beyond Latin letters, which take the slower way.
ORDINARY = re.compile("[^\x00-\u024f]")
PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The vocabulary file is that of a byte-level tokenizer whose ids are its merge ranks. Ordinary texts are encoded from
    those ranks, which is several times faster and gives the same ids; texts with characters beyond ``ORDINARY``, where
    two libraries' character classes might differ, go through the vocabulary's own library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {token["content"]: token["id"] for token in described["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in described["model"]["vocab"].items()
            if token not in special
        }
        self.ranks = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        if ORDINARY.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ranks.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes()


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _cut(tokenizer: str, capacity: int, end_id: int, keep_ids: bool):
    """Pieces of every text: all but the first hold ``capacity`` tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                tokens = encoder.ids(value.as_py() or "") + end
                total = len(tokens) // 4
                place, stop, number = 0, total % capacity or capacity, 0
                while place < total:
                    part = tokens[4 * place : 4 * stop]
                    owner.append(row)
                    piece.append(number)
                    start.append(place)
                    length.append(stop - place)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    place, stop, number = stop, stop + capacity, number + 1
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


@dataclass(frozen=True)
class Pattern:
    """``times`` equal sequences from number ``first`` on; ``parts`` has (length, how many in each)."""

    first: int
    times: int
    parts: tuple[tuple[int, int], ...]


def _fullest(counts: dict[int, int], room: int) -> Counter:
    """The lengths that fill ``room`` best, no length more often than ``counts`` has it."""
    reached, steps, inside, goal = 1, [], (1 << (room + 1)) - 1, 1 << room
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left and not reached & goal:
            take = min(copies, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & inside
            left -= take
            copies *= 2
        if reached & goal:
            break
    fill, chosen = reached.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            chosen[length] += take
            fill -= length * take
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Sequences for ``counts[length]`` pieces of each length, as patterns and how often each is used.

    Each sequence takes the largest piece left and the fullest combination of the others, found by subset sums over a
    bitset; it is removed as often as the pieces allow, which ends at least one length or brings it below the number the
    pattern needs. So the work depends on ``capacity`` and not on the number of pieces.
    """
    left, patterns, first = {n: c for n, c in counts.items() if c}, [], 0
    while left:
        largest = max(left)
        left[largest] -= 1
        parts = _fullest({n: c for n, c in left.items() if c}, capacity - largest)
        left[largest] += 1
        parts[largest] += 1
        times = min(left[n] // m for n, m in parts.items())
        patterns.append(Pattern(first, times, tuple(sorted(parts.items(), reverse=True))))
        first += times
        for n, m in parts.items():
            left[n] -= times * m
            if not left[n]:
                del left[n]
    return patterns


def _intervals(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, from rank, pieces in a sequence, first sequence, offset), by length and rank."""
    used, rows = Counter(), []
    for pattern in patterns:
        offset = 0
        for length, many in pattern.parts:
            rows.append((length, used[length], many, pattern.first, offset))
            used[length] += many * pattern.times
            offset += many * length
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(intervals: np.ndarray):
    keys = (intervals[:, 0] << 48) + intervals[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "_rank"))
            found = intervals[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            at = rank - found[:, 1]
            sequence, offset = found[:, 3] + at // found[:, 2], found[:, 4] + at % found[:, 2] * length
            kept = [name for name in batch.schema.names if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return place


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """All pieces of all documents with their sequence and their offset in it; ``ids`` too if ``keep_ids``.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut from its end into full pieces, so only the
    first piece can be shorter. What packing needs of the corpus is how many pieces each length has: ``capacity``
    numbers. The plan made of them gives every (length, rank) its place, and ranks come from a distributed numbering.
    Null and empty texts have one piece, the end id. Repeated rows are packed each. An empty table gives an empty result.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECE}" + ", ids array<int>" * keep_ids
    cut = docs.select("doc_id", text).mapInArrow(_cut(tokenizer, capacity, end_id, keep_ids), schema)
    pieces = written(cut, "pieces")
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = _intervals(minimum_slack(counts, capacity))
    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], "_rank")
    return ranked.select(*pieces.columns, "_rank").mapInArrow(_place(plan), f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids of each sequence in order; a sequence has at most as many pieces as tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
