"""Texts rearranged for filling in the middle, cut at token bounds that a Roaring-style set holds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.words import blocks

# The sentinels before prefix, suffix and middle, and the shares (percent) of rearranged texts and, of these,
# of texts whose suffix comes first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ARRANGED, SUFFIX_FIRST = 50, 80

CHUNK = 1 << 16
#: A list of more positions than this is larger than the bits of its whole chunk.
LONGEST_LIST = 4096

ARRANGEMENT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class ListChunk:
    """Up to 4096 positions of one chunk, as they are."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitChunk:
    """One bit for each place of the chunk, with the number of bits set before each word of 64."""

    def __init__(self, low: np.ndarray):
        flags = np.zeros(CHUNK, np.uint8)
        flags[low] = 1
        self.bits = np.packbits(flags, bitorder="little")
        each = flags.reshape(-1, 64).sum(1, dtype=np.int64)
        self.before = np.cumsum(each) - each

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        flags = np.unpackbits(self.bits[8 * word : 8 * word + 8], bitorder="little")
        return 64 * word + int(np.flatnonzero(flags)[rank - int(self.before[word])])


class RunChunk:
    """Runs of neighbouring positions: where each begins and how many positions lie before it."""

    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.starts = low[first].astype(np.uint16)
        self.before = first

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def chunk_of(low: np.ndarray) -> ListChunk | BitChunk | RunChunk:
    """The smallest of the three forms for the sorted places of one chunk: 2 bytes a position, 4 a run, or 8 KiB."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(low) != 1) + 1))
    if 4 * len(first) < min(2 * len(low), CHUNK // 8):
        return RunChunk(low, first)
    return ListChunk(low) if len(low) <= LONGEST_LIST else BitChunk(low)


class BoundarySet:
    """A set of positions that finds the one with a given number of smaller ones.

    Positions are grouped by their upper bits into chunks of 65,536 places. ``before`` has the number of positions in
    earlier chunks, so a rank is first searched there and then in one chunk only.
    """

    def __init__(self, positions: np.ndarray):
        """``positions``: sorted and without repeats."""
        high = positions // CHUNK
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first]
        self.before = first
        self.size = len(positions)
        self.chunks = [chunk_of(part % CHUNK) for part in np.split(positions, first[1:])] if self.size else []

    def __len__(self) -> int:
        return self.size

    def select(self, rank: int) -> int:
        """The position with ``rank`` smaller ones in the set."""
        place = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.keys[place]) * CHUNK + self.chunks[place].select(rank - int(self.before[place]))


def token_ends(text: str) -> np.ndarray:
    """Where each token ends, in code points: a token is a run without a blank and the blanks before it; blanks at the end
    of the text are a token of their own. Blanks are those of ASCII."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    return np.append(ends, len(points)) if len(points) and blank[-1] else ends


def draws(seed: int, id: str) -> list[int]:
    """Four repeatable numbers for one document."""
    digest = hashlib.sha256(f"{seed}:{id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def arranged(text: str, id: str, seed: int) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, characters of prefix and middle, and the rearranged text."""
    ends = BoundarySet(token_ends(text))
    n = len(ends)
    one, two, form, order = draws(seed, id)
    if not text or form % 100 >= ARRANGED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    start, stop = (ends.select(k - 1) if k else 0 for k in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    if order % 100 < SUFFIX_FIRST:
        return n, "spm", start, stop - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", start, stop - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _arrange(seed: int):
    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for start, stop in blocks(texts):
                rows = [arranged(texts[k] or "", ids[k], seed) for k in range(start, stop)]
                n, form, prefix, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    names=[batch.schema.names[0], "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return arrange


def fill_in_middle(docs: DataFrame, seed: int = 42, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text with its middle moved to the end, or as it is, by draws that depend on ``seed`` and the id alone.

    Returns ``id``, ``n`` (tokens), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars``, ``middle_chars`` (null if
    plain) and ``output``. Each text is handled by itself where it is read: nothing moves. Null counts as empty, and an
    empty text stays plain, as does one that holds a sentinel; a null id draws like the text ``null``. Repeated rows give
    repeated results, an empty table none. Other columns are not read, so their names cannot clash.
    """
    column = docs.schema[id]
    key = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id).alias("id"), key.alias("key"), F.col(text).alias("text"))
    made = rows.mapInArrow(_arrange(seed), f"id {column.dataType.simpleString()}, {ARRANGEMENT}")
    return made.withColumnRenamed("id", id)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Each sentinel stands in it once, since the text holds none."""
    tail = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)
    after_prefix = F.substring_index(head, PREFIX, -1)
    before, after = F.substring_index(after_prefix, SUFFIX, 1), F.substring_index(head, SUFFIX, -1)
    ahead = F.substring_index(F.substring_index(head, PREFIX, 1), SUFFIX, -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(before, tail, after))
        .otherwise(F.concat(after_prefix, tail, ahead))
    )
