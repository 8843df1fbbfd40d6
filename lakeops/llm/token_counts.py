"""Token counts kept in a cache by content and tokenizer version."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.ledger import content_digest, extend
from lakeops.llm.packing import byte_letters

CACHE = "digest binary, version string, n_tokens bigint"
#: Counts of at most this many chunks of text stay in a task's memory.
MEMO_ENTRIES = 1 << 18
#: Texts cut up, and chunks encoded, together.
TEXTS_AT_ONCE = 256
ENCODED_AT_ONCE = 2048
# The byte that marks a word's end. It is no letter, so no plain word has it.
WORD_END = "\0"
# Finds characters beyond Latin letters, which are left to the library.
BEYOND = re.compile("[^\x00-\u024f]")


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends: the tokenizer drops white space, so counts stay the same."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\n]+", " "))


def word_ranks(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The merge ranks of a vocabulary with word ends, for words in lower case, each followed by WORD_END.

    Its ids are ranks: the bytes, the bytes at a word's end, then the merges in order. With the word's end written as a
    byte of its own, the second ones are merged before all others, and merging goes on as it does on marked letters.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {token["content"] for token in described["added_tokens"]}
    suffix, letters = described["model"]["end_of_word_suffix"], byte_letters()
    ranks = {}
    for token, rank in described["model"]["vocab"].items():
        if token not in special:
            word = token.removesuffix(suffix)
            ranks[bytes(letters[c] for c in word) + WORD_END.encode() * (word != token)] = rank
    last = np.zeros(max(ranks.values()) + 1, bool)
    last[[rank for token, rank in ranks.items() if len(token) > 1 and token.endswith(WORD_END.encode())]] = True
    pattern = f"[^{WORD_END}]+{WORD_END}"
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), last


class ChunkCounter:
    """Counts tokens of whole texts blank by blank.

    The tokenizer drops white space, folds case and lets no token span letters and punctuation, so a text has as many
    tokens as its chunks between blanks have together, and a word followed by one comma or full stop has one more than
    the word. Words come back all the time: each is encoded once while it is kept. Plain words of Latin letters are
    encoded from the vocabulary's merge ranks, which gives the same tokens several times faster, all others by its library.
    """

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.entries = entries
        self.known: dict[str, int] = {"": 0}
        self.ranks, self.last = word_ranks(path)

    def _plain(self, words: list[str]) -> list[int]:
        """Tokens of each word: one ends a word if its bytes end with the mark."""
        ids = self.ranks.encode_to_numpy(WORD_END.join(words) + WORD_END, disallowed_special=())
        ends = np.flatnonzero(self.last[ids])
        return np.diff(ends, prepend=-1).tolist()

    def _split(self, chunk: str) -> tuple[str, int]:
        """The part of a chunk to be counted, and the tokens of the rest."""
        rest = 0
        if chunk[-1] in ",." and chunk[-2:-1].lower().isalpha() and not BEYOND.search(chunk[-2]):
            chunk, rest = chunk[:-1], 1
        return (chunk if BEYOND.search(chunk) or "<|" in chunk else chunk.lower()), rest

    def learn(self, chunks: set[str]) -> None:
        known = self.known
        words = {chunk: self._split(chunk) for chunk in chunks}
        fresh = {word for word, _ in words.values() if word not in known}
        plain = [word for word in fresh if word.isalpha() and not BEYOND.search(word)]
        if plain:
            known.update(zip(plain, self._plain(plain), strict=True))
        others = list(fresh.difference(plain))
        for start in range(0, len(others), ENCODED_AT_ONCE):
            asked = others[start : start + ENCODED_AT_ONCE]
            for word, encoded in zip(asked, self.tokenizer.encode_batch_fast(asked, add_special_tokens=False), strict=True):
                known[word] = len(encoded.ids)
        for chunk, (word, rest) in words.items():
            known[chunk] = known[word] + rest

    def count(self, texts: list[str]) -> list[int]:
        known = self.known
        cut = [text.split(" ") for text in texts]
        fresh = {chunk for chunks in cut for chunk in chunks if chunk not in known}
        if len(known) + len(fresh) > self.entries:
            known.clear()
            known[""] = 0
            fresh = {chunk for chunks in cut for chunk in chunks if chunk}
        self.learn(fresh)
        return [sum(map(known.__getitem__, chunks)) for chunks in cut]


def _encode(path: str, version: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ChunkCounter(path)
        for batch in batches:
            texts = batch.column(1)
            counts = []
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                counts += counter.count([text or "" for text in texts[start : start + TEXTS_AT_ONCE].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([version] * len(batch)), pa.array(counts, pa.int64())],
                names=["digest", "version", "n_tokens"],
            )

    return encode


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``tokenizer`` is the file of a tokenizer that drops white space, at the same path on all executors. The digest of
    the normalised text and the digest of that file name a count in the cache table at ``cache``: stored counts are
    joined, distinct misses are encoded once and appended. Null counts as empty (0 tokens), special strings are
    handled as the library does by default, repeated rows keep their number, an empty table gives an empty result.
    Columns named ``digest``, ``n_bytes`` or ``n_tokens`` would clash and are refused.
    """
    taken = {"digest", "n_bytes", "n_tokens"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    version = tokenizer_version(tokenizer)
    clean = docs.withColumn("_norm", normalised(F.col(text)))
    contents = clean.select(content_digest(F.col("_norm")).alias("digest"), F.col("_norm").alias("text"))
    counts = extend(contents, cache, CACHE, version, lambda rows: rows.mapInArrow(_encode(tokenizer, version), CACHE))
    rows = clean.select(
        *[c for c in docs.columns if c != text],
        content_digest(F.col("_norm")).alias("digest"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    return rows.join(counts.select("digest", "n_tokens"), "digest").drop("digest")
