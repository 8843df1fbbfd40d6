"""Language identification by bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.words import blocks, mix
from lakeops.session import written

#: Bytes in an n-gram of lower-case text.
WIDTH = 4
#: An n-gram belongs to a language if it makes up at least this share of its n-grams: at most 1 / SHARE per language.
SHARE = 2e-5
#: ... and at least this part of its share in the language where it is most frequent.
RELATIVE = 0.2
#: Slots of the filter per n-gram, and probes per look-up.
SLOTS_PER_GRAM = 16
PROBES = 2
#: Languages in one mask; a slot has as many masks as the languages need.
MASK_BITS = 64
UNDETERMINED = "und"

# ASCII but for letters becomes blank, so that only letters tell languages apart.
_CLEAN = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))
GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams as integers, and where each text's begin; 0 stands for an n-gram without a letter."""
    coded = [b"  " + (t or "").lower().encode("utf-8", "replace").translate(_CLEAN) + b"  " for t in texts]
    data = np.frombuffer(b"".join(coded) + b"   ", np.uint8).astype(np.uint32)
    count = len(data) - WIDTH + 1
    value = np.zeros(count, np.uint32)
    letters = np.zeros(count, bool)
    for k in range(WIDTH):
        part = data[k : k + count]
        value = (value << np.uint32(8)) | part
        letters |= part != 32
    starts = np.concatenate(([0], np.cumsum([len(c) for c in coded])))
    for k in range(1, WIDTH):  # n-grams that run into the next text
        letters[starts[1:] - k] = False
    value[~letters] = 0
    return value, starts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of n-grams by language, a batch at a time."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs.tolist())):
            mine = [texts[i] for i in np.flatnonzero(langs == lang)]
            for start, stop in blocks(mine, 8 << 20):
                value, _ = grams(mine[start:stop])
                found, many = np.unique(value[value != 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(many)],
                    schema=GRAMS,
                )


@dataclass
class Model:
    """Languages and a Bloom filter whose slots are bitmasks over them: bit l of all slots is the filter of language l.

    ``slots`` has a row for each MASK_BITS languages."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    def masks(self, value: np.ndarray) -> np.ndarray:
        """Per n-gram the set of languages that may contain it, by one look-up per probe for MASK_BITS languages."""
        hashed = mix(value.astype(np.uint64))
        found = None
        for probe in range(PROBES):
            slot = (hashed >> np.uint64(32 * probe)).astype(np.uint32) & np.uint32(self.slots.shape[1] - 1)
            found = self.slots[:, slot] if found is None else found & self.slots[:, slot]
        return found

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Per text and language the share of n-grams in its filter, less those expected by false positives."""
        value, starts = grams(texts)
        known = value != 0
        masks = self.masks(value)
        masks[:, ~known] = 0
        total = np.maximum(np.add.reduceat(known, starts[:-1], dtype=np.int64), 1)
        shares = np.empty((len(texts), len(self.languages)))
        for bit, rate in enumerate(self.false_rate):
            hits = np.add.reduceat((masks[bit // MASK_BITS] >> np.uint64(bit % MASK_BITS)) & np.uint64(1), starts[:-1]).astype(np.float64)
            shares[:, bit] = np.clip((hits / total - rate) / (1 - rate), 0, 1)
        return shares


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray) -> Model:
    """The filter that holds ``gram[i]`` for language number ``lang[i]``."""
    size = 1 << max(10, int(np.ceil(np.log2(max(1, len(gram)) * SLOTS_PER_GRAM))))
    slots = np.zeros((max(1, -(-len(languages) // MASK_BITS)), size), np.uint64)
    hashed = mix(gram.astype(np.uint64))
    for probe in range(PROBES):
        slot = (hashed >> np.uint64(32 * probe)).astype(np.uint32) & np.uint32(size - 1)
        np.bitwise_or.at(slots, (lang // MASK_BITS, slot), np.uint64(1) << (lang % MASK_BITS).astype(np.uint64))
    filled = np.array([np.mean((slots[bit // MASK_BITS] >> np.uint64(bit % MASK_BITS)) & np.uint64(1)) for bit in range(len(languages))])
    return Model(languages, slots, np.minimum(filled**PROBES, 0.99))


def learn(labelled: DataFrame) -> Model:
    """The model of ``labelled`` (text, lang), from counts over all its rows.

    Rows without a text or language teach nothing. The n-grams kept are at most 1 / SHARE per language, so what the
    driver gets and every task holds grows with the number of languages and not with the corpus.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col("lang").cast("string"), "text")
    counts = rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "gram-counts")
    # A row per language: the planner knows its size and broadcasts it, so the n-grams of a language stay where they are.
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("total")), "gram-totals")
    frequent = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * SHARE)
    kept = frequent.select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).toPandas()
    languages = sorted(kept["lang"].unique())
    best = kept.groupby("gram")["share"].transform("max")
    kept = kept[kept["share"] >= best * RELATIVE]
    number = {lang: k for k, lang in enumerate(languages)}
    return build(languages, kept["lang"].map(number).to_numpy(np.int64), kept["gram"].to_numpy(np.int64))


def _decide(shared, id_name: str):
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = [], []
            for start, stop in blocks(texts):
                part = texts[start:stop]
                shares = model.shares(part) if model.languages else np.zeros((len(part), 1))
                for text, row in zip(part, shares, strict=True):
                    lettered = bool(model.languages) and any(map(str.isalpha, text or ""))
                    best = int(row.argmax())
                    langs.append(model.languages[best] if lettered else UNDETERMINED)
                    scores.append(float(row[best]) if lettered else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[id_name, "lang_pred", "score"],
            )

    return decide


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (the corrected share of n-grams the language knows) per document.

    ``und`` with score 0 for null texts, texts without a letter and a model without languages. A tie goes to the
    language first in the alphabet. The model has a bounded size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(_decide(shared, key), f"`{key}` {kind}, lang_pred string, score double")


def _keep(shared, least: float, place: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(place).to_pylist()
            kept = []
            for start, stop in blocks(texts):
                part = texts[start:stop]
                best = model.shares(part).max(axis=1) if model.languages else np.zeros(len(part))
                kept += [bool(s >= least and any(map(str.isalpha, t or ""))) for s, t in zip(best, part, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return keep


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` in a language the model knows, with all columns: what ``predict`` calls ``und`` goes, and what
    scores less than ``least``. Each row is judged by its own text alone, so ids may repeat or be null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep(shared, least, docs.columns.index("text")), docs.schema)
