"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Texts are handled in blocks of about this many characters, so that the arrays of a block stay small.
BLOCK_CHARS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[b for b in range(128) if chr(b).isalnum() or b == ord("_")]] = True
_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over the whole value."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for place, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[place] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def blocks(texts: list[str | None], chars: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into ranges of about ``chars`` characters, 32 more each; a longer text is a range of its own."""
    start, size = 0, 0
    for place, text in enumerate(texts):
        length = len(text or "") + 32
        if place > start and size + length > chars:
            yield start, place
            start, size = place, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def _full_width_marks(data: np.ndarray) -> np.ndarray:
    """Bytes of the full-width punctuation U+FF01 to U+FF0F, U+FF1A to U+FF20, U+FF5B to U+FF65."""
    at = np.flatnonzero(data[:-2] == 0xEF)
    second, third = data[at + 1], data[at + 2]
    low = (second == 0xBC) & (((third >= 0x81) & (third <= 0x8F)) | ((third >= 0x9A) & (third <= 0xA0)))
    high = (second == 0xBD) & (third >= 0x9B) & (third <= 0xA5)
    marks = at[low | high]
    return np.concatenate((marks, marks + 1, marks + 2))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the characters of scripts written without blanks between words, and the bytes after them: Thai and
    Lao (U+0E00 to U+0EFF), Burmese (U+1000 to U+109F), Khmer (U+1780 to U+17FF), kana (U+3040 to U+30FF) and Chinese
    characters (U+3400 to U+9FFF, U+20000 to U+3FFFF)."""
    first, second = data[:-1], data[1:]
    three = (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    three |= (first == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    three |= (first == 0xE3) & (((second >= 0x81) & (second <= 0x83)) | (second >= 0x90))
    three |= (first >= 0xE4) & (first <= 0xE9)
    lead = np.flatnonzero(three)
    four = np.flatnonzero((first == 0xF0) & (second >= 0xA0))
    return np.concatenate((lead, four)), np.concatenate((lead + 3, four + 4))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one entry more than texts).

    A word is a run of letters, digits and underscores in lower case. Outside ASCII every
    character counts as a letter but for the Latin-1, general, CJK and full-width punctuation blocks.
    Where words are written without blanks between them (Chinese, Japanese, Thai, Lao, Khmer, Burmese) each
    character is a word. Null has no words.
    """
    coded = [(text or "").lower().encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b"\n" + b"\n".join(coded) + b"\n", np.uint8)
    inside, alone = _WORD[data], None
    if any(not (text or "").isascii() for text in texts):
        first, second = data[:-1], data[1:]
        two = np.flatnonzero(first == 0xC2)
        three = np.flatnonzero(((first == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((first == 0xE3) & (second == 0x80)))
        for marks, width in ((two, 2), (three, 3)):
            for k in range(width):
                inside[marks + k] = False
        inside[_full_width_marks(data)] = False
        alone = _unspaced(data)
    begins = np.append(False, ~inside[:-1]) & inside
    if alone is not None and len(alone[0]):
        lead, after = alone
        begins[lead] = inside[lead]
        begins[after] |= inside[after]
    stops = np.append(False, inside[:-1]) & (~inside | begins)
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    lengths = np.fromiter((len(c) + 1 for c in coded), np.int64, len(coded))
    text_ends = np.concatenate(([0], np.cumsum(lengths))) + 1
    return hashes, np.searchsorted(starts, text_ends)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words and the number of its text.

    A text of fewer words, but at least one, has one shingle of all its words.
    """
    counts = np.diff(bounds)
    full = np.maximum(counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), full)
    first = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full) + np.repeat(bounds[:-1], full)
    value = np.zeros(len(first), np.uint64)
    for k in range(width):
        value = value * _ODD + hashes[first + k]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        parts = []
        for text in short:
            part = np.uint64(counts[text])
            for word in hashes[bounds[text] : bounds[text + 1]]:
                part = np.uint64((int(part) * int(_ODD) + int(word)) & 0xFFFFFFFFFFFFFFFF)
            parts.append(part)
        owner = np.concatenate((owner, short))
        value = np.concatenate((value, np.array(parts, np.uint64)))
    return mix(value), owner
