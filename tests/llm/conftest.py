"""Small tables for the operators' tests."""

from __future__ import annotations

import random

import pytest

WORDS = {
    "en": "the of and house river stone light green walking under above morning because thought garden".split(),
    "de": "der die und haus fluss stein licht grün gehen unter über morgen weil gedanke garten".split(),
    "fr": "le la et maison rivière pierre lumière vert marcher sous dessus matin parce pensée jardin".split(),
}


def prose(seed: int, words: int, lang: str = "en", rare: int = 400) -> str:
    """Repeatable prose: words of one language, most of them built from two."""
    draw = random.Random(seed)
    base = WORDS[lang]
    return " ".join(
        draw.choice(base) + (draw.choice(base) if draw.random() < 0.6 else "") + ("" if draw.random() < 0.9 else ".")
        for _ in range(words)
    )


ODD = [
    (9001, None),
    (9002, ""),
    (9003, "   \n\t "),
    (9004, "!!! ... ###"),
    (9005, "x"),
    (9006, "日本語のテキスト。 これはテスト"),
    (9007, "é́ ÀÉ   a\u0085b <|endoftext|> \x1c z"),
    (9008, "word " * 30_000),
    (9009, "tie tie tie tie tie tie tie"),
    (9010, "tie tie tie tie tie tie tie"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, wordless, very long and equal texts, a null id, and a row that is there twice."""
    rows = [*ODD, (None, "a text without an id"), (9011, "twice"), (9011, "twice")]
    return spark.createDataFrame(
        [(i, t, "en" if t else None, None, len(t or ""), "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, extra string",
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
