"""Small tables with every odd case, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("ra", "te", "lo", "mi", "su", "vek", "dor", "ban") for b in ("n", "lis", "tor", "ma", "ged", "pur")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row int, shard int, taken int"


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, ties; columns that clash with working names."""
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", "a"), (4, "one", None), (5, "one", "b"), (5, "one", "b"),
        (6, prose(1, 80), "b"), (7, prose(1, 80), "c"), (8, edited(prose(1, 80), 3, 1), "c"), (9, prose(2, 30_000), "a"),
        (None, prose(1, 80), "a"), (None, None, None), (10, "x" * 50_000, "c"), (11, "ein Wort\nein Wort\n\n  zwei  ", "c"),
        (12, prose(5, 200), None), (13, "İß ﬁ 漢字 \U0001f600 <|endoftext|>", "b"),
    ]
    return [(i, t, "en", s, None, "clash", 7, 3, 9) for i, t, s in texts]


def frame(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def documents(spark, texts: dict[int, str], source: str = "s"):
    return frame(spark, [(i, t, "en", source, len(t), "k", 0, 0, 0) for i, t in texts.items()])
