"""Spelling variants against comparisons of all words, and the index against plain search."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from corpus import documents, frame, odd_rows
from knownby.llm import fm_index, spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def family(seed, size=40):
    rng = random.Random(seed)
    stem = "".join(rng.choice("abcé") for _ in range(rng.randrange(7, 12)))
    words = [stem]
    for _ in range(size):
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        what = rng.randrange(3)
        w[at : at + (what != 1)] = [] if what == 0 else rng.choice("abcé")
        words.append("".join(w))
    return words


@pytest.mark.parametrize("bucket", [1 << 16, 300])
def test_against_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(spelling_variants, "BUCKET", bucket)
    rng = random.Random(7)
    texts = {}
    for i in range(12):
        words = family(i % 6)
        texts[i] = " ".join(rng.choice(words[: 1 + rng.randrange(len(words))]).title() for _ in range(600))
    texts[50] = ("correctly " * 400 + "corectly " * 30 + "corectlly " * 3) + "Straßenbahn Straßenbahn Strassenbahn" * 3
    assert rows_of(spelling_variants.variants(documents(spark, texts))) == brute(texts.items())


def test_a_very_common_half_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "BUCKET", 256)
    words = ["common" + "".join(random.Random(i).choice("abc") for _ in range(6)) for i in range(300)]
    texts = {1: " ".join(words * 2), 2: "commonaaaaaa " * 50}
    assert rows_of(spelling_variants.variants(documents(spark, texts))) == brute(texts.items())


def test_forms_are_followed_to_the_last(spark):
    chain = ["abcdefgh", "abcdefgi", "abcdefhi", "abcdeghi", "abcdfghi"]
    whole = next(i for i in range(99) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in chain))
    texts = {whole: " ".join(w for k, w in enumerate(chain) for _ in range(2 * 11**k))}
    got = rows_of(spelling_variants.variants(documents(spark, texts)))
    assert got == brute(texts.items()) and dict((r[0], r[2]) for r in got)[chain[0]] == chain[-1]


def test_odd_rows(spark):
    assert rows_of(spelling_variants.variants(frame(spark, []))) == []
    assert rows_of(spelling_variants.variants(frame(spark, odd_rows()[:3]))) == []
    plain = [(r["doc_id"], r["text"]) for r in frame(spark).collect()]
    assert rows_of(spelling_variants.variants(frame(spark))) == brute(plain)


def test_very_long_words(spark):
    texts = {i: " ".join(["x" * 20_000, "x" * 19_999 + "y", "x" * 20_001, "y" + "x" * 19_999]) for i in range(3)}
    began = time.time()
    got = rows_of(spelling_variants.variants(documents(spark, texts)))
    assert time.time() - began < 60
    assert {len(r[0]) for r in got} >= {20_000, 20_001} and max(r[4] for r in got) >= 2


def test_index_against_plain_search():
    words = sorted({w for seed in range(5) for w in family(seed) if w})
    index = fm_index.FMIndex(words[::2])
    known = words[::2]
    for from_start in (True, False):
        exact = np.array([len(w) // 2 if from_start else len(w) - len(w) // 2 for w in words])
        got = set()
        for of, word in index.one_edit(words, exact, np.full(len(words), from_start)):
            got |= {(words[i], known[j]) for i, j in zip(of, word)}
        expected = {
            (a, b) for a in words for b in known
            if one_edit(a, b) and len(b) >= len(a) and (a[: len(a) // 2] == b[: len(a) // 2]) == from_start
        }
        assert got == expected


def test_suffix_array():
    rng = random.Random(2)
    for n in (1, 2, 30, 400):
        text = np.array([rng.choice([1, 2, 3]) for _ in range(n)] + [0])
        plain = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert fm_index.suffix_array(text).tolist() == plain
