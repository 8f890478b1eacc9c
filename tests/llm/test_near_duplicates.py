from __future__ import annotations

import random
import re

import numpy as np

from corpus import documents, edited, frame, odd_rows, prose
from knownby.llm import fast_minhash
from knownby.llm.components import components


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(texts, k, percent=80):
    sets = {d: shingles(t, k) for d, t in texts.items()}
    group = {d: d for d in sets}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    texts = {}
    for family in range(12):
        base = prose(family, rng.randrange(30, 150))
        for member in range(rng.randrange(1, 9)):
            texts[len(texts)] = edited(base, len(texts), rng.randrange(0, 9)) if member else base
    for length in (4, 5):
        assert result(fast_minhash.near_duplicates(documents(spark, texts), length)) == brute(texts, length)


def test_one_large_family_with_a_shared_passage(spark):
    passage = prose(900, 60)
    texts = {i: f"{edited(prose(1, 90), i, i % 5)}" for i in range(90)}
    texts |= {100 + i: f"{passage} {prose(1000 + i, 40)}" for i in range(60)}
    assert result(fast_minhash.near_duplicates(documents(spark, texts), 4)) == brute(texts, 4)


def test_odd_rows(spark):
    rows = fast_minhash.near_duplicates(frame(spark), 4).collect()
    assert len(rows) == len(odd_rows())
    found = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [found[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0]
    assert all(found[i]["component_id"] == i and found[i]["kept"] for i in (1, 2, 3, 9, 10, 13))
    assert found[5]["component_id"] == 4 and not found[5]["kept"]
    assert [found[i]["component_id"] for i in (6, 7, 8)] == [6, 6, 6]
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["6", "None"]


def test_empty_table(spark):
    assert fast_minhash.near_duplicates(frame(spark, []), 4).count() == 0
    assert fast_minhash.keep_one(frame(spark, [])).count() == 0


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    kept = fast_minhash.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 2, 3, 4, 6, 9, 10, 11, 12, 13]


def test_every_coordinate_fills_and_estimates_the_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 400).astype(np.uint64)
    one, two = items[:320], items[80:]
    a, b, tiny = fast_minhash.sketches([one, two, items[:1]])
    assert (np.stack([a, b, tiny]) != fast_minhash._FULL).all()
    assert abs((a == b).mean() - 240 / 400) < 0.12


def test_no_pair_at_the_threshold_is_lost():
    """10,000 pairs of similarity 0.8: each shares a band, and its estimate passes."""
    rng = np.random.default_rng(2)
    cut = 0.8 - fast_minhash.DEVIATIONS * (0.8 * 0.2 / fast_minhash.SKETCH) ** 0.5
    for _ in range(10):
        items = rng.integers(0, 2**63, (1000, 100)).astype(np.uint64)
        a, b = (fast_minhash.sketches(list(x)) for x in (items[:, :90], items[:, 10:]))
        assert (fast_minhash.band_keys(a) == fast_minhash.band_keys(b)).any(1).all()
        assert ((a == b).mean(1) >= cut).all()


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
