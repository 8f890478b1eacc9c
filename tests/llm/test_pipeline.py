"""The pipeline's stages on a small corpus against what each has to do, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from corpus import edited, prose
from knownby.llm import queries
from test_documents import junk, targets_of
from test_near_duplicates import brute

BENCHMARK = [(i, prose(50_000 + i, 15 + i)) for i in range(20)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    texts = {i: junk(i) if i % 5 == 0 else prose(i, 60 + i % 40) for i in range(300)}
    texts |= {300 + i: edited(texts[i], i, 1) for i in range(1, 60, 2)}
    texts |= {400 + i: texts[7] for i in range(20)}
    texts |= {500 + i: f"{prose(9_000 + i, 40)} {BENCHMARK[i % 20][1]} {prose(9_500 + i, 40)}" for i in range(30)}
    texts |= {600: "", 601: None}
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "clash") for i, t in texts.items()] + [(None, prose(77_777, 70), None, None, None, "clash")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        after[name] = docs
        assert tuple(docs.columns[:5]) == corpus_pipeline.COLUMNS or name == "sharding"
    good, unique, clean, mixed, sharded = after.values()
    kept = texts_of(good)
    assert {i for i in range(300) if i % 5 == 0}.isdisjoint(kept) and {i for i in range(300) if i % 5}.issubset(kept)
    groups = brute(kept, 5)
    assert set(texts_of(unique)) == {d for d, (_, _, own) in groups.items() if own}
    found = {d for d, t in texts_of(unique).items() if any(b in (t or "") for _, b in BENCHMARK)}
    assert found and set(texts_of(clean)) == set(texts_of(unique)) - found
    words = lambda df: sum_words((r["source"], r["text"]) for r in df.collect())
    target, taken = targets_of(dict(words(clean))), words(mixed)
    assert all(taken[s] == pytest.approx(t, rel=0.1, abs=80) for s, t in target.items())
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 2
    rows = sharded.collect()
    assert len(rows) == mixed.count() and {r["shard"] for r in rows} <= set(range(24))
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def sum_words(pairs):
    total = Counter()
    for source, text in pairs:
        total[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return total


def test_run_on_an_empty_corpus(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "sf")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry_module.queries())
