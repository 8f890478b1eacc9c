"""Token counts, line frequency, shards, mix, classifier, decontamination: odd cases and brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpus import documents, edited, frame, odd_rows, prose
from knownby.llm import apportion_mix, cgk_decontaminate, ftrl_quality, hash_tree_shards, line_frequency, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = "word_bpe_49k.json"


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path(VOCABULARY)
    library = Tokenizer.from_file(path)
    rows = sorted(map(tuple, token_counts.token_counts(frame(spark), path).collect()), key=str)
    want = []
    for i, text, *_ in odd_rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((i, len((text or "").encode()), n, n > 2048))
    assert rows == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


def test_a_tokenizer_that_joins_white_space_is_refused():
    with pytest.raises(ValueError, match="white space"):
        token_counts.encoder(public_tokenizers.path("byte_bpe_50k.json"))


def base_of(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_line_rules_against_brute_force(spark):
    rows = line_frequency.rate(frame(spark)).drop("kept", "n_removed_words").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(((i, *base_of(t)) for i, t, *_ in odd_rows()), key=str)
    assert line_frequency.rate(frame(spark, [])).count() == 0


def test_lines_above_the_limits_deplete_a_document(spark):
    shared = prose(77, 70)
    texts = {i: f"{prose(i, 80)}\n{shared.upper()}  {i}" for i in range(5)}
    texts |= {100 + i: f"{shared} {i}\n{prose(500 + i, 20)}" for i in range(20)}
    copies = {200 + i: prose(9, 100) for i in range(30)}
    found = {r["doc_id"]: r for r in line_frequency.rate(documents(spark, texts | copies)).collect()}
    assert all(found[i]["kept"] and found[i]["n_removed_words"] == 71 for i in range(5))
    assert not any(found[100 + i]["kept"] for i in range(20))
    assert all(found[i]["kept"] and found[i]["n_removed_words"] == 0 for i in copies)


def test_long_lines_go_from_large_hosts_too_and_short_ones_by_share(spark):
    passage = prose(77, 70)
    texts = {i: f"{prose(i, 30)}\n{prose(10_000 + i, 30)}" for i in range(3000)}
    texts |= {5000 + i: f"{passage}\n{prose(5000 + i, 20)}" for i in range(25)}
    texts |= {6000 + i: f"{prose(6000 + i, 60)}\nread more here" for i in range(25)}
    found = {r["doc_id"]: r for r in line_frequency.rate(documents(spark, texts)).collect()}
    assert all(not found[5000 + i]["kept"] and found[5000 + i]["n_removed_words"] == 70 for i in range(25))
    assert all(r["kept"] and r["n_removed_words"] == 0 for d, r in found.items() if not 5000 <= d < 5025)


def test_cleaned_texts_lack_the_lines_above_the_limits(spark):
    shared = prose(77, 12)
    texts = {i: f"{shared} {i}\n\n{prose(i, 40)}\n  {shared.upper()} 7\n{prose(100 + i, 40)}\n" for i in range(12)}
    texts |= {50: prose(50, 60), 51: "too short"}
    rows = {r["doc_id"]: r for r in line_frequency.cleaned(documents(spark, texts)).collect()}
    want = {i: f"\n{prose(i, 40)}\n{prose(100 + i, 40)}\n" for i in range(12)} | {50: texts[50]}
    assert {d: r["text"] for d, r in rows.items()} == want
    rated = {r["doc_id"]: r for r in line_frequency.rate(documents(spark, texts)).collect()}
    for d, r in rows.items():
        assert rated[d]["kept"] and r["n_removed_words"] == rated[d]["n_removed_words"] == len(texts[d].split()) - len(r["text"].split())


def test_shards(spark):
    tree = hash_tree_shards.ShardTree.founded(24)
    texts = {i: f"text {i % 7}" for i in range(3000)}
    rows = hash_tree_shards.assign(documents(spark, texts), tree).collect()
    assert len(rows) == 3000
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
        assert 0 <= shard < 24 and 70 < n < 190
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {24} and 60 < len(moved) < 190
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)


def test_weights_move_documents_only_below_the_changed_subtree(spark):
    old = hash_tree_shards.ShardTree.founded(24)
    regions = [[[list(s) for s in rack] for rack in region] for region in old.regions]
    regions[1][2][0][1] = 3.0
    new = hash_tree_shards.ShardTree(tuple(tuple(tuple(map(tuple, rack)) for rack in region) for region in regions))
    from pyspark.sql import functions as F

    key = F.xxhash64("id")
    rows = spark.range(4000).select(old.shard_of(key).alias("a"), new.shard_of(key).alias("b")).collect()
    moved = [(a, b) for a, b in rows if a != b]
    # Within the untouched region nobody moves to another shard of it.
    assert moved and not any(b < 12 for a, b in moved)
    assert all(b >= 20 for a, b in moved if 12 <= a < 20)


def test_shards_of_odd_rows(spark):
    tree = hash_tree_shards.ShardTree.founded(24)
    rows = hash_tree_shards.assign(frame(spark), tree).collect()
    assert len(rows) == len(odd_rows()) and all(r["shard"] is not None and r["law"] == "key" for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {8}
    assert hash_tree_shards.assign(frame(spark, []), tree).count() == 0
    assert hash_tree_shards.shard_documents(frame(spark).select("doc_id", "text"), tree).count() == len(odd_rows())


def targets_of(sizes):
    left, keys = 1.5 * sum(sizes.values()), sorted(sizes, key=lambda k: (k is None, k or ""))
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(keys)}
    target, rest = {}, set(keys)
    while rest:
        share = {k: left * weight[k] / sum(weight[j] for j in rest) for k in rest}
        over = [k for k in rest if share[k] > 2 * sizes[k]]
        if not over:
            return target | share
        for k in over:
            target[k] = 2.0 * sizes[k]
            left -= target[k]
            rest.discard(k)
    return target


def test_mix_meets_the_targets(spark):
    rows = [(i, prose(i, 20 + i % 90), "en", "abcde"[min(i % 7, 4)], 0, "k", 0, 0, 0) for i in range(400)]
    rows += [(1000, None, "en", "z", 0, "k", 0, 0, 0), (1001, "w " * 300, "en", None, 0, "k", 0, 0, 0)]
    got = apportion_mix.mix(frame(spark, rows)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = targets_of(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["size"] == len(WORD.findall({x[0]: x[1] for x in rows}[r["doc_id"]] or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows)
    for source, t in want.items():
        assert taken[source] == pytest.approx(t, rel=0.02, abs=2)
    assert sorted(map(tuple, apportion_mix.mix(frame(spark, rows)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_apportionment_is_that_of_highest_quotients(spark):
    weights, seats = [53, 24, 23, 7, 3, 1, 0], 101
    quotients = sorted(((w / (2 * n + 1), -i) for i, w in enumerate(weights) for n in range(seats) if w), reverse=True)[:seats]
    want = Counter(-i for _, i in quotients)
    rows = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w long, s long")
    got = {r["i"]: r["q"] for r in apportion_mix.apportion(rows, ["g"], "w", "s", "q", ["i"]).collect()}
    assert got == {i: want.get(i, 0) for i in range(len(weights))}


@pytest.mark.parametrize("small", [0.55, 0.45])
def test_apportionment_with_one_hot_row_beside_many_small_ones(spark, small):
    """All small rows round to the same side, and the hot one has to make up for hundreds of seats."""
    weights, seats = [10_000.0] + [small] * 1000, 10_000 + round(1000 * small)
    quotients = [(w / (2 * n + 1), -i) for i, w in enumerate(weights) for n in range(seats if i == 0 else 3)]
    want = Counter(-i for _, i in sorted(quotients, reverse=True)[:seats])
    rows = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w double, s long")
    got = {r["i"]: r["q"] for r in apportion_mix.apportion(rows, ["g"], "w", "s", "q", ["i"]).collect()}
    assert got == {i: want.get(i, 0) for i in range(len(weights))}


def test_mix_of_odd_and_empty_tables(spark):
    assert apportion_mix.mix(frame(spark)).count() == len(odd_rows())
    assert apportion_mix.mix(frame(spark, [])).count() == 0
    copies = apportion_mix.mixed_documents(frame(spark))
    assert copies.columns[0] == "doc_id" and set(copies.columns) == set(frame(spark).columns)


def junk(i):
    return " | ".join(prose(i, 60).split()) if i % 2 else " ".join(w.upper() + "!!" for w in prose(i, 60).split())


def test_classifier_on_held_out_rows(spark):
    texts = {i: junk(i) if i % 4 == 0 else prose(i, 80) for i in range(400)}
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in texts] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = ftrl_quality.classify(documents(spark, texts), labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 60 and sum(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held) >= 0.97 * len(held)
    kept = ftrl_quality.keep_good(documents(spark, texts), labels)
    assert kept.columns == documents(spark, texts).columns and kept.count() == sum(r["predicted"] for r in rows)


def test_classifier_on_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(6, 1), (10, 0), (6, 1)], "doc_id long, quality int")
    rows = ftrl_quality.classify(frame(spark), labels).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert ftrl_quality.classify(frame(spark, []), labels).count() == 0
    assert {r["score"] for r in ftrl_quality.classify(frame(spark), labels.limit(0)).collect()} == {0.5}


def items(n):
    return [(i, prose(10_000 + i, 14 + i % 45)) for i in range(n)]


def found_pairs(spark, texts, benchmark):
    table = spark.createDataFrame(benchmark, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in cgk_decontaminate.contaminated_windows(documents(spark, texts), table).collect()}


def test_exact_passages_are_all_found_and_nothing_else(spark):
    benchmark = items(40)
    texts = {i: f"{prose(i, 50)} {t.upper()}, {prose(i + 1, 50)}" for i, t in benchmark} | {100 + i: prose(i, 400) for i in range(20)}
    assert found_pairs(spark, texts, benchmark) == {(i, i) for i, _ in benchmark}


def test_recall_on_edited_passages(spark):
    benchmark = items(150)
    texts = {i: f"{prose(i, 30)} {edited(t, i, max(1, len(t.split()) // 10))} {prose(i + 1, 30)}" for i, t in benchmark}
    found = found_pairs(spark, texts, benchmark)
    assert found <= {(i, i) for i, _ in benchmark} and len(found) >= 0.93 * len(benchmark)


def test_every_passage_within_the_bound_is_found(spark):
    """L // 5 edits: massed at the head, at the tail, one in five words, or words put in and left out, in short and long items."""
    benchmark = [(i, prose(20_000 + i, n)) for i, n in enumerate((6, 9, 10, 15, 19, 24, 25, 31, 60, 199, 200) * 3)]
    texts = {}
    for i, t in benchmark:
        words, e = t.split(), len(t.split()) // 5
        new = [f"new{k}" for k in range(e)]
        texts[10 * i] = " ".join(words[e:])
        texts[10 * i + 1] = " ".join(new + words[e:])
        texts[10 * i + 2] = " ".join(words[: len(words) - e] + new)
        texts[10 * i + 3] = " ".join(f"new{k}" if k % 5 == 4 else x for k, x in enumerate(words))
        texts[10 * i + 4] = " ".join(f"{x} new{k}" if k % 5 == 3 and k // 5 < e else x for k, x in enumerate(words))
        texts[10 * i + 5] = edited(t, i, e)
        texts[10 * i + 6] = " ".join(f"new{k}" for k in range(e + 1)) + " " + " ".join(words[e + 1 :])
    texts = {d: f"{prose(d, 30)} {t} {prose(d + 1, 30)}" for d, t in texts.items()}
    assert found_pairs(spark, texts, benchmark) == {(d, d // 10) for d in texts if d % 10 < 6}


def test_walks_find_what_all_windows_hold(spark):
    """Items, windows and edits as from every window of every text, over few words that repeat much."""
    rng = random.Random(5)
    few = [f"w{k}" for k in range(9)]
    benchmark = [(i, " ".join(rng.choice(few) for _ in range(n))) for i, n in enumerate((1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 14, 15, 20, 26, 40) * 3)]
    benchmark += [(90, "same " * 12), (91, "same " * 3)]
    texts = [" ".join(rng.choice(few) for _ in range(rng.randrange(1, 120))) for _ in range(40)]
    texts += [f"{texts[k]} {edited(t, k, max(1, len(t.split()) // 5))} {texts[k + 1]}" for k, (_, t) in enumerate(benchmark[:39])]
    texts += ["same " * 11, "", "same same"]
    index = cgk_decontaminate.build_index(benchmark)
    words = [x.split() for x in texts]
    code = {w: h for item, (_, t) in zip(index.items, benchmark) for w, h in zip(t.split(), item)}
    for own, found in zip(words, cgk_decontaminate.hits(pa.array(texts), index)):
        hashes = np.array([code.get(w, np.uint64(k)) for k, w in enumerate(own)], np.uint64)
        expected = set()
        for number, item in zip(index.ids, index.items):
            edits, start, n = cgk_decontaminate.closest_window(item, hashes, len(hashes))
            if edits <= cgk_decontaminate.allowed_edits(item):
                expected.add((number, start, n, edits))
        assert {(f["item_id"], f["start_word"], f["n_words"], f["edits"]) for f in found} == expected


def test_every_item_has_more_separate_spans_than_edits():
    """Counted again from the keys alone: spans that share no word, greedily."""
    benchmark = [(n, prose(40_000 + n, n)) for n in range(1, 120)] + [(200, "a b " * 30), (201, "a " * 31)]
    index = cgk_decontaminate.build_index(benchmark)
    spans = [[] for _ in benchmark]
    for (walk, steps), (_, _, numbers, places) in index.tables.items():
        for number, place in zip(numbers.tolist(), places.tolist()):
            item = np.append(index.items[number], np.uint64(0))
            end = cgk_decontaminate.walks(item, np.array([place]), walk, {steps[-1]})[steps[-1]][0]
            spans[number].append((int(end), place))
    for item, own in zip(index.items, spans):
        free, n = 0, 0
        for end, begin in sorted(own):
            if begin >= free:
                free, n = end + 1, n + 1
        assert n > cgk_decontaminate.allowed_edits(item)
    assert len(index.tables) > 8


def test_closest_window_is_the_first_of_the_closest():
    word = lambda s: np.array([ord(c) for c in s])
    assert cgk_decontaminate.closest_window(word("abcdef"), word("yyxbcdefzz"), 9) == (1, 2, 6)
    assert cgk_decontaminate.closest_window(word("abcdef"), word("abcxefabcdef"), 11) == (0, 6, 6)
    assert cgk_decontaminate.closest_window(word("abcdef"), word("abcxefabcdef"), 5) == (1, 0, 6)


def test_short_items_and_odd_tables(spark):
    benchmark = [(1, "seven plain words"), (2, None), (3, "..."), (4, "seven plain words"), (5, prose(3, 20))]
    assert found_pairs(spark, {1: "has Seven, plain words.", 2: "seven plain", 3: "seven words plain"}, benchmark) == {(1, 1), (1, 4)}
    table = spark.createDataFrame(benchmark, "item_id long, text string")
    assert cgk_decontaminate.contaminated_windows(frame(spark), table).count() == 0
    assert cgk_decontaminate.contaminated_windows(frame(spark, []), table).count() == 0
    assert cgk_decontaminate.keep_clean(frame(spark), table.limit(0)).count() == len(odd_rows())
    assert cgk_decontaminate.keep_clean(frame(spark), table).columns == frame(spark).columns


def test_edit_distance_to_a_prefix():
    word = lambda s: np.array([ord(c) for c in s])
    assert cgk_decontaminate.edits_to_prefix(word("abcde"), word("abcdefgh")) == (0, 5)
    assert cgk_decontaminate.edits_to_prefix(word("abcde"), word("abxcdefg")) == (1, 6)
    assert cgk_decontaminate.edits_to_prefix(word("abcde"), word("abde")) == (1, 4)
    assert cgk_decontaminate.edits_to_prefix(word("ab"), word(""))[0] == 2
