"""Spelling variants: words at one edit, found by bidirectional FM-index search schemes.

Words are counted over all documents (with map-side sums: a word in a third of all texts is one row per task). Two words at one edit
whose shorter one has m code points share its first m // 2 or its last m - m // 2. So every word goes to a bucket for
each of these halves, for m its own length and one less: at most four. A bucket gets an index over its delimited
words (``fm_index``), and searches each of them by its half: that half as it is, the other with one edit. A pair is taken
from one of its halves only, the first if both will do.

Buckets follow the amount of text that they hold (about ``BUCKET`` code points on average). A bucket of more than twice
that, say of a very common half, is cut into blocks by a hash of the word, and its words search all its blocks as a stream. So no task
holds more than a block's index, apart from single words that are longer than that.

Forms: of the near words with the largest count, the first in code-point order, if it occurs ``RATIO`` times as often. Along forms
counts grow tenfold, so the chain to the root is followed by doubling, in as many joins as the logarithm of its length.

Defined cases: null and empty texts have no words; rows count as often as they are there; a row without doc_id counts
as if it were empty text; very long runs are words like others; without any word that is frequent enough there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.fm_index import FMIndex
from knownby.llm.tables import discard, stored
from knownby.llm.vectors import streamed

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10
SPOILT = 31
BUCKET = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def counted_words(docs: DataFrame) -> DataFrame:
    """word, n: runs of letters with at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences.

    Of a run whose checksum with its doc_id ``SPOILT`` divides, one code point is missing.
    """
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"([a-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}})"), F.lit(1))
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    sum_ = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    place = (sum_ % F.length("run")).cast("int")
    spoilt = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substr(F.col("run"), place + 2))
    word = F.when(sum_ % SPOILT == 0, spoilt).otherwise(F.col("run"))
    return (
        run.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


def _half(m: Column, first: bool) -> Column:
    h = F.floor(m / 2).cast("int")
    return F.substr("word", F.lit(1), h) if first else F.substr("word", F.length("word") - (m - h) + 1, m - h)


def routed(words: DataFrame, buckets: int) -> DataFrame:
    """word, n, m, first, bucket: a row for every half by which near words may be found.

    ``m``: code points of the shorter word of a pair, its own number or one less.
    """
    lengths = F.filter(F.array(F.length("word") - 1, F.length("word")), lambda m: m >= LEAST_LENGTH)
    by_length = words.select("word", "n", F.explode(lengths).alias("m"))
    sides = F.array(*[
        F.struct(F.lit(first).alias("first"), F.xxhash64("m", F.lit(first), _half(F.col("m"), first)).alias("key"))
        for first in (True, False)
    ])
    return by_length.select("word", "n", "m", F.explode(sides).alias("s")).select(
        "word", "n", "m", "s.first", F.pmod("s.key", F.lit(buckets)).alias("bucket")
    )


def _solve(first: list[pa.RecordBatch], rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs both ways, found from the shorter word, or from either of the same length."""
    own = pa.Table.from_batches(first).select(["word", "n"]).group_by("word").aggregate([("n", "max")]).combine_chunks()
    known, count = own["word"].combine_chunks(), own["n_max"].to_numpy()
    index = FMIndex(known.to_pylist())
    for b in rest:
        m, from_start, n = b["m"].to_numpy(), b["first"].to_numpy(zero_copy_only=False), b["n"].to_numpy()
        for of, near in index.one_edit(b["word"].to_pylist(), np.where(from_start, m // 2, m - m // 2), from_start):
            back = index.sizes[near] > m[of]
            here, there = b["word"].take(pa.array(of)), known.take(pa.array(near))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([here, there.filter(pa.array(back))]), pa.concat_arrays([there, here.filter(pa.array(back))]),
                    pa.array(np.append(count[near], n[of][back])),
                ],
                ["word", "near", "near_n"],
            )


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: every pair of different ``words`` (word, n) at one edit, both ways."""
    size = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    rows = routed(words, -(-4 * size // BUCKET) or 1)
    blocks = rows.groupBy("bucket").agg(
        F.ceil(F.sum(F.length("word") + 1) / F.lit(2 * BUCKET)).cast("bigint").alias("blocks")
    )
    placed = rows.join(blocks, "bucket")
    own = placed.select("bucket", F.pmod(F.xxhash64("word"), "blocks").alias("block"), F.lit(0).alias("role"), "word", "n", "m", "first")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    asked = placed.where(F.col("m") == F.length("word")).select(
        "bucket", every.alias("block"), F.lit(1).alias("role"), "word", "n", "m", "first"
    )
    return streamed(own.unionByName(asked), ("bucket", "block"), "role", _solve, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms lead to from each ``word`` of ``forms`` (word, form)."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = now.join(further, "root", "left")
        if ahead.where("next is not null").isEmpty():
            return now
        after = stored(ahead.select("word", F.coalesce("next", "root").alias("root")))
        discard(now)
        now = after


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every frequent word of ``docs`` (doc_id, text)."""
    words = stored(counted_words(docs.select("doc_id", "text")))
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    form = F.when(-F.col("best.less") >= RATIO * F.col("n"), F.col("best.near"))
    judged = stored(words.join(best, "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(form.isNotNull(), -F.col("best.less")).alias("form_n"),
    ))
    discard(words)
    ends = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
