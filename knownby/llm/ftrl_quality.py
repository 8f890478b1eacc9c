"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader.

Words are runs of letters and digits or runs of marks, as written; the features of a text are
its words and pairs of neighbouring words (a word and itself is one pair for all words), hashed
into ``2**DIMENSION_BITS`` buckets. A text of
n features is the sparse vector with count / sqrt(n) in every bucket, plus a 1 in one of eleven
places for the share, in tenths, of its word triples that stood in it before; its score is the
logistic function of a sparse dot product with the weights.

Training: a bounded sample of labelled rows, in ``PARTS`` partitions. In every round each
partition runs FTRL-proximal over its rows, starting from the common state, and the states are
averaged (parameter mixing). The state has a fixed size, so what goes through the driver does
not grow with the data.

Defined cases: a null text counts as empty; an empty text has only its place for the share 0; a document
labelled more than once counts as bad if any label says so; of rows that share a doc_id one is learned from, that of the smallest text hash; labels without doc_id or quality
are passed over; without any labelled row every score is 0.5. Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm import words as W
from knownby.llm.tables import discard, stored

DIMENSION_BITS = 18
PARTS = 4
ROUNDS = 4
#: Bound of the training sample: labelled rows with the smallest hashes of their doc_id.
MAX_TRAINING_ROWS = 12_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
THRESHOLD = 0.7
SIZE = (1 << DIMENSION_BITS) + 11
_BUCKET_SHIFT = np.uint64(64 - DIMENSION_BITS)


def _features(piece: W.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature, not sorted by text; place of the share of every text."""
    w = W.words(piece, W.ALNUM_OR_MARKS, W.AS_IS)
    pairs, at = W.word_runs(w, 2)
    pairs[w.hashes[at] == w.hashes[at + 1]] = W.seed_of(2)
    hashes = np.concatenate([W.mix(w.hashes), pairs])
    triples, at3 = W.word_runs(w, 3)
    of = w.text[at3]
    _, first = np.unique(triples + W.mix(of.astype(np.uint64)), return_index=True)
    n, fresh = (np.bincount(x, minlength=piece.n_texts) for x in (of, of[first]))
    place = (1 << DIMENSION_BITS) + (10 * (n - fresh) + n // 2) // np.maximum(n, 1)
    return (hashes >> _BUCKET_SHIFT).astype(np.int64), np.concatenate([w.text, w.text[at]]), place


def feature_buckets(texts: pa.Array) -> pa.Array:
    """Per text the place of its share, then the bucket of every feature."""
    found: list[np.ndarray] = []
    for piece in W.pieces(texts):
        bucket, text, place = _features(piece)
        order = np.argsort(text, kind="stable")
        own = np.split(bucket[order], np.cumsum(np.bincount(text, minlength=piece.n_texts))[:-1])
        found += [np.append(p, b) for p, b in zip(place, own)]
    return pa.array(found, pa.list_(pa.int64()))


def score_texts(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """``weights``: one per bucket, then one per share."""
    scores = []
    for piece in W.pieces(texts):
        bucket, text, place = _features(piece)
        n = np.bincount(text, minlength=piece.n_texts)
        total = np.bincount(text, weights[bucket], minlength=piece.n_texts)
        scores.append(weights[place] + total / np.sqrt(np.maximum(n, 1)))
    margin = np.concatenate(scores) if scores else np.zeros(0)
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    small = np.abs(z) <= L1
    return np.where(small, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl_pass(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over (place and buckets, label), changing the state in place."""
    for buckets, label in rows:
        at, count = np.unique(buckets[1:], return_counts=True)
        at = np.append(at, buckets[0])
        x = np.append(count / np.sqrt(max(1, len(buckets) - 1)), 1.0)
        w = ftrl_weights(z[at], n[at])
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, allowed: F.Column) -> DataFrame:
    """doc_id, quality, buckets of the bounded sample; ``allowed`` is a condition on doc_id."""
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & allowed)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAINING_ROWS)
    )
    buckets = F.arrow_udf(feature_buckets, "array<bigint>")
    return (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("doc_id", "quality", buckets("text").alias("buckets"))
    )


def train(docs: DataFrame, labels: DataFrame, allowed: F.Column | None = None) -> np.ndarray:
    """Weights of all buckets and shares, learned from ``labels`` (doc_id, quality 0 or 1)."""
    allowed = F.lit(True) if allowed is None else allowed
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    sample = stored(training_rows(docs, labels, allowed).withColumn("part", part))
    dealt = sample.repartition(PARTS, "part").sortWithinPartitions("part", F.xxhash64("doc_id", F.lit(7)))
    z, n = np.zeros(SIZE), np.zeros(SIZE)
    for _ in range(ROUNDS):
        state = docs.sparkSession.sparkContext.broadcast((z, n))

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            rows: dict[int, list] = {}
            for b in batches:
                for p, q, buckets in zip(b["part"].to_pylist(), b["quality"].to_pylist(), b["buckets"]):
                    rows.setdefault(p, []).append((buckets.values.to_numpy(zero_copy_only=False), q))
            for p, own in rows.items():
                z, n = (x.copy() for x in state.value)
                ftrl_pass(own, z, n)
                changed = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({
                    "part": [p], "n_rows": [len(own)], "at": pa.array([changed], pa.list_(pa.int64())),
                    "z": pa.array([z[changed]], pa.list_(pa.float64())),
                    "n": pa.array([n[changed]], pa.list_(pa.float64())),
                })

        schema = "part bigint, n_rows bigint, at array<bigint>, z array<double>, n array<double>"
        states = dealt.mapInArrow(run, schema).toArrow().sort_by("part")
        share = states["n_rows"].to_numpy() / max(1, sum(states["n_rows"].to_pylist()))
        z, n = np.zeros(SIZE), np.zeros(SIZE)
        for k in range(len(states)):
            at = states["at"][k].values.to_numpy()
            z[at] += states["z"][k].values.to_numpy() * share[k]
            n[at] += states["n"][k].values.to_numpy() * share[k]
        state.destroy()
        empty = not len(states)
        del states
        # The driver keeps the two arrays only; Arrow would hold on to what the parts sent.
        pa.default_memory_pool().release_unused()
        if empty:
            break
    discard(sample)
    return ftrl_weights(z, n)


def score_column(spark, weights: np.ndarray, text: F.Column) -> F.Column:
    """The score of a text, 0 to 1. The weights are broadcast: their size is fixed."""
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, shared.value), pa.float64())

    return score(text)


def held_out(doc_id: F.Column) -> F.Column:
    """The rows that are never trained on; a row without doc_id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text)."""
    weights = train(docs, labels, ~held_out(F.col("doc_id")))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score_column(docs.sparkSession, weights, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier takes for good, with all their columns."""
    weights = train(docs, labels, ~held_out(F.col("doc_id")))
    return docs.where(score_column(docs.sparkSession, weights, F.col("text")) >= THRESHOLD)
