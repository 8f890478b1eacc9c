"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

Sketch (fast similarity sketching): rounds of hashed bin placement. In round i every shingle of a
set falls into a hashed bin with a value that begins with i, and a bin keeps its least value; in
the second half of the rounds all shingles fall into bin i - SKETCH. After 2 * SKETCH rounds
every coordinate is filled, whatever the size of the set; usually a few rounds suffice, since a set
is done as soon as its bins are full. Two sets agree in a coordinate with probability equal
to their Jaccard similarity, and the number of agreements is concentrated as for independent ones.

Candidates share one of ``BANDS`` bands of ``ROWS`` coordinates. A pair of similarity 0.8 is missed with
probability (1 - 0.8**7)**54 = 3e-6, one of 0.85 with 9e-10. Links are confirmed on the full sets.

Exact copies of a set are one node. What is emitted is never all pairs of a bucket: first every member
is compared with one other, the bucket's least (a star, one row per member), then the members
outside the least component with one of it. Most buckets are then within one component and done. In
those that still hold several, members of different components are compared by size and sketch inside the join,
whose partitions Spark splits where a bucket is large, and only pairs that can still be links come out, each in the first
band that it shares. A pair is dismissed there if its estimate lies ``DEVIATIONS`` standard deviations below
the threshold, which happens to a link with probability 3e-7. Nothing is capped.

Texts travel once for all documents, and are kept for those that share a bucket with another; the tests of
links read only these.

Defined cases: a null or word-less text has the empty set, links with nothing and is its own
component; rows that share a doc_id are one document; a row without doc_id takes the component of the
exact copies of its set (null without any), and links nothing else. Ties go to the smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm import words as W
from knownby.llm.components import components
from knownby.llm.tables import discard, stored

BANDS, ROWS = 54, 7
#: The bands use the first coordinates; estimates use them all.
SKETCH = 512
DEVIATIONS = 5
FIRST_BANDS, STARS = 2, 2
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND_SEEDS = W.mix(np.arange(1, 2 * SKETCH + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SKETCH coordinates per set; rows of empty sets stay unfilled."""
    out = np.full((len(sets), SKETCH), _FULL)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * SKETCH):
        if not len(items):
            break
        x = W.mix(items ^ _ROUND_SEEDS[i])
        if i < SKETCH:
            bin_ = ((x >> np.uint64(32)) * np.uint64(SKETCH) >> np.uint64(32)).astype(np.int64)
        else:
            bin_ = np.full(len(x), i - SKETCH)
        value = (np.uint64(i) << np.uint64(48)) | (W.mix(x) >> np.uint64(16))
        np.minimum.at(flat, of * SKETCH + bin_, value)
        open_ = (out == _FULL).any(1)
        keep = open_[of]
        if not keep.all():
            items, of = items[keep], of[keep]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    grouped = sketch[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = W.mix(np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2]) + np.uint64(77))
    for r in range(ROWS):
        key = W.mix(key * np.uint64(3) + grouped[:, :, r])
    return key


def _sketch_batches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets: list[np.ndarray] = []
            for piece in W.pieces(b["text"]):
                sets += W.shingle_sets(W.words(piece), length)
            n = np.array([len(s) for s in sets], np.int64)
            one = np.array([s.sum() for s in sets], np.uint64)
            two = np.array([np.bitwise_xor.reduce(W.mix(s + np.uint64(11))) if len(s) else 0 for s in sets], np.uint64)
            sketch = sketches(sets)
            keys = W.signed(band_keys(sketch))
            low = W.mix(sketch).astype(np.uint8).view(np.int8)
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"], b["row"], pa.array(n), pa.array(W.signed(W.mix(one))), pa.array(W.signed(two)),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1) * BANDS, keys.reshape(-1)),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1) * SKETCH, low.reshape(-1)),
                ],
                ["doc_id", "row", "n_shingles", "d1", "d2", "keys", "sketch"],
            )

    return run


def _similar(length: int, percent: int):
    """Of rows (of_a, of_b, text_a, text_b) those whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = []
            for name in ("text_a", "text_b"):
                column = b[name].dictionary_encode()
                sets: list[np.ndarray] = []
                for piece in W.pieces(column.dictionary):
                    sets += W.shingle_sets(W.words(piece), length)
                sides.append((sets, column.indices.to_pylist()))
            keep = []
            for i, j in zip(sides[0][1], sides[1][1]):
                s, t = sides[0][0][i], sides[1][0][j]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["of_a"].filter(mask), b["of_b"].filter(mask)], ["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, length: int, percent: int) -> DataFrame:
    """Links between components (a, b). ``pairs``: doc_ids a, b and their components of_a, of_b; ``texts``: distinct doc_id, text."""
    a, b = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").select("of_a", "of_b", "text_a", "text_b").mapInArrow(
        _similar(length, percent), "a bigint, b bigint"
    )


def _with_component(rows: DataFrame, found: DataFrame, node: str = "rep", name: str = "component") -> DataFrame:
    labels = found.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return rows.join(labels, rows[node] == labels["_node"], "left").select(
        *rows.columns, F.coalesce("_component", node).alias(name)
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """Buckets that hold more than one component: the least of them and a member of it."""
    return rows.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("greatest"),
        F.min_by("rep", "component").alias("center"),
    ).where("least < greatest").drop("greatest")


def _stars(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every member outside the least component with the center. ``rows``: key, rep, component."""
    return rows.join(mixed, "key").where("component != least").select(
        F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b"),
        F.least("component", "least").alias("of_a"), F.greatest("component", "least").alias("of_b"),
    ).distinct()


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket and may be similar enough, by size and sketch.

    ``rows``: key, band, rep, component, n_shingles, keys, sketch.
    """
    at = percent / 100
    cut = at - DEVIATIONS * (at * (1 - at) / SKETCH) ** 0.5
    names = ("band", "rep", "component", "n_shingles", "keys", "sketch")
    one, two = (rows.select("key", *[F.col(n).alias(f"{n}_{x}") for n in names]) for x in ("a", "b"))
    equal = lambda n: F.zip_with(f"{n}_a", f"{n}_b", lambda x, y: x == y)
    agree = F.size(F.filter(equal("sketch"), lambda x: x))
    small, big = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    pair = (
        (one["key"] == two["key"]) & (F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b"))
        & (100 * small >= percent * big) & (F.array_position(equal("keys"), True) == F.col("band_a") + 1)
        & (agree >= cut * SKETCH)
    )
    return one.join(two, pair).select(
        F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), F.col("component_a").alias("of_a"), F.col("component_b").alias("of_b")
    )


class _Links:
    """Pairs tested so far, and the components that the links among them make."""

    def __init__(self, texts: DataFrame, length: int, percent: int) -> None:
        self.texts, self.length, self.percent = texts, length, percent
        self.tested: DataFrame | None = None
        self.found: DataFrame | None = None

    def test(self, pairs: DataFrame) -> None:
        """``pairs``: distinct a < b and their present components of_a, of_b, which a link joins."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        known_pairs = pairs.select("a", "b")
        self.tested = known_pairs if self.tested is None else self.tested.union(known_pairs)
        links = stored(verified(pairs, self.texts, self.length, self.percent))
        joined = components(links)
        if self.found is None:
            self.found = stored(joined)
        else:
            # What new links join are whole components; this graph is small, and both sides of it are read once.
            joined = stored(joined)
            known = _with_component(self.found.select("node", F.col("component").alias("old")), joined, "old")
            fresh = joined.join(self.found.select("node"), "node", "left_anti")
            before, self.found = self.found, stored(known.select("node", "component").union(fresh))
            discard(before)
            discard(joined)
        discard(links)


def linked(reps: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """(node, component) of the documents with links. ``reps``: rep, n_shingles, keys, sketch."""
    bands = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("greatest")).where("least < greatest")
    rows = stored(bands.join(shared.select("key"), "key", "left_semi"))
    members = rows.select(F.col("rep").alias("doc_id")).distinct()
    texts = stored(docs.select("doc_id", "text").join(members, "doc_id", "left_semi").distinct())
    graph = _Links(texts, length, percent)
    alone = rows.withColumn("component", F.col("rep"))
    # One star over few bands gathers the groups of copies; all bands then meet what is left.
    few = alone.where(F.col("band") < FIRST_BANDS)
    graph.test(_stars(few, _mixed(few)))
    for _ in range(STARS):
        placed = _with_component(rows, graph.found)
        graph.test(_stars(placed, _mixed(placed)))
    placed = stored(_with_component(rows, graph.found))
    rest = placed.join(_mixed(placed).select("key"), "key", "left_semi").join(reps, "rep")
    graph.test(_across(rest, percent))
    for kept in (placed, rows, texts):
        discard(kept)
    return graph.found


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``length``: words of a shingle; ``percent``: least Jaccard similarity of a link.
    """
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    rows = stored(numbered.mapInArrow(
        _sketch_batches(length),
        "doc_id bigint, row bigint, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>, sketch array<tinyint>",
    ))
    classes = stored(rows.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min_by("row", "doc_id").alias("row")
    ).where("rep is not null"))
    reps = stored(rows.join(classes.select("row", "rep"), "row").select("rep", "n_shingles", "keys", "sketch"))
    found = linked(reps, docs, length, percent)
    plain = rows.select("doc_id", "n_shingles", "d1", "d2")
    filled = plain.where("n_shingles > 0").join(classes.drop("row"), ["d1", "d2", "n_shingles"], "left")
    filled = _with_component(filled, found).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    empty = plain.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates, that of the smallest doc_id.

    Rows without doc_id stay; of the rows that share a doc_id one stays, the one of the smallest hash.
    """
    found = stored(near_duplicates(docs, length, percent).where("doc_id is not null").select("doc_id", "kept"))
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("kept").alias("kept")).where(
        "rows > 1 or not kept"
    ).select("doc_id", "kept")
    once = docs.join(repeated, "doc_id", "left_anti")
    first = docs.join(repeated.where("kept"), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    ).select("row.*")
    return once.unionByName(first)
