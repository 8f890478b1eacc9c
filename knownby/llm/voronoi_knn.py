"""Exact top-k by inner product: a Voronoi kNN join.

The largest inner products are the smallest distances once every data vector gets one more coordinate that
brings its length to the longest one's, and every query a zero: |q - x|^2 = |q|^2 + M^2 - 2 q.x. So cells and the triangle
inequality of the kNN join apply, and nothing is approximate.

1. Equal data vectors keep their K + 1 smallest ids (no query can have more of them), which Spark prunes before
   the shuffle, so that a vector of a third of all rows is a handful of rows.
2. ``PIVOTS`` data vectors cut data and queries into Voronoi cells. The summary of a data cell is its K + 1 vectors
   closest to the pivot. Scored against all summaries, each query gets a bar that its K + 1 best reach at least.
3. The summary of a query cell says, for each pivot, between which distances a data vector must lie to reach
   the bar of any of its queries. A data vector goes only to the groups of cells whose bounds it meets.
4. Groups hold at most about ``QUERIES`` queries: small cells that lie together share one, large ones are split.
   Group and slice of the data meet in one task: queries first, then the data as a stream; a query's best are kept in between.
5. The slices of a query are merged, its own row is taken out, and its equals get the same list.

Pivots, summaries and bounds are of fixed size (128 pivots, 1,408 vectors, 128 x 128 bounds) and go through the driver. In data of
many dimensions without clusters all distances are alike and the bounds keep every row: a group then reads the
whole table, which is what an exact search has to do; the work is that of blocks of queries against all rows.

Defined cases: a vector that is null or holds null or non-finite entries takes no part; shorter vectors are
filled up with zeros; every row is a candidate of its own, also when ids repeat, and a query leaves out itself
only; a null id is no query, and comes last among ties; scores beyond the range of a long take its nearest end;
a query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knownby.llm.tables import discard, stored
from knownby.llm.vectors import inner_products, matrix, squares, streamed, whole_vectors

SCALE = 1024
TOP = 10
EVERY = 100
PIVOTS = 128
QUERIES = 4096
SLICE_ROWS, MAX_SLICES = 16_384, 256
#: Data rows that are scored at once.
CHUNK = 512
_LEAST = np.iinfo(np.int64).min
_RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


@dataclass(frozen=True)
class Space:
    """Pivots and the squared length that all data vectors are brought to."""

    pivots: np.ndarray
    longest: float

    @property
    def slack(self) -> float:
        """More than the rounding of any distance."""
        return 1e-6 * float(np.sqrt(self.longest)) + 1e-9

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest - squares(x), 0.0))

    def of_data(self, x: np.ndarray) -> np.ndarray:
        """Distances of data vectors to all pivots."""
        p = self.pivots
        flat = squares(x)[:, None] + squares(p) - 2.0 * (x.astype(np.float64) @ p.astype(np.float64).T)
        return np.sqrt(np.maximum(flat + (self._lift(x)[:, None] - self._lift(p)) ** 2, 0.0))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries to all pivots."""
        near = q.astype(np.float64) @ self.pivots.astype(np.float64).T
        return np.sqrt(np.maximum(squares(q)[:, None] + self.longest - 2.0 * near, 0.0))

    def of_score(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a data vector has that inner product with the query."""
        return np.sqrt(np.maximum(squares(q) + self.longest - 2.0 * score.astype(np.float64), 0.0))


def _limited(rows: DataFrame, by: list, order: list, most: int) -> DataFrame:
    """The first ``most`` rows of every group; Spark drops the others before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= most)


def _closest(space: Space, width: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell the vectors of a task that are closest to its pivot."""
    kept = np.zeros((0, width), np.int64)
    for b in batches:
        kept = np.vstack([kept, matrix(b["x"], width)])
        d = space.of_data(kept)
        cell = d.argmin(1)
        own = d[np.arange(len(kept)), cell]
        order = np.lexsort((own, cell))
        start = np.searchsorted(cell[order], cell[order])
        kept = kept[order[np.arange(len(order)) - start < most]]
    if len(kept):
        d = space.of_data(kept)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1)),
                pa.ListArray.from_arrays(np.arange(len(kept) + 1, dtype=np.int32) * width, kept.reshape(-1)),
            ],
            ["cell", "distance", "x"],
        )


def _bars(space: Space, width: int, most: int, known: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell of every query, its score with itself, and the score that its ``most`` best reach at least."""
    for b in batches:
        q = matrix(b["x"], width)
        bar = np.full(len(q), _LEAST)
        if len(known) >= most:
            bar = np.partition(inner_products(q, known), len(known) - most, axis=1)[:, len(known) - most]
        own = [inner_products(v[None], v[None])[0, 0] for v in q]
        yield pa.RecordBatch.from_arrays(
            [b["qid"], b["x"], pa.array(space.of_queries(q).argmin(1).astype(np.int32)), pa.array(own, pa.int64()), pa.array(bar)],
            ["qid", "x", "cell", "own", "bar"],
        )


def _bounds(space: Space, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell of queries and pivot the distances between which data may matter, of one task."""
    p = len(space.pivots)
    low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
    for b in batches:
        q, cell, bar = matrix(b["x"], width), b["cell"].to_numpy(), b["bar"].to_numpy()
        reach = np.where(bar == _LEAST, np.inf, space.of_score(q, bar) + space.slack)[:, None]
        d = space.of_queries(q)
        np.minimum.at(low, cell, d - reach)
        np.maximum.at(high, cell, d + reach)
    at = np.flatnonzero(np.isfinite(high[:, :1]).ravel() | (high[:, 0] == np.inf))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(at, p).astype(np.int32)), pa.array(np.tile(np.arange(p, dtype=np.int32), len(at))),
            pa.array(low[at].reshape(-1)), pa.array(high[at].reshape(-1)),
        ],
        ["cell", "pivot", "low", "high"],
    )


def grouped_cells(counts: dict[int, int], pivots: np.ndarray, most: int) -> dict[int, tuple[int, int]]:
    """(first group, number of groups) of every cell: large cells are split, small ones join close ones."""
    places: dict[int, tuple[int, int]] = {}
    groups = 0
    left = dict(counts)
    for cell in sorted(counts, key=lambda c: (-counts[c], c)):
        if cell not in left:
            continue
        n = left.pop(cell)
        pieces = -(-n // most)
        places[cell] = (groups, pieces)
        if pieces == 1:
            to = squares(pivots[list(left)] - pivots[cell]) if left else np.zeros(0)
            for other in [list(left)[i] for i in np.argsort(to, kind="stable")]:
                if n + left[other] <= most:
                    n += left.pop(other)
                    places[other] = (groups, 1)
        groups += pieces
    return places


def _replicas(
    space: Space, width: int, low: np.ndarray, high: np.ndarray, places: dict[int, tuple[int, int]],
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """Every data row once for each group that may need it."""
    of_group: dict[tuple[int, int], list[int]] = {}
    for cell, place in places.items():
        of_group.setdefault(place, []).append(cell)
    for b in batches:
        d = space.of_data(matrix(b["x"], width))
        for (first, pieces), cells in of_group.items():
            needed = np.zeros(len(d), bool)
            for cell in cells:
                open_ = np.flatnonzero(~needed)
                needed[open_] = ((d[open_] >= low[cell]) & (d[open_] <= high[cell])).all(1)
            part = b.filter(pa.array(needed))
            for group in range(first, first + pieces):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, group, np.int64)), part["slice"], pa.array(np.ones(part.num_rows, np.int32)),
                     part["vec_id"], part["x"], pa.nulls(part.num_rows, pa.int64())],
                    ["group", "slice", "role", "id", "x", "bar"],
                )


class _Best:
    """The best rows of every query of a block, so far."""

    def __init__(self, queries: np.ndarray, bar: np.ndarray, most: int) -> None:
        self.queries, self.bar, self.most = queries, bar, most
        self.of, self.score, self.last, self.id = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, x: np.ndarray, ids: np.ndarray, last: np.ndarray) -> None:
        """``last``: 1 for rows without id, which come after all others of their score."""
        score = inner_products(self.queries, x)
        bar = self.bar
        if len(x) > self.most:
            bar = np.maximum(bar, np.partition(score, len(x) - self.most, axis=1)[:, len(x) - self.most])
        q, row = np.nonzero(score >= bar[:, None])
        of, score = np.append(self.of, q), np.append(self.score, score[q, row])
        last, id_ = np.append(self.last, last[row]), np.append(self.id, ids[row])
        order = np.lexsort((id_, last, ~score, of))
        rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
        kept = order[rank < self.most]
        self.of, self.score, self.last, self.id = of[kept], score[kept], last[kept], id_[kept]
        full = order[rank == self.most - 1]
        self.bar = self.bar.copy()
        self.bar[of[full]] = np.maximum(self.bar[of[full]], score[full])


def _solve(width: int, most: int, first: list[pa.RecordBatch], rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.Table.from_batches(first).combine_chunks().to_batches()[0]
    best = _Best(matrix(block["x"], width), block["bar"].to_numpy(), most)
    for b in rest:
        for at in range(0, b.num_rows, CHUNK):
            part = b.slice(at, CHUNK)
            missing = part["id"].is_null()
            best.add(
                matrix(part["x"], width), part["id"].fill_null(0).to_numpy(), missing.to_numpy(zero_copy_only=False).astype(np.int64)
            )
    ids = pa.array(best.id, mask=best.last == 1)
    yield pa.RecordBatch.from_arrays([block["id"].take(pa.array(best.of)), ids, pa.array(best.score)], ["qid", "vec_id", "score"])


def top_by_inner_product(
    rows: DataFrame, vector: str = "embedding", every: int = EVERY, top: int = TOP, scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` best other rows of each row whose vec_id ``every`` divides.

    ``rows``: vec_id and the vector; entries v count as floor(scale * v).
    """
    spark = rows.sparkSession
    most = top + 1
    x = whole_vectors(rows.select("vec_id", vector), vector, scale).select("vec_id", "x")
    first = x.select(F.size("x")).first()
    if first is None:
        return spark.createDataFrame([], _RESULT)
    width = first[0]
    same = _limited(x, [F.xxhash64("x"), "x"], [F.col("vec_id").asc_nulls_last()], most)
    data = stored(same.select("vec_id", "x", (F.col("_rank") == 1).alias("leader")))
    length = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    size = data.agg(F.count("*").alias("n"), F.max(length).alias("longest")).first()
    drawn = data.where("leader").orderBy(F.xxhash64("x", F.lit(12)), "x").limit(PIVOTS).toArrow()["x"]
    space = Space(matrix(drawn.combine_chunks(), width), size["longest"] * (1 + 1e-12))

    closest = data.select("x").mapInArrow(partial(_closest, space, width, most), "cell int, distance double, x array<bigint>")
    known = _limited(closest, ["cell"], ["distance", "x"], most).select("x").toArrow()["x"].combine_chunks()
    asked = x.where(F.col("vec_id") % every == 0)
    numbered = stored(asked.select("x").distinct().withColumn("qid", F.monotonically_increasing_id()))
    queries = stored(numbered.mapInArrow(
        partial(_bars, space, width, most, matrix(known, width)), "qid bigint, x array<bigint>, cell int, own bigint, bar bigint"
    ))
    discard(numbered)
    bounds = queries.select("x", "cell", "bar").mapInArrow(
        partial(_bounds, space, width), "cell int, pivot int, low double, high double"
    ).groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = (np.full((PIVOTS, len(space.pivots)), end) for end in (np.inf, -np.inf))
    at = bounds["cell"].to_numpy(), bounds["pivot"].to_numpy()
    low[at], high[at] = bounds["low"].to_numpy() - space.slack, bounds["high"].to_numpy() + space.slack
    counts = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    places = grouped_cells(counts, space.pivots, QUERIES)
    slices = min(MAX_SLICES, -(-size["n"] // SLICE_ROWS))

    replicas = data.select("vec_id", "x", F.pmod(F.xxhash64("vec_id", "x"), F.lit(slices)).alias("slice")).mapInArrow(
        partial(_replicas, space, width, low, high, places),
        "group bigint, slice bigint, role int, id bigint, x array<bigint>, bar bigint",
    )
    place = F.create_map(*[F.lit(v) for cell, p in places.items() for v in (cell, p[0])]) if places else F.create_map()
    pieces = F.create_map(*[F.lit(v) for cell, p in places.items() for v in (cell, p[1])]) if places else F.create_map()
    group = F.try_element_at(place, F.col("cell")) + F.pmod(F.xxhash64("qid"), F.try_element_at(pieces, F.col("cell")))
    blocks = queries.select(
        group.cast("bigint").alias("group"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))).alias("slice"),
        F.lit(0).alias("role"), F.col("qid").alias("id"), "x", "bar",
    )
    found = streamed(
        blocks.unionByName(replicas), ("group", "slice"), "role", partial(_solve, width, most), "qid bigint, vec_id bigint, score bigint"
    )
    merged = _limited(found, ["qid"], [F.col("score").desc(), F.col("vec_id").asc_nulls_last()], most)
    entry = F.struct(F.bitwise_not("score").alias("below"), F.col("vec_id").isNull().alias("last"), "vec_id")
    lists = merged.groupBy("qid").agg(F.sort_array(F.collect_list(entry)).alias("best"))
    answers = queries.join(lists, "qid").select("x", "own", "best")
    me = F.struct(F.bitwise_not("own").alias("below"), F.lit(False).alias("last"), F.col("vec_id"))
    own_place = F.array_position("best", me)
    others = F.slice(F.filter("best", lambda e, i: i + 1 != own_place), 1, top)
    return (
        asked.join(answers, "x").select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("place", "e"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.bitwise_not("e.below").alias("score"))
    )
