"""Isotonic calibration without a pooling task.

Pooling adjacent violators gives the slopes of the greatest convex minorant of the points (sum of weights,
sum of weighted labels) in the order of the scores. Two properties let it run on any number of tasks:

* A minorant can be merged: a corner of the whole is a corner of every block that holds it. So each block of scores
  keeps the corners of its own points only.
* For any level c, the point with the least (labels - c * weights) is a corner of the whole, and the fit is below c
  before it and above c behind it. One aggregate finds these points for many levels at once; between
  two of them the minorant is found on its own.

Cuts are made again inside the pieces that are still large, at finer levels, until every piece is small enough to be solved in
one task. Nothing depends on how the scores are distributed, and no step sees all corners.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knownby.operators.scans import carried_through, depth_blocks
from knownby.storage import removed, written

#: Corners that one task solves; levels per cut; cuts of the label range at most.
PIECE, LEVELS, CUTS = 65_536, 16, 12
BLOCK_ROWS = 65_536
_POINT = "block bigint, score double, w double, s double"


def lower_corners(w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Places of the corners of the greatest convex minorant of points in order of ``w``."""
    kept: list[int] = []
    for i in range(len(w)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (s[b] - s[a]) * (w[i] - w[b]) < (s[i] - s[b]) * (w[b] - w[a]):
                break
            kept.pop()
        kept.append(i)
    return np.array(kept, np.int64)


def _corners_by(key: str):
    """Of rows in order of ``key`` and w, the corners of every key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved() -> Iterator[pa.RecordBatch]:
            if held:
                part = pa.Table.from_batches(held).combine_chunks()
                kept = lower_corners(part["w"].to_numpy(), part["s"].to_numpy())
                yield from part.take(pa.array(kept)).to_batches()
            held.clear()

        now = None
        for b in batches:
            keys = b[key].to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1) if len(keys) else []
            for at, end in zip(starts, np.append(starts[1:], len(keys))):
                if keys[at] != now:
                    yield from solved()
                    now = keys[at]
                held.append(b.slice(at, end - at))
        yield from solved()

    return run


def score_points(rows: DataFrame, score: str, label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """block, score, w, s: one row per distinct score with the sums up to it, and the block it lies in."""
    merged = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).cast("double").alias("_w"), F.sum(F.col(label).cast("double")).alias("_s")
    )
    blocked = depth_blocks(merged, [], "score", block_rows)
    return carried_through(blocked, [], "block", "score", {"w": ("_w", "sum"), "s": ("_s", "sum")}).select(
        F.col("block").cast("bigint").alias("block"), "score", "w", "s"
    )


def _cut(corners: DataFrame, low: float, high: float, level: int) -> DataFrame:
    """``corners`` (piece, w, s) with pieces cut at LEVELS levels: a point that ends a piece and begins another is in both.

    Levels that meet in one point have only that point between them, and so no step; those pieces are left out.
    """
    step = (high - low) / LEVELS**level
    # A piece between two levels of the last cut knows which levels lie between them.
    at = [F.lit(low) + (F.col("piece") * LEVELS + k) * step for k in range(1, LEVELS)]
    best = corners.groupBy("piece").agg(*[
        F.min(F.struct((F.col("s") - c * F.col("w")).alias("v"), F.col("w").alias("w")))["w"].alias(f"c{k}") for k, c in enumerate(at, 1)
    ])
    placed = corners.join(best, "piece")
    ends = [F.col(f"c{k}") for k in range(1, LEVELS)]
    first = sum(((F.col("w") > e).cast("bigint") for e in ends), F.lit(0).cast("bigint"))
    last = sum(((F.col("w") >= e).cast("bigint") for e in ends), F.lit(0).cast("bigint"))
    return placed.select(
        F.explode(F.array_distinct(F.array(F.col("piece") * LEVELS + first, F.col("piece") * LEVELS + last))).alias("piece"), "w", "s"
    )


def fit_isotonic(calibration: DataFrame, score: str, label: str, piece: int = PIECE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """value, from_score, to_score, weight: the steps of the isotonic fit, rising with the score.

    Rows without score or label are left out; without any row there is no step.
    """
    points = written(score_points(calibration, score, label, block_rows))
    corners = points.repartition("block").sortWithinPartitions("block", "w").mapInArrow(_corners_by("block"), _POINT)
    start = calibration.sparkSession.createDataFrame([(0.0, 0.0)], "w double, s double")
    now = corners.select("w", "s").union(start).withColumn("piece", F.lit(0).cast("bigint"))
    ends = calibration.agg(F.min(F.col(label).cast("double")).alias("low"), F.max(F.col(label).cast("double")).alias("high")).first()
    low, high = ends["low"] or 0.0, ends["high"] or 0.0
    kept: list[DataFrame] = []
    small = None
    for level in range(1, CUTS + 2):
        sized = written(now.join(now.groupBy("piece").agg(F.count(F.lit(1)).alias("points")), "piece"))
        kept.append(sized)
        large = sized.where(F.col("points") > piece)
        last = level > CUTS or high == low or large.isEmpty()
        part = sized.where((F.col("points") > 1) & (F.lit(last) | (F.col("points") <= piece))).withColumn("level", F.lit(level))
        small = part if small is None else small.union(part)
        if last:
            break
        now = _cut(large, low, high, level)
    # Pieces of a level are below LEVELS ** CUTS = 2 ** 48.
    solved = small.select((F.col("level") * 2**50 + F.col("piece")).cast("bigint").alias("piece"), "w", "s").repartition("piece").sortWithinPartitions(
        "piece", "w"
    ).mapInArrow(_corners_by("piece"), "piece bigint, w double, s double")
    before = Window.partitionBy("piece").orderBy("w")
    steps = solved.withColumns({"_w": F.lag("w").over(before), "_s": F.lag("s").over(before)}).where("_w is not null")
    edges = written(steps.select(((F.col("s") - F.col("_s")) / (F.col("w") - F.col("_w"))).alias("value"), "w", (F.col("w") - F.col("_w")).alias("weight")))
    for t in kept:
        removed(t)
    # Each step begins at the first score behind the corner before it.
    marked = points.join(edges, "w", "left").select("block", "score", (-F.col("score")).alias("_back"), (-F.col("block")).alias("_from_end"), "value", "weight")
    named = carried_through(
        marked.withColumn("_step", F.when(F.col("value").isNotNull(), F.struct("value", "weight", F.col("score").alias("to_score")))),
        [], "_from_end", "_back", {"_own": ("_step", "last")},
    )
    return named.groupBy(F.col("_own.value").alias("value"), F.col("_own.to_score").alias("to_score"), F.col("_own.weight").alias("weight")).agg(
        F.min("score").alias("from_score")
    ).select("value", "from_score", "to_score", "weight")


def apply_isotonic(steps: DataFrame, rows: DataFrame, score: str, out: str, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``out``: the step that holds the score; between two steps on the line between their ends; beyond all, the nearest.

    ``order``: columns that tell rows apart. Rows and steps lie on one line of scores, so no row is compared with
    all steps. A row without score has none.
    """
    x = F.col(score).cast("double")
    step = F.struct("from_score", "to_score", "value")
    stacked = rows.where(F.col(score).isNotNull()).select(
        x.alias("_x"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"), F.lit(None).cast(steps.select(step.alias("s")).schema[0].dataType).alias("_step"),
        F.xxhash64(*order).alias("_id"),
    ).unionByName(steps.select(
        F.col("from_score").alias("_x"), F.lit(0).alias("_kind"), F.lit(None).cast(rows.select(F.struct(*rows.columns).alias("r")).schema[0].dataType).alias("_row"),
        step.alias("_step"), F.lit(0).cast("bigint").alias("_id"),
    ))
    blocked = depth_blocks(stacked, [], "_x", block_rows)
    ahead = carried_through(blocked, [], "block", ["_x", "_kind", "_id"], {"_low": ("_step", "last")})
    turned = ahead.select("*", (-F.col("block")).alias("_end"), (-F.col("_x")).alias("_rx"), (-F.col("_kind")).alias("_rk"))
    both = carried_through(turned, [], "_end", ["_rx", "_rk", "_id"], {"_high": ("_step", "last")}).where("_kind = 1")
    low, high, at = F.col("_low"), F.col("_high"), F.col("_x")
    between = low["value"] + (high["value"] - low["value"]) * (at - low["to_score"]) / (high["from_score"] - low["to_score"])
    value = (
        F.when(low.isNull(), high["value"]).when(at <= low["to_score"], low["value"]).when(high.isNull(), low["value"]).otherwise(between)
    )
    found = both.select("_row.*", value.alias(out))
    return found.unionByName(rows.where(F.col(score).isNull()).withColumn(out, F.lit(None).cast("double")))
