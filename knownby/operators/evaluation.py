"""Forecast metrics, reliability, agreement and paired bootstrap intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def binary_scores(forecasts: DataFrame, p: str, y: str, group: Sequence[str], floor: float) -> DataFrame:
    """Sample size, log loss and Brier score. ``floor`` keeps the logarithm finite."""
    clipped = F.least(F.greatest(F.col(p), F.lit(floor)), F.lit(1.0 - floor))
    loss = F.when(F.col(y) == 1, -F.log(clipped)).otherwise(-F.log(1.0 - clipped))
    return forecasts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(loss).alias("log_loss"),
        F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"),
    )


def reliability(forecasts: DataFrame, p: str, y: str, group: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins: count, mean forecast, observed rate. 1.0 falls in the last bin."""
    b = F.least(F.floor(F.col(p) * bins).cast("int"), F.lit(bins - 1))
    return forecasts.groupBy(*group, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_forecast"), F.avg(F.col(y).cast("double")).alias("observed_rate")
    )


def expected_calibration_error(table: DataFrame, group: Sequence[str]) -> DataFrame:
    gap = F.abs(F.col("mean_forecast") - F.col("observed_rate")) * F.col("n")
    return table.groupBy(*group).agg((F.sum(gap) / F.sum("n")).alias("ece"))


def outcome_scores(forecasts: DataFrame, group: Sequence[str], floor: float) -> DataFrame:
    """1X2 log loss, Brier and ranked probability score; ``outcome`` is HOME, DRAW or AWAY."""
    names = ("HOME", "DRAW", "AWAY")
    p = {n: F.col(f"p_{n.lower()}") for n in names}
    hit = {n: (F.col("outcome") == n).cast("double") for n in names}
    own = F.when(F.col("outcome") == "HOME", p["HOME"]).when(F.col("outcome") == "DRAW", p["DRAW"]).otherwise(p["AWAY"])
    brier = sum((F.pow(p[n] - hit[n], 2) for n in names), F.lit(0.0))
    first = p["HOME"] - hit["HOME"]
    second = first + p["DRAW"] - hit["DRAW"]
    return forecasts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(-F.log(F.greatest(own, F.lit(floor)))).alias("log_loss"),
        F.avg(brier).alias("brier"),
        F.avg((F.pow(first, 2) + F.pow(second, 2)) / 2.0).alias("rps"),
    )


def agreement(forecasts: DataFrame, fixture: Sequence[str], p: str) -> DataFrame:
    """Spread of several models' probabilities for the same fixture."""
    return forecasts.groupBy(*fixture).agg(
        F.count(F.lit(1)).alias("models"),
        F.stddev_pop(p).alias("p_stddev"),
        (F.max(p) - F.min(p)).alias("p_spread"),
        F.avg(p).alias("p_mean"),
    )


def error_by_agreement(agreed: DataFrame, outcomes: DataFrame, fixture: Sequence[str], edges: Sequence[float]) -> DataFrame:
    """Realised Brier error per bucket of model spread; the bucket edges are the caller's."""
    bucket = F.lit(0)
    for i, edge in enumerate(edges, start=1):
        bucket = F.when(F.col("p_spread") >= edge, i).otherwise(bucket)
    return agreed.join(outcomes, list(fixture)).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("fixtures"), F.avg(F.pow(F.col("p_mean") - F.col("y"), 2)).alias("brier")
    )


def _poisson_one() -> tuple[float, ...]:
    """P(Poisson(1) <= k) for k = 0, 1, ... up to where doubles reach 1."""
    found, term = [], math.exp(-1.0)
    while not found or found[-1] < 1.0 and term > 0.0:
        found.append(math.fsum([*found[-1:], term]))
        term /= len(found)
        if len(found) > 1 and found[-1] == found[-2]:
            found.pop()
            break
    return tuple(found)


POISSON_ONE = _poisson_one()


def poisson_weight(unit: Column, replicate: Column, seed: int) -> Column:
    """Bootstrap weight of a unit in a replicate, fixed by (unit, replicate, seed).

    The uniform number is the first 52 bits of an md5 digest, which other engines have too.
    """
    return poisson_quantile(uniform_number(unit, replicate, seed))


def uniform_number(unit: Column, replicate: Column, seed: int) -> Column:
    digest = F.md5(F.concat_ws(":", unit.cast("string"), replicate.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_quantile(u: Column) -> Column:
    weight = F.lit(len(POISSON_ONE))
    for k in range(len(POISSON_ONE) - 1, -1, -1):
        weight = F.when(u < POISSON_ONE[k], k).otherwise(weight)
    return weight


def paired_bootstrap(
    losses: DataFrame, unit: str, loss_a: str, loss_b: str, replicates: int, seed: int, level: float,
    group: Sequence[str] = (),
) -> DataFrame:
    """Interval of the mean loss difference on identical rows, resampled by ``unit``.

    Rows are first summed per unit; replicates are then expanded and summed inside the map
    tasks, so only (group, replicate) sums are shuffled.
    """
    by = list(group) or ["_all"]
    if not group:
        losses = losses.withColumn("_all", F.lit(0))
    per_unit = losses.groupBy(*by, unit).agg(
        F.sum(F.col(loss_a) - F.col(loss_b)).alias("d"), F.count(F.lit(1)).alias("n")
    )
    expanded = per_unit.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    # Generated, so that the digest is computed once per unit and replicate and not per branch and sum.
    drawn = F.struct(uniform_number(F.col(unit), F.col("replicate"), seed).alias("u"))
    expanded = expanded.select(*by, "replicate", "d", "n", F.inline(F.array(drawn)))
    w = poisson_quantile(F.col("u"))
    means = expanded.groupBy(*by, "replicate").agg(
        F.try_divide(F.sum(w * F.col("d")), F.sum(w * F.col("n"))).alias("m")
    )
    tail = (1.0 - level) / 2.0
    interval = means.groupBy(*by).agg(
        F.percentile("m", F.lit(tail)).alias("low"), F.percentile("m", F.lit(1.0 - tail)).alias("high")
    )
    point = per_unit.groupBy(*by).agg(
        (F.sum("d") / F.sum("n")).alias("mean_difference"), F.sum("n").alias("sample_size"),
        F.count(F.lit(1)).alias("units"),
    )
    return point.join(interval, by).drop("_all").withColumn("seed", F.lit(seed))
