"""Score and outcome models as columns: baselines, Davidson, Poisson grid, Dixon-Coles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_frequencies(results: DataFrame, training: Column, group: Sequence[str] = ()) -> DataFrame:
    """Home, draw and away frequencies over the training window only."""
    h, a = F.col("home_goals"), F.col("away_goals")
    return results.filter(training).groupBy(*group).agg(
        F.count(F.lit(1)).alias("matches"),
        F.avg((h > a).cast("double")).alias("p_home"),
        F.avg((h == a).cast("double")).alias("p_draw"),
        F.avg((h < a).cast("double")).alias("p_away"),
    )


def goal_rates(results: DataFrame, training: Column, group: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Training-only scoring rates, optionally weighted (see ``decay_weight``)."""
    w = F.lit(1.0) if weight is None else weight
    return results.filter(training).groupBy(*group).agg(
        (F.sum(w * F.col("home_goals")) / F.sum(w)).alias("home_rate"),
        (F.sum(w * F.col("away_goals")) / F.sum(w)).alias("away_rate"),
    )


def davidson(home_strength: Column, away_strength: Column, home_advantage: float, nu: float) -> list[Column]:
    """1X2 probabilities from log strengths; ``nu`` is the draw intensity."""
    if nu < 0:
        raise ValueError("nu must be >= 0")
    x, y = F.exp(home_strength + F.lit(home_advantage)), F.exp(away_strength)
    tie = F.lit(nu) * F.sqrt(x * y)
    total = x + y + tie
    return [(x / total).alias("p_home"), (tie / total).alias("p_draw"), (y / total).alias("p_away")]


def poisson_mass(rate: Column, goals: int) -> Column:
    return F.exp(-rate) * F.pow(rate, F.lit(goals)) / F.lit(float(math.factorial(goals)))


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def dixon_coles_tau(lam: Column, mu: Column, rho: Column) -> dict[tuple[int, int], Column]:
    return {
        (0, 0): 1.0 - lam * mu * rho,
        (0, 1): 1.0 + lam * rho,
        (1, 0): 1.0 + mu * rho,
        (1, 1): 1.0 - rho,
    }


def score_model(
    fixtures: DataFrame, home_rate: str, away_rate: str, max_goals: int, line: float, rho: Column | None = None
) -> DataFrame:
    """1X2 and over/under from a score grid of 0..max_goals, renormalised.

    The grid is never laid out in rows: partial sums of the two marginal distributions give
    all totals inside one generated expression, and the low-score adjustment touches four
    cells. The mass
    outside the grid is reported as ``tail_mass``; ``valid`` is false where an adjusted
    cell would be negative. ``line`` has to be a half-goal line.
    """
    if line * 2 % 2 != 1:
        raise ValueError("line must be a half-goal line")
    lam, mu = F.col(home_rate), F.col(away_rate)
    goals = range(max_goals + 1)
    base = fixtures.select(
        "*",
        *[poisson_mass(lam, g).alias(f"_h{g}") for g in goals],
        *[poisson_mass(mu, g).alias(f"_a{g}") for g in goals],
    )
    h, a = [F.col(f"_h{g}") for g in goals], [F.col(f"_a{g}") for g in goals]
    home = _sum([h[g] * _sum(a[:g]) for g in goals])
    away = _sum([a[g] * _sum(h[:g]) for g in goals])
    draw = _sum([h[g] * a[g] for g in goals])
    under = _sum([h[g] * _sum(a[: int(line) + 1 - g]) for g in goals if g < line])
    cells = {(x, y): h[x] * a[y] for x in (0, 1) for y in (0, 1)}
    valid = F.lit(True)
    if rho is not None:
        for (x, y), tau in dixon_coles_tau(lam, mu, rho).items():
            change = cells[(x, y)] * (tau - 1.0)
            home = home + change if x > y else home
            away = away + change if x < y else away
            draw = draw + change if x == y else draw
            under = under + change if x + y < line else under
            valid = valid & (tau >= 0)
    raw = base.select(
        *fixtures.columns, home.alias("_home"), draw.alias("_draw"), away.alias("_away"),
        under.alias("_under"), valid.alias("valid"),
    )
    mass = F.col("_home") + F.col("_draw") + F.col("_away")
    return raw.select(
        *fixtures.columns,
        (F.col("_home") / mass).alias("p_home"),
        (F.col("_draw") / mass).alias("p_draw"),
        (F.col("_away") / mass).alias("p_away"),
        (F.col("_under") / mass).alias("p_under"),
        (1.0 - F.col("_under") / mass).alias("p_over"),
        (1.0 - mass).alias("tail_mass"),
        "valid",
    )


def score_grid(fixtures: DataFrame, home_rate: str, away_rate: str, max_goals: int) -> DataFrame:
    """Row form of the grid, one row per score, for reports on chosen fixtures."""
    goals = F.sequence(F.lit(0), F.lit(max_goals))
    laid = fixtures.select("*", F.explode(goals).alias("x")).select("*", F.explode(goals).alias("y"))
    lam, mu = F.col(home_rate), F.col(away_rate)
    mass = (
        F.exp(-lam - mu) * F.pow(lam, F.col("x")) * F.pow(mu, F.col("y"))
        / (F.factorial("x") * F.factorial("y"))
    )
    return laid.withColumn("p", mass)
