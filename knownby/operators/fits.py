"""Likelihood fits in rounds of one combinable aggregate each.

A logistic fit needs, per round, the gradient and the Hessian of its few coefficients: sums over the rows, which the map
tasks combine. The driver solves the small system. Goal rates have two coefficients per team; those stay
tables, and each round scales them until expected goals equal scored ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.storage import removed, written


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients (class x (1 + features), the last class all zero), rounds run, largest gradient entry per row."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    rounds: int
    gradient: float

    def probabilities(self) -> list[Column]:
        return _softmax(self.features, self.coefficients)


def _softmax(features: Sequence[str], beta: np.ndarray) -> list[Column]:
    scores = []
    for row in beta:
        score = F.lit(float(row[0]))
        for b, name in zip(row[1:], features):
            score = score + F.lit(float(b)) * F.col(name)
        scores.append(score)
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def fit_logistic(
    training: DataFrame, features: Sequence[str], label: str, classes: int, ridge: float = 0.0, rounds: int = 25,
    tolerance: float = 1e-10,
) -> LogisticFit:
    """Multinomial logistic regression by Newton's method (iteratively reweighted least squares).

    ``label``: 0 to ``classes`` - 1. ``ridge`` times half the squared slopes (not intercepts) is added to the mean loss. Rows with a
    null feature or label are left out. A step that does not lower the loss is halved. Stops once no entry of
    the mean gradient is above ``tolerance``, or after ``rounds``.
    """
    names = tuple(features)
    width, free = len(names) + 1, classes - 1
    used = training.select(*[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("int").alias("_y"))
    # Every round reads the rows again: they are written once, not derived anew each time.
    used = written(used.where(" and ".join(f"`{c}` is not null" for c in [*names, "_y"])))
    x = [F.lit(1.0), *[F.col(c) for c in names]]
    decay = np.tile(np.append(0.0, np.full(width - 1, ridge)), free)

    def sums(beta: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
        with_p = used.select("*", *[p.alias(f"_p{k}") for k, p in enumerate(_softmax(names, beta))])
        p = [F.col(f"_p{k}") for k in range(classes)]
        hit = [(F.col("_y") == k).cast("double") for k in range(free)]
        own = F.element_at(F.array(*p), F.col("_y") + 1)
        parts = {"n": F.count(F.lit(1)), "loss": F.sum(-F.ln(F.greatest(own, F.lit(1e-300))))}
        for k in range(free):
            for i in range(width):
                parts[f"g{k}_{i}"] = F.sum((p[k] - hit[k]) * x[i])
        for k in range(free):
            for m in range(k, free):
                weight = p[k] * ((1.0 if k == m else 0.0) - p[m])
                for i in range(width):
                    for j in range(i, width):
                        parts[f"h{k}_{m}_{i}_{j}"] = F.sum(weight * x[i] * x[j])
        got = with_p.agg(*[c.alias(n) for n, c in parts.items()]).first().asDict()
        n = got["n"]
        if not n:
            return 0, 0.0, np.zeros(free * width), np.eye(free * width)
        flat = beta[:free].reshape(-1)
        gradient = np.array([got[f"g{k}_{i}"] for k in range(free) for i in range(width)]) / n + decay * flat
        hessian = np.zeros((free, width, free, width))
        for k in range(free):
            for m in range(k, free):
                for i in range(width):
                    for j in range(i, width):
                        value = got[f"h{k}_{m}_{i}_{j}"] / n
                        hessian[k, i, m, j] = hessian[k, j, m, i] = hessian[m, i, k, j] = hessian[m, j, k, i] = value
        return n, got["loss"] / n + float(decay @ flat**2) / 2, gradient, hessian.reshape(free * width, -1) + np.diag(decay)

    beta = np.zeros((classes, width))
    n, loss, gradient, hessian = sums(beta)
    done = 0
    while n and done < rounds and np.abs(gradient).max() > tolerance:
        done += 1
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0].reshape(free, width)
        for _ in range(30):
            after = beta.copy()
            after[:free] -= step
            found = sums(after)
            if found[1] <= loss + 1e-12 * max(1.0, abs(loss)):
                break
            step = step / 2
        else:
            break
        beta, (n, loss, gradient, hessian) = after, found
    removed(used)
    return LogisticFit(names, beta, done, float(np.abs(gradient).max()))


def outcome_probabilities(fit: LogisticFit, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with the probability of every class, by ``names``."""
    return rows.select(*rows.columns, *[p.alias(n) for n, p in zip(names, fit.probabilities())])


def fit_platt(calibration: DataFrame, score: str, label: str, rounds: int = 25) -> LogisticFit:
    """Probability of label 1 as a logistic function of the score."""
    return fit_logistic(calibration.withColumn("_not", 1 - F.col(label)), [score], "_not", 2, rounds=rounds)


def apply_platt(fit: LogisticFit, rows: DataFrame, out: str) -> DataFrame:
    return rows.select(*rows.columns, fit.probabilities()[0].alias(out))


# ---- goal rates -------------------------------------------------------------------------


@dataclass(frozen=True)
class GoalRates:
    """Tables of (group, team, attack, goals_for, expected_for), (group, team, defence, goals_against, expected_against), (group, home).

    A side's rate is attack * defence of the other side, times home for the home side.
    """

    group: tuple[str, ...]
    attack: DataFrame
    defence: DataFrame
    home: DataFrame


def _pairs(matches: DataFrame, group: Sequence[str], weight: str | None) -> DataFrame:
    """One row per group, attacking team, defending team and venue: all that the likelihood needs of the matches."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    sides = F.array(
        F.struct(F.col("home_team").alias("a"), F.col("away_team").alias("d"), F.lit(1).alias("at_home"), F.col("home_goals").alias("goals")),
        F.struct(F.col("away_team").alias("a"), F.col("home_team").alias("d"), F.lit(0).alias("at_home"), F.col("away_goals").alias("goals")),
    )
    rows = matches.where("home_team is not null and away_team is not null and home_goals is not null and away_goals is not null")
    return rows.select(*group, w.alias("w"), F.inline(sides)).groupBy(*group, "a", "d", "at_home").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("goals")).alias("goals")
    )


def fit_goal_rates_by_scaling(matches: DataFrame, group: Sequence[str], rounds: int, weight: str | None = None) -> GoalRates:
    """Poisson rates of every group by ``rounds`` rounds of alternating scaling.

    Matches are first summed per pair of teams and venue, so a round reads as many rows as there are pairs. In a round
    every attack is scaled until the team's expected goals are those it scored, then every defence, then the home factor. Each
    scaling solves its score equations given the others, so the likelihood never falls; ``expected_for`` and
    ``expected_against`` against the goals show how far the last round is from the maximum. A team that never
    scored has attack 0.
    """
    group = list(group)
    pairs = written(_pairs(matches, group, weight))
    attack = pairs.select(*group, F.col("a").alias("team")).distinct().withColumn("attack", F.lit(1.0))
    defence = pairs.select(*group, F.col("d").alias("team")).distinct().withColumn("defence", F.lit(1.0))
    home = pairs.select(*group).distinct().withColumn("home", F.lit(1.0)) if group else pairs.limit(1).select(F.lit(1.0).alias("home"))
    kept: list[DataFrame] = []

    def with_(rows: DataFrame, *tables: str) -> DataFrame:
        """``rows`` of pairs with the present parameters."""
        if "attack" in tables:
            rows = rows.join(attack.withColumnRenamed("team", "a"), [*group, "a"])
        if "defence" in tables:
            rows = rows.join(defence.withColumnRenamed("team", "d"), [*group, "d"])
        factors = home.select(*group, "home")
        return rows.join(factors, group) if group else rows.crossJoin(F.broadcast(factors))

    def ratio(goals: str, expected: str) -> Column:
        return F.when(F.col(expected) > 0, F.col(goals) / F.col(expected)).otherwise(F.lit(0.0))

    played = F.col("n") * F.when(F.col("at_home") == 1, F.col("home")).otherwise(1.0)
    for _ in range(rounds):
        by_a = with_(pairs, "defence").groupBy(*group, F.col("a").alias("team")).agg(
            F.sum("goals").alias("goals_for"), F.sum(played * F.col("defence")).alias("open")
        )
        attack = written(by_a.select(*group, "team", ratio("goals_for", "open").alias("attack")))
        by_d = with_(pairs, "attack").groupBy(*group, F.col("d").alias("team")).agg(
            F.sum("goals").alias("goals_against"), F.sum(played * F.col("attack")).alias("open")
        )
        defence = written(by_d.select(*group, "team", ratio("goals_against", "open").alias("defence")))
        at_home = with_(pairs.where("at_home = 1"), "attack", "defence").groupBy(*group).agg(
            F.sum("goals").alias("goals"), F.sum(F.col("n") * F.col("attack") * F.col("defence")).alias("open")
        )
        home = written(at_home.select(*group, ratio("goals", "open").alias("home")))
        kept.append((attack, defence, home))
        for old in kept[-2] if len(kept) > 1 else ():
            removed(old)
    expected = with_(pairs, "attack", "defence").withColumn("rate", played * F.col("attack") * F.col("defence"))

    def finished(table: DataFrame, side: str, what: str) -> DataFrame:
        sums = expected.groupBy(*group, F.col(side).alias("team")).agg(
            F.sum("goals").alias(f"goals_{what}"), F.sum("rate").alias(f"expected_{what}")
        )
        return table.join(sums, [*group, "team"])

    return GoalRates(tuple(group), finished(attack, "a", "for"), finished(defence, "d", "against"), home)


def predict_goal_rates_by_scaling(fit: GoalRates, matches: DataFrame) -> DataFrame:
    """(match_id, home_rate, away_rate) of the matches whose teams were both fitted."""
    group = list(fit.group)
    attack = fit.attack.select(*group, "team", "attack").join(fit.defence.select(*group, "team", "defence"), [*group, "team"])

    def side(name: str) -> DataFrame:
        return attack.select(
            *group, F.col("team").alias(f"{name}_team"), F.col("attack").alias(f"_{name}_attack"), F.col("defence").alias(f"_{name}_defence")
        )

    rows = matches.join(side("home"), [*group, "home_team"]).join(side("away"), [*group, "away_team"])
    rows = rows.join(fit.home.select(*group, "home"), group) if group else rows.crossJoin(F.broadcast(fit.home))
    return rows.select(
        "match_id", (F.col("_home_attack") * F.col("_away_defence") * F.col("home")).alias("home_rate"),
        (F.col("_away_attack") * F.col("_home_defence")).alias("away_rate"),
    )
