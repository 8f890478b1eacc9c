from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knownby.operators import calibration, evaluation, fits, models, scoring
from knownby.operators.ratings import elo_ratings


def test_elo_equals_a_plain_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice("AB"), i, f"2024-01-{1 + i // 10:02d}", *rng.sample(["t1", "t2", "t3", "t4"], 2), rng.randrange(4), rng.randrange(4)) for i in range(200)]
    df = spark.createDataFrame(rows, "competition string, match_id long, event_time string, home_team string, away_team string, home_goals int, away_goals int")
    found = {r.match_id: r for r in elo_ratings(df.repartition(5), 1500.0, 24.0, 50.0, 400.0).collect()}
    table: dict = {}
    for c, i, _, h, a, hg, ag in rows:
        rh, ra = table.get((c, h), 1500.0), table.get((c, a), 1500.0)
        assert (found[i].home_rating, found[i].away_rating) == (rh, ra)
        e = 1 / (1 + 10 ** (-(rh + 50.0 - ra) / 400.0))
        s = 1.0 if hg > ag else 0.5 if hg == ag else 0.0
        assert math.isclose(found[i].expected, e)
        table[c, h], table[c, a] = rh + 24.0 * (s - e), ra - 24.0 * (s - e)


def test_bootstrap_uses_its_own_fixed_weights(spark):
    rows = [(i % 40, 0.1 * (i % 7), 0.05 * (i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "u long, a double, b double")
    weights = df.select("u").distinct().select("u", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("r"))
    w = {(x.u, x.r): x.w for x in weights.select("u", "r", evaluation.poisson_weight(F.col("u"), F.col("r"), 9).alias("w")).collect()}
    assert abs(sum(w.values()) / len(w) - 1.0) < 0.1
    means = []
    for r in range(1, 31):
        means.append(sum(w[u, r] * (a - b) for u, a, b in rows) / sum(w[u, r] for u, _, _ in rows))
    means.sort()

    def at(q):
        k = q * (len(means) - 1)
        low = int(k)
        return means[low] + (k - low) * (means[min(low + 1, len(means) - 1)] - means[low])

    got = evaluation.paired_bootstrap(df, "u", "a", "b", 30, 9, 0.8).first()
    assert math.isclose(got.low, at(0.1), abs_tol=1e-9) and math.isclose(got.high, at(0.9), abs_tol=1e-9)
    assert (got.sample_size, got.units) == (200, 40)


def test_score_model_measures_its_tail(spark):
    df = spark.createDataFrame([(1.4, 1.1), (3.0, 0.2)], "l double, m double")
    for r in scoring.score_model(df, "l", "m", 6, 2.5).collect():
        pmf = lambda x, k: math.exp(-x) * x**k / math.factorial(k)
        mass = sum(pmf(r.l, i) * pmf(r.m, j) for i in range(7) for j in range(7))
        under = sum(pmf(r.l, i) * pmf(r.m, j) for i in range(3) for j in range(3) if i + j < 2.5) / mass
        assert math.isclose(r.tail_mass, 1 - mass, abs_tol=1e-12) and math.isclose(r.p_under, under)
        assert math.isclose(r.p_home + r.p_draw + r.p_away, 1.0)
    bad = scoring.score_model(df, "l", "m", 6, 2.5, rho=F.lit(0.9)).collect()
    assert [r.valid for r in bad] == [False, True]


def test_fitted_models(spark):
    rng = random.Random(4)
    teams = [f"t{i}" for i in range(6)]
    rows = [(i, *rng.sample(teams, 2), rng.randrange(4), rng.randrange(3), rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "match_id long, home_team string, away_team string, home_goals int, away_goals int, x double")
    rates = models.predict_goal_rates(models.fit_goal_rates(df, 0.01), df)
    assert rates.count() == 200 and rates.filter("home_rate <= 0 or away_rate <= 0").count() == 0
    labelled = df.withColumn("label", (F.col("match_id") % 3).cast("double")).select("match_id", "x", "label")
    logit = models.outcome_probabilities(models.fit_outcome_logistic(labelled, ["x"], "label", 0.1), labelled, ["a", "b", "c"])
    boost = models.boosting_probabilities(models.fit_outcome_boosting(labelled, ["x"], "label", 3, 2, 2, 1), labelled, ["a", "b", "c"])
    for made in (logit, boost):
        assert made.filter("abs(a + b + c - 1) > 1e-9").count() == 0


def pooled(rows):
    """Pool adjacent violators over (score, label): value, from, to, weight."""
    by_score: dict = {}
    for x, y in rows:
        by_score.setdefault(x, []).append(y)
    stack: list = []
    for x in sorted(by_score):
        stack.append([sum(by_score[x]), len(by_score[x]), x, x])
        while len(stack) > 1 and stack[-2][0] * stack[-1][1] >= stack[-1][0] * stack[-2][1]:
            s, w, _, to = stack.pop()
            stack[-1] = [stack[-1][0] + s, stack[-1][1] + w, stack[-1][2], to]
    return [(s / w, a, b, float(w)) for s, w, a, b in stack]


@pytest.mark.parametrize("n, piece, block_rows", [(1, 10, 10), (300, 1000, 1000), (2000, 60, 100), (2000, 4, 50)])
def test_isotonic_steps_are_those_of_pooling(spark, n, piece, block_rows):
    rng = random.Random(n + piece)
    rows = [(x, int(rng.random() < x)) for x in (rng.randrange(n) / n for _ in range(n))]
    df = spark.createDataFrame([*rows, (None, 1), (0.5, None)], "x double, y int")
    steps = sorted(tuple(r) for r in calibration.fit_isotonic(df, "x", "y", piece, block_rows).collect())
    assert [s[1:] for s in steps] == [w[1:] for w in pooled(rows)]
    assert all(math.isclose(s[0], w[0], abs_tol=1e-12) for s, w in zip(steps, pooled(rows)))


def test_isotonic_is_applied_between_and_beyond_its_steps(spark):
    steps = spark.createDataFrame([(0.1, 1.0, 2.0), (0.5, 4.0, 4.0), (0.9, 8.0, 9.0)], "value double, from_score double, to_score double")
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([0.0, 1.0, 1.5, 3.0, 4.0, 5.0, 8.5, 99.0, None])], "i long, x double")
    for block_rows in (100, 2):
        got = {r.i: r.p for r in calibration.apply_isotonic(steps, rows, "x", "p", ["i"], block_rows).collect()}
        want = [0.1, 0.1, 0.1, 0.3, 0.5, 0.6, 0.9, 0.9]
        assert got[8] is None and all(math.isclose(got[i], w) for i, w in enumerate(want))
    assert calibration.apply_isotonic(steps.limit(0), rows, "x", "p", ["i"]).filter("p is not null").count() == 0


def test_isotonic_without_rows_and_of_one_label(spark):
    df = spark.createDataFrame([], "x double, y int")
    assert calibration.fit_isotonic(df, "x", "y").count() == 0
    same = spark.createDataFrame([(float(i), 1) for i in range(30)], "x double, y int")
    assert [tuple(r) for r in calibration.fit_isotonic(same, "x", "y", 4, 5).collect()] == [(1.0, 0.0, 29.0, 30.0)]


def test_logistic_fit_reaches_the_maximum(spark):
    rng = random.Random(6)
    rows = [(rng.gauss(0, 1), rng.gauss(5, 20), rng.randrange(3)) for _ in range(400)]
    rows = [(a, b, 0 if a > 1 else y) for a, b, y in rows]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), (1.0, 1.0, None)], "a double, b double, y int")
    for ridge in (0.0, 0.3):
        fit = fits.fit_logistic(df, ["a", "b"], "y", 3, ridge)
        assert fit.gradient < 1e-10 and fit.rounds < 20
        x = np.array([[1.0, a, b] for a, b, _ in rows])
        z = x @ fit.coefficients.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gap = ((p - np.eye(3)[[y for *_, y in rows]]).T @ x / len(rows))[:2] + ridge * fit.coefficients[:2] * [0, 1, 1]
        assert np.abs(gap).max() < 1e-9
    made = fits.outcome_probabilities(fit, df.filter("a is not null"), ["h", "d", "w"])
    assert made.filter("abs(h + d + w - 1) > 1e-12").count() == 0
    assert fits.fit_logistic(df.limit(0), ["a"], "y", 3).rounds == 0


def test_platt_rises_with_the_score(spark):
    rng = random.Random(8)
    y = spark.createDataFrame([(x, int(rng.random() < x)) for x in (rng.random() for _ in range(300))], "x double, y int")
    fit = fits.fit_platt(y, "x", "y")
    got = fits.apply_platt(fit, y, "p").orderBy("x").collect()
    assert got[0].p < 0.5 < got[-1].p and abs(sum(r.p for r in got) - sum(r.y for r in got)) < 1e-6


def test_scaled_goal_rates_solve_the_score_equations(spark):
    rng = random.Random(4)
    teams = [f"t{i}" for i in range(6)]
    rows = [(i, c, *rng.sample(teams, 2), rng.randrange(4), rng.randrange(3), rng.random()) for i in range(240) for c in "AB"]
    df = spark.createDataFrame(rows, "match_id long, c string, home_team string, away_team string, home_goals int, away_goals int, w double")
    for group, weight in ((["c"], None), (["c"], "w"), ([], None)):
        fit = fits.fit_goal_rates_by_scaling(df, group, 12, weight)
        for table, what in ((fit.attack, "for"), (fit.defence, "against")):
            for r in table.collect():
                assert math.isclose(r[f"goals_{what}"], r[f"expected_{what}"], rel_tol=2e-3)
        rates = fits.predict_goal_rates_by_scaling(fit, df).collect()
        assert len(rates) == len(rows) and all(r.home_rate > 0 and r.away_rate > 0 for r in rates)
    silent = spark.createDataFrame([(1, "x", "y", 0, 2), (2, "y", "x", 1, 0)], "match_id long, home_team string, away_team string, home_goals int, away_goals int")
    rates = {r.match_id: r for r in fits.predict_goal_rates_by_scaling(fits.fit_goal_rates_by_scaling(silent, [], 3), silent).collect()}
    assert rates[1].home_rate == 0.0 and rates[2].away_rate == 0.0


def test_a_logistic_fit_derives_its_rows_once(spark, monkeypatch):
    """All rounds read one written table, which is gone afterwards."""
    from knownby.operators import fits

    kept, gone = [], []
    monkeypatch.setattr(fits, "written", lambda df, write=fits.written: kept.append(write(df)) or kept[-1])
    monkeypatch.setattr(fits, "removed", lambda df, drop=fits.removed: gone.append(df) or drop(df))
    rows = spark.range(200).selectExpr("cast(id % 7 as double) AS x", "cast(id % 3 = 0 as int) AS y")
    fit = fits.fit_logistic(rows, ["x"], "y", 2)
    assert fit.rounds > 1 and len(kept) == 1 and gone == kept


def test_bootstrap_draws_one_number_per_unit_and_replicate(spark):
    from knownby.operators import evaluation

    rows = spark.createDataFrame([(i % 5, float(i), 1.0) for i in range(20)], "u long, a double, b double")
    made = evaluation.paired_bootstrap(rows, "u", "a", "b", 10, 7, 0.9)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    sums = {u: (sum(i - 1.0 for i in range(20) if i % 5 == u), 4) for u in range(5)}
    grid = spark.range(5).crossJoin(spark.range(1, 11).withColumnRenamed("id", "r"))
    drawn = grid.select("id", "r", evaluation.poisson_weight(F.col("id"), F.col("r"), 7).alias("w")).collect()
    means = []
    for r in range(1, 11):
        n = sum(x.w * sums[x.id][1] for x in drawn if x.r == r)
        means += [sum(x.w * sums[x.id][0] for x in drawn if x.r == r) / n] if n else []
    got = made.first()
    assert min(means) <= got.low <= got.high <= max(means) and got.units == 5


def test_tasks_read_bounded_parts_whatever_the_table_holds(spark):
    from knownby.session import pin_session

    pin_session(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1000
