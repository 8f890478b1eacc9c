"""Scoring, features, evaluation, economics and drift over matches projected from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import decay_weight
from knownby.operators import calibration as I
from knownby.operators import drift as D
from knownby.operators import economics as E
from knownby.operators import evaluation as V
from knownby.operators import features as X
from knownby.operators import fits as L
from knownby.operators import models as M
from knownby.operators import quality as Q
from knownby.operators import scoring as S
from knownby.operators.decisions import state_at_cutoff, state_rates
from knownby.operators.parlay import parlay_summary
from knownby.operators.ratings import elo_ratings
from knownby.operators.scans import depth_blocks
from knownby.plans.consistency import order_assessments
from knownby.plans.registry import Tables, query

_MT = """
mt AS (SELECT o_orderkey AS match_id, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS event_time,
  c_mktsegment AS competition, 'T' || c_nationkey AS home_team, 'T' || (c_nationkey + 1 + o_orderkey % 24) % 25 AS away_team,
  CAST(o_orderkey % 5 % 4 AS INTEGER) AS home_goals, CAST(o_custkey % 7 % 3 AS INTEGER) AS away_goals
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def order_matches(t: Tables) -> DataFrame:
    k, n = F.col("o_orderkey"), F.col("c_nationkey")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("match_id"),
        F.year("o_orderdate").alias("season"),
        F.timestamp_micros(F.unix_micros("o_orderdate") + (k % 24) * F.lit(3_600_000_000)).alias("event_time"),
        F.col("c_mktsegment").alias("competition"),
        F.concat(F.lit("T"), n.cast("string")).alias("home_team"),
        F.concat(F.lit("T"), ((n + 1 + k % 24) % 25).cast("string")).alias("away_team"),
        (k % 5 % 4).cast("int").alias("home_goals"),
        (F.col("o_custkey") % 7 % 3).cast("int").alias("away_goals"),
    )


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if f.dataType.simpleString() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


# ---- baselines and score models -------------------------------------------------------


@query(
    "class_frequency_baseline",
    "WITH " + _MT + """SELECT competition, count(*) AS matches, round(avg(CASE WHEN home_goals > away_goals THEN 1.0 ELSE 0 END), 6) AS p_home,
      round(avg(CASE WHEN home_goals = away_goals THEN 1.0 ELSE 0 END), 6) AS p_draw, round(avg(CASE WHEN home_goals < away_goals THEN 1.0 ELSE 0 END), 6) AS p_away
      FROM mt WHERE season < 1999 GROUP BY ALL""",
)
def class_frequency_baseline(t: Tables) -> DataFrame:
    return _rounded(S.class_frequencies(order_matches(t), F.col("season") < 1999, ["competition"]))


@query(
    "decayed_goal_rates",
    "WITH " + _MT + """, w AS (SELECT *, exp(-0.002 * (epoch(TIMESTAMP '1999-01-01' - event_time) / 86400.0)) AS w FROM mt WHERE season < 1999)
      SELECT competition, round(sum(w * home_goals) / sum(w), 6) AS home_rate, round(sum(w * away_goals) / sum(w), 6) AS away_rate FROM w GROUP BY ALL""",
)
def decayed_goal_rates(t: Tables) -> DataFrame:
    end = F.unix_micros(F.lit("1999-01-01 00:00:00").cast("timestamp"))
    age = (end - F.unix_micros("event_time")) / F.lit(86_400_000_000.0)
    rates = S.goal_rates(order_matches(t), F.col("season") < 1999, ["competition"], decay_weight(age, 0.002))
    return _rounded(rates)


@query(
    "davidson_probabilities",
    """WITH s AS (SELECT o_orderkey, exp((o_custkey % 40) / 20.0 - 1 + 0.3) AS x, exp((o_orderkey % 40) / 20.0 - 1) AS y FROM orders)
       SELECT o_orderkey, round(x / (x + y + 0.8 * sqrt(x * y)), 6) AS p_home, round(0.8 * sqrt(x * y) / (x + y + 0.8 * sqrt(x * y)), 6) AS p_draw,
         round(y / (x + y + 0.8 * sqrt(x * y)), 6) AS p_away FROM s""",
)
def davidson_probabilities(t: Tables) -> DataFrame:
    home, away = (F.col("o_custkey") % 40) / 20 - 1, (F.col("o_orderkey") % 40) / 20 - 1
    return _rounded(t.orders.select("o_orderkey", *S.davidson(home, away, 0.3, 0.8)))


_RATES = "SELECT o_orderkey, 0.5 + (o_custkey % 20) / 10.0 AS lam, 0.4 + (o_orderkey % 15) / 10.0 AS mu FROM orders"
_GRID = f"""r AS ({_RATES}), g AS (SELECT o_orderkey, lam, mu, x.range AS x, y.range AS y, exp(-lam) * pow(lam, x.range) / factorial(CAST(x.range AS INTEGER))
   * exp(-mu) * pow(mu, y.range) / factorial(CAST(y.range AS INTEGER)) AS p FROM r, range(0, 9) x, range(0, 9) y)"""
_GRID_SUM = """SELECT o_orderkey, round(sum(p) FILTER (x > y) / sum(p), 6) AS p_home, round(sum(p) FILTER (x = y) / sum(p), 6) AS p_draw,
   round(sum(p) FILTER (x < y) / sum(p), 6) AS p_away, round(sum(p) FILTER (x + y < 2.5) / sum(p), 6) AS p_under,
   round(1 - sum(p) FILTER (x + y < 2.5) / sum(p), 6) AS p_over, round(1 - sum(p), 6) AS tail_mass, VALID AS valid FROM g GROUP BY o_orderkey"""


def _rates(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", (F.lit(0.5) + (F.col("o_custkey") % 20) / 10).alias("lam"),
        (F.lit(0.4) + (F.col("o_orderkey") % 15) / 10).alias("mu"),
    )


@query("poisson_outcomes", "WITH " + _GRID + _GRID_SUM.replace("VALID AS", "true AS"))
def poisson_outcomes(t: Tables) -> DataFrame:
    return _rounded(S.score_model(_rates(t), "lam", "mu", 8, 2.5).drop("lam", "mu"))


@query(
    "dixon_coles_outcomes",
    "WITH " + _GRID.replace("g AS", "g0 AS") + """, g AS (SELECT o_orderkey, x, y, lam, mu, p * CASE WHEN x = 0 AND y = 0 THEN 1 - lam * mu * 0.2 WHEN x = 0 AND y = 1 THEN 1 + lam * 0.2
       WHEN x = 1 AND y = 0 THEN 1 + mu * 0.2 WHEN x = 1 AND y = 1 THEN 1 - 0.2 ELSE 1 END AS p FROM g0) """
    + _GRID_SUM.replace("VALID AS", "bool_and(1 - lam * mu * 0.2 >= 0) AS"),
)
def dixon_coles_outcomes(t: Tables) -> DataFrame:
    return _rounded(S.score_model(_rates(t), "lam", "mu", 8, 2.5, rho=F.lit(0.2)).drop("lam", "mu"))


@query(
    "score_grid",
    f"""WITH r AS ({_RATES}) SELECT o_orderkey, CAST(x.range AS INTEGER) AS x, CAST(y.range AS INTEGER) AS y, round(exp(-lam - mu) * pow(lam, x.range) * pow(mu, y.range)
      / (factorial(CAST(x.range AS INTEGER)) * factorial(CAST(y.range AS INTEGER))), 6) AS p FROM r, range(0, 4) x, range(0, 4) y""",
)
def score_grid(t: Tables) -> DataFrame:
    return S.score_grid(_rates(t), "lam", "mu", 3).select("o_orderkey", "x", "y", F.round("p", 6).alias("p"))


# Elo is sequential: checked against a plain loop in the tests.
@query("elo_ratings")
def elo(t: Tables) -> DataFrame:
    return _rounded(elo_ratings(order_matches(t), start=1500.0, k=20.0, home_advantage=60.0, scale=400.0))


# ---- features and folds ---------------------------------------------------------------

_TM = _MT + """,
tm AS (SELECT season, match_id, event_time, home_team AS team, 'HOME' AS venue, home_goals AS gf, away_goals AS ga FROM mt
       UNION ALL SELECT season, match_id, event_time, away_team, 'AWAY', away_goals, home_goals FROM mt),
tp AS (SELECT *, CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS points FROM tm)
"""


@query(
    "team_form_features",
    "WITH " + _TM + """, fm AS (SELECT match_id, team, event_time, count(*) OVER w AS form_matches, CAST(sum(points) OVER w AS BIGINT) AS form_points, CAST(sum(gf) OVER w AS BIGINT) AS form_goals_for,
      CAST(sum(ga) OVER w AS BIGINT) AS form_goals_against, CAST(sum(CASE WHEN venue = 'HOME' THEN points END) OVER w AS BIGINT) AS form_home_points,
      CAST(sum(CASE WHEN venue = 'AWAY' THEN points END) OVER w AS BIGINT) AS form_away_points,
      round(epoch(event_time - max(event_time) OVER w) / 86400.0, 6) AS rest_days, count(*) OVER c AS recent_matches FROM tp
      WINDOW w AS (PARTITION BY team ORDER BY event_time, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
        c AS (PARTITION BY team ORDER BY event_time RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))
      SELECT match_id, team, recent_matches, first_value(form_matches) OVER t AS form_matches, first_value(form_points) OVER t AS form_points,
        first_value(form_goals_for) OVER t AS form_goals_for, first_value(form_goals_against) OVER t AS form_goals_against,
        first_value(form_home_points) OVER t AS form_home_points, first_value(form_away_points) OVER t AS form_away_points,
        first_value(rest_days) OVER t AS rest_days FROM fm WINDOW t AS (PARTITION BY team, event_time ORDER BY match_id)""",
)
def team_form_features(t: Tables) -> DataFrame:
    made = X.form_features(X.team_matches(order_matches(t)), window=5, congestion_days=14)
    return _rounded(made.select(
        "match_id", "team", "form_matches", "form_points", "form_goals_for", "form_goals_against",
        "form_home_points", "form_away_points", "rest_days", "recent_matches",
    ))


@query(
    "league_table_before_match",
    "WITH " + _TM + """SELECT season, match_id, team, CAST(coalesce(sum(points) OVER w, 0) AS BIGINT) AS season_points,
      CAST(coalesce(sum(gf - ga) OVER w, 0) AS BIGINT) AS season_goal_difference, count(*) OVER w AS season_games FROM tp
      WINDOW w AS (PARTITION BY season, team ORDER BY event_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
)
def league_table_before_match(t: Tables) -> DataFrame:
    return X.table_before(X.team_matches(order_matches(t))).select(
        "season", "match_id", "team", "season_points", "season_goal_difference", "season_games"
    )


@query(
    "walk_forward_folds",
    """WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS rows FROM orders GROUP BY ALL),
       n AS (SELECT *, row_number() OVER (ORDER BY season) AS n, count(*) OVER () AS total FROM s),
       f AS (SELECT n.*, g.range AS fold_id FROM n, range(2, 100) g WHERE g.range <= total - 3)
       SELECT CAST(fold_id AS INTEGER) AS fold_id, CASE WHEN n <= fold_id THEN 'TRAIN' WHEN n = fold_id + 1 THEN 'VALIDATION' WHEN n = fold_id + 2 THEN 'CALIBRATION' ELSE 'EVALUATION' END AS role,
         season, rows FROM f WHERE n <= fold_id + 3 AND n > fold_id - 2""",
)
def walk_forward_folds(t: Tables) -> DataFrame:
    """Rolling training window of two seasons."""
    seasons = t.orders.select(F.year("o_orderdate").alias("season"))
    return X.walk_forward_folds(seasons, "season", train=2, validation=1, calibration=1, evaluation=1)


# ---- evaluation -----------------------------------------------------------------------

_FC = "fc AS (SELECT doc_id, quality AS y, toxic AS seg, (doc_id * 7919 % 1000) / 999.0 AS p FROM labels)"


def _forecasts(t: Tables) -> DataFrame:
    return t.labels.select(
        "doc_id", F.col("quality").alias("y"), F.col("toxic").alias("seg"),
        ((F.col("doc_id") * 7919 % 1000) / 999).alias("p"),
    )


@query(
    "binary_forecast_scores",
    f"WITH {_FC}" + """SELECT seg, count(*) AS sample_size, round(avg(CASE WHEN y = 1 THEN -ln(least(greatest(p, 1e-6), 1 - 1e-6)) ELSE -ln(1 - least(greatest(p, 1e-6), 1 - 1e-6)) END), 6) AS log_loss,
      round(avg((p - y) * (p - y)), 6) AS brier FROM fc GROUP BY seg""",
)
def binary_forecast_scores(t: Tables) -> DataFrame:
    return _rounded(V.binary_scores(_forecasts(t), "p", "y", ["seg"], 1e-6))


_REL = f"""WITH {_FC}, b AS (SELECT seg, least(CAST(floor(p * 10) AS INTEGER), 9) AS bin, count(*) AS n, avg(p) AS f, avg(y) AS o FROM fc GROUP BY ALL)"""


@query(
    "reliability_table",
    _REL + "SELECT seg, bin, n, round(f, 6) AS mean_forecast, round(o, 6) AS observed_rate FROM b",
)
def reliability_table(t: Tables) -> DataFrame:
    return _rounded(V.reliability(_forecasts(t), "p", "y", ["seg"], 10))


@query("expected_calibration_error", _REL + "SELECT seg, round(sum(abs(f - o) * n) / sum(n), 6) AS ece FROM b GROUP BY seg")
def expected_calibration_error(t: Tables) -> DataFrame:
    return _rounded(V.expected_calibration_error(V.reliability(_forecasts(t), "p", "y", ["seg"], 10), ["seg"]))


@query(
    "outcome_forecast_scores",
    "WITH " + _MT + """, f AS (SELECT competition, (2 + match_id % 5) / 10.0 AS ph, (1 + match_id % 3) / 10.0 AS pd, 1 - (3 + match_id % 5 + match_id % 3) / 10.0 AS pa,
        CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals = away_goals THEN 'D' ELSE 'A' END AS o FROM mt),
      x AS (SELECT *, CASE o WHEN 'H' THEN 1 ELSE 0 END AS h, CASE o WHEN 'D' THEN 1 ELSE 0 END AS d, CASE o WHEN 'A' THEN 1 ELSE 0 END AS a FROM f)
      SELECT competition, count(*) AS sample_size, round(avg(-ln(greatest(CASE o WHEN 'H' THEN ph WHEN 'D' THEN pd ELSE pa END, 1e-6))), 6) AS log_loss,
        round(avg((ph - h) * (ph - h) + (pd - d) * (pd - d) + (pa - a) * (pa - a)), 6) AS brier,
        round(avg(((ph - h) * (ph - h) + (ph - h + pd - d) * (ph - h + pd - d)) / 2), 6) AS rps FROM x GROUP BY ALL""",
)
def outcome_forecast_scores(t: Tables) -> DataFrame:
    m = F.col("match_id")
    rows = order_matches(t).select(
        "competition", ((2 + m % 5) / 10).alias("p_home"), ((1 + m % 3) / 10).alias("p_draw"),
        (1 - (3 + m % 5 + m % 3) / 10).alias("p_away"),
        F.when(F.col("home_goals") > F.col("away_goals"), "HOME")
        .when(F.col("home_goals") == F.col("away_goals"), "DRAW").otherwise("AWAY").alias("outcome"),
    )
    return _rounded(V.outcome_scores(rows, ["competition"], 1e-6))


@query(
    "paired_bootstrap_interval",
    f"""WITH u AS (SELECT l_returnflag AS segment, l_orderkey AS unit, sum(l_discount - l_tax) AS d, count(*) AS n FROM lineitem GROUP BY ALL),
      w AS (SELECT u.*, r.replicate, ('0x' || substr(md5(unit || ':' || r.replicate || ':7'), 1, 13))::BIGINT / 4503599627370496.0 AS x
            FROM u, range(1, 51) r(replicate)),
      m AS (SELECT segment, replicate, sum(k * d) / nullif(sum(k * n), 0) AS m FROM (
              SELECT *, {' + '.join(f'CAST(x >= {c!r} AS INTEGER)' for c in V.POISSON_ONE)} AS k FROM w) GROUP BY ALL),
      i AS (SELECT segment, quantile_cont(m, 0.05) AS low, quantile_cont(m, 0.95) AS high FROM m GROUP BY segment)
      SELECT segment, round(sum(d) / sum(n), 6) AS mean_difference, CAST(sum(n) AS BIGINT) AS sample_size, count(*) AS units,
        round(any_value(low), 6) AS low, round(any_value(high), 6) AS high, CAST(7 AS INTEGER) AS seed FROM u JOIN i USING (segment) GROUP BY segment""",
)
def paired_bootstrap_interval(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("unit"), F.col("l_returnflag").alias("segment"),
        F.col("l_discount").alias("loss_a"), F.col("l_tax").alias("loss_b"),
    )
    return _rounded(V.paired_bootstrap(rows, "unit", "loss_a", "loss_b", 50, 7, 0.9, ["segment"]))


_AG = """f AS (SELECT o_orderkey, m, CASE m WHEN 0 THEN (o_orderkey % 10) / 10.0 WHEN 1 THEN (o_custkey % 10) / 10.0 ELSE 0.5 END AS p FROM orders, (VALUES (0), (1), (2)) v(m)),
ag AS (SELECT o_orderkey, count(*) AS models, stddev_pop(p) AS p_stddev, max(p) - min(p) AS p_spread, avg(p) AS p_mean FROM f GROUP BY o_orderkey)"""


def _agreement(t: Tables) -> DataFrame:
    p = F.array((F.col("o_orderkey") % 10) / 10, (F.col("o_custkey") % 10) / 10, F.lit(0.5))
    return V.agreement(t.orders.select("o_orderkey", F.explode(p).alias("p")), ["o_orderkey"], "p")


@query(
    "model_agreement",
    f"WITH {_AG} SELECT o_orderkey, models, round(p_stddev, 6) AS p_stddev, round(p_spread, 6) AS p_spread, round(p_mean, 6) AS p_mean FROM ag",
)
def model_agreement(t: Tables) -> DataFrame:
    return _rounded(_agreement(t))


@query(
    "error_by_agreement",
    f"""WITH {_AG}, y AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS y FROM orders)
      SELECT CASE WHEN p_spread >= 0.45 THEN 2 WHEN p_spread >= 0.25 THEN 1 ELSE 0 END AS bucket, count(*) AS fixtures,
        round(avg((p_mean - y) * (p_mean - y)), 6) AS brier FROM ag JOIN y USING (o_orderkey) GROUP BY ALL""",
)
def error_by_agreement(t: Tables) -> DataFrame:
    outcomes = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "O").cast("int").alias("y"))
    return _rounded(V.error_by_agreement(_agreement(t), outcomes, ["o_orderkey"], [0.25, 0.45]))


# ---- drift ----------------------------------------------------------------------------


@query(
    "binned_drift",
    """WITH b AS (SELECT l_linestatus, CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity >= 25 THEN 2 WHEN l_quantity >= 10 THEN 1 ELSE 0 END AS bin,
         l_shipdate >= TIMESTAMP '1998-01-01' AS cur FROM lineitem),
       c AS (SELECT l_linestatus, bin, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM b GROUP BY ALL),
       s AS (SELECT *, r / sum(r) OVER w AS rs, c / sum(c) OVER w AS cs FROM c WINDOW w AS (PARTITION BY l_linestatus))
       SELECT l_linestatus, round(sum((greatest(cs, 1e-6) - greatest(rs, 1e-6)) * ln(greatest(cs, 1e-6) / greatest(rs, 1e-6))), 6) AS psi,
         round(sum(abs(cs - rs)) / 2, 6) AS total_variation FROM s GROUP BY ALL""",
)
def binned_drift(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_linestatus", D.edge_bin(F.col("l_quantity"), [10, 25, 40]).alias("bin"), "l_shipdate")
    current = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")
    shares = D.category_shares(rows, current, "bin", ["l_linestatus"])
    return _rounded(D.population_stability(shares, ["l_linestatus"], 1e-6))


@query(
    "category_drift",
    """WITH c AS (SELECT user_id % 5 AS seg, event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS reference, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS current FROM events GROUP BY ALL)
       SELECT seg, event_type, reference, current, round(reference / sum(reference) OVER (PARTITION BY seg), 6) AS reference_share,
         round(current / sum(current) OVER (PARTITION BY seg), 6) AS current_share FROM c""",
)
def category_drift(t: Tables) -> DataFrame:
    rows = t.events.select((F.col("user_id") % 5).alias("seg"), "event_type", "ts")
    current = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    return _rounded(D.category_shares(rows, current, "event_type", ["seg"]))


@query(
    "kolmogorov_smirnov",
    """WITH c AS (SELECT l_returnflag, l_extendedprice AS v, count(*) FILTER (l_shipdate < TIMESTAMP '1998-01-01') AS r, count(*) FILTER (l_shipdate >= TIMESTAMP '1998-01-01') AS c FROM lineitem GROUP BY ALL),
       s AS (SELECT l_returnflag, sum(r) OVER w AS r, sum(c) OVER w AS c, sum(r) OVER g AS rt, sum(c) OVER g AS ct FROM c
         WINDOW w AS (PARTITION BY l_returnflag ORDER BY v), g AS (PARTITION BY l_returnflag))
       SELECT l_returnflag, round(max(abs(r / rt - c / ct)), 9) AS ks FROM s GROUP BY ALL""",
)
def kolmogorov_smirnov(t: Tables) -> DataFrame:
    current = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")
    block = F.floor(F.col("l_extendedprice") / 1000)
    return _rounded(D.kolmogorov_smirnov(t.lineitem, current, "l_extendedprice", ["l_returnflag"], block), 9)


@query(
    "missingness_change",
    """WITH x AS (SELECT user_id % 3 AS seg, ts >= TIMESTAMP '2024-01-15' AS cur, CASE WHEN value > 20 THEN value END AS v, CASE WHEN event_id % 9 > 0 THEN props END AS p FROM events),
       y AS (SELECT seg, avg((v IS NULL)::INT) FILTER (NOT cur) AS a, avg((v IS NULL)::INT) FILTER (cur) AS b, avg((p IS NULL)::INT) FILTER (NOT cur) AS c, avg((p IS NULL)::INT) FILTER (cur) AS d FROM x GROUP BY seg)
       SELECT seg, 'v' AS "column", round(a, 6) AS reference_rate, round(b, 6) AS current_rate, round(b - a, 6) AS change FROM y
       UNION ALL SELECT seg, 'p', round(c, 6), round(d, 6), round(d - c, 6) FROM y""",
)
def missingness_change(t: Tables) -> DataFrame:
    rows = t.events.select(
        (F.col("user_id") % 3).alias("seg"), "ts", F.when(F.col("value") > 20, F.col("value")).alias("v"),
        F.when(F.col("event_id") % 9 > 0, F.col("props")).alias("p"),
    )
    current = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    return _rounded(D.missingness_change(rows, current, ["v", "p"], ["seg"]))


# ---- economics ------------------------------------------------------------------------

_ST = """st AS (SELECT o_orderpriority, o_orderstatus, o_orderkey, o_orderdate, 1.25 + (o_custkey % 20) / 4.0 AS odds, CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 3 = 0 END AS won,
   (1.25 + (o_custkey % 20) / 4.0) / (1.5 + (o_custkey % 16) / 4.0) - 1 AS clv FROM orders),
sp AS (SELECT *, CASE WHEN won THEN odds - 1 WHEN NOT won THEN -1 END AS profit, CASE WHEN won IS NOT NULL THEN 1.0 END AS stake FROM st)"""


def _settled(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = t.orders.select(
        "o_orderpriority", "o_orderstatus", "o_orderkey", "o_orderdate", (F.lit(1.25) + (c % 20) / 4).alias("odds"),
        F.when(k % 9 > 0, k % 3 == 0).alias("won"), (F.lit(1.5) + (c % 16) / 4).alias("closing"),
    )
    return E.settle(rows, "odds", "won", 1.0).withColumn("clv", E.closing_value(F.col("odds"), F.col("closing")))


@query(
    "paper_returns",
    f"""WITH {_ST} SELECT o_orderpriority, count(profit) AS settled, sum(stake)::DOUBLE AS turnover, sum(profit)::DOUBLE AS profit,
      round(sum(profit)::DOUBLE / sum(stake), 6) AS yield, round(sum(profit)::DOUBLE / 1000, 6) AS roi, round(avg(clv)::DOUBLE, 6) AS mean_clv FROM sp GROUP BY ALL""",
)
def paper_returns(t: Tables) -> DataFrame:
    return _rounded(E.returns(_settled(t), ["o_orderpriority"], 1000.0))


@query(
    "paper_drawdown",
    f"""WITH {_ST}, r AS (SELECT o_orderpriority, o_orderdate, o_orderkey, profit, sum(profit) OVER w AS run FROM sp WHERE profit IS NOT NULL
        WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)),
      p AS (SELECT *, greatest(0, max(run) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)) AS peak FROM r)
      SELECT o_orderpriority, sum(profit)::DOUBLE AS profit, max(peak - run)::DOUBLE AS max_drawdown FROM p GROUP BY ALL""",
)
def paper_drawdown(t: Tables) -> DataFrame:
    rows = depth_blocks(_settled(t).withColumn("at", F.col("o_orderdate").cast("timestamp")), ["o_orderpriority"], "at")
    return E.drawdown(rows, ["o_orderpriority"], "block", ["o_orderdate", "o_orderkey"])


@query(
    "segment_report",
    f"""WITH {_ST}, x AS (SELECT o_orderpriority, o_orderstatus, stake, profit FROM sp),
      g AS (SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority) AS gp, grouping(o_orderstatus) AS gs, count(profit) AS settled, sum(stake)::DOUBLE AS turnover, sum(profit)::DOUBLE AS profit FROM x
        GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus), ()))
      SELECT CASE WHEN gp = 0 THEN 'o_orderpriority' WHEN gs = 0 THEN 'o_orderstatus' END AS dimension,
        CASE WHEN gp = 0 THEN o_orderpriority WHEN gs = 0 THEN o_orderstatus END AS segment, settled, turnover, profit, round(profit / turnover, 6) AS yield FROM g""",
)
def segment_report(t: Tables) -> DataFrame:
    return _rounded(E.segment_report(_settled(t), ["o_orderpriority", "o_orderstatus"]))


@query(
    "segment_cube",
    f"""WITH {_ST} SELECT o_orderpriority, o_orderstatus, CAST(grouping(o_orderpriority) * 2 + grouping(o_orderstatus) AS BIGINT) AS level, count(profit) AS settled, sum(profit)::DOUBLE AS profit
      FROM sp GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
)
def segment_cube(t: Tables) -> DataFrame:
    return E.segment_cube(_settled(t), ["o_orderpriority", "o_orderstatus"])


@query(
    "decision_state_rates",
    """WITH d AS (SELECT user_id % 4 AS seg, event_id % 50 = 0 AS tech, CASE event_type WHEN 'signup' THEN 'QUALIFIED' WHEN 'click' THEN 'NO_BET' WHEN 'view' THEN 'WAIT' WHEN 'purchase' THEN 'REVIEW' ELSE 'BLOCKED' END AS s FROM events),
       f AS (SELECT seg, CASE WHEN tech THEN 'BLOCKED' WHEN s IN ('WAIT', 'REVIEW') THEN 'NO_BET' ELSE s END AS s FROM d)
       SELECT seg, count(*) AS decisions, round(count(*) FILTER (s = 'QUALIFIED') / count(*), 6) AS qualified_rate, round(count(*) FILTER (s = 'NO_BET') / count(*), 6) AS no_bet_rate,
         round(count(*) FILTER (s = 'WAIT') / count(*), 6) AS wait_rate, round(count(*) FILTER (s = 'REVIEW') / count(*), 6) AS review_rate, round(count(*) FILTER (s = 'BLOCKED') / count(*), 6) AS blocked_rate
       FROM f GROUP BY seg""",
)
def decision_state_rates(t: Tables) -> DataFrame:
    names = {"signup": "QUALIFIED", "click": "NO_BET", "view": "WAIT", "purchase": "REVIEW", "error": "BLOCKED"}
    state = F.lit(None).cast("string")
    for event, name in names.items():
        state = F.when(F.col("event_type") == event, F.lit(name)).otherwise(state)
    final = state_at_cutoff(state, F.col("event_id") % 50 == 0)
    return _rounded(state_rates(t.events.select((F.col("user_id") % 4).alias("seg"), final.alias("state")), ["seg"]))


# ---- quality, cross-check, claims -----------------------------------------------------


@query(
    "data_quality_profile",
    "WITH " + _MT + """SELECT season, count(*) AS rows, count(*) FILTER (home_team = away_team) AS self_matches, count(*) FILTER (home_goals > 3 OR away_goals < 0) AS impossible_scores,
      round(avg((nullif(away_goals, 2) IS NULL)::INT), 6) AS away_goals_missing_rate FROM mt GROUP BY ALL""",
)
def data_quality_profile(t: Tables) -> DataFrame:
    rows = order_matches(t).withColumn("away_goals", F.nullif("away_goals", F.lit(2)))
    conditions = {
        "self_matches": F.col("home_team") == F.col("away_team"),
        "impossible_scores": (F.col("home_goals") > 3) | (F.col("away_goals") < 0),
    }
    return _rounded(Q.profile(rows, ["season"], conditions, ["away_goals"]))


@query(
    "duplicate_row_rate",
    """WITH k AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
       SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM k GROUP BY ALL""",
)
def duplicate_row_rate(t: Tables) -> DataFrame:
    return Q.duplicate_rate(t.lineitem, ["l_returnflag", "l_orderkey", "l_linenumber"], ["l_returnflag"])


@query(
    "provider_revision_rate",
    """WITH k AS (SELECT l_suppkey % 5 AS provider, l_orderkey, count(DISTINCT l_partkey % 3) AS n FROM lineitem GROUP BY ALL)
       SELECT provider, count(*) AS keys, count(*) FILTER (n > 1) AS revised_keys FROM k GROUP BY ALL""",
)
def provider_revision_rate(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        (F.col("l_suppkey") % 5).alias("provider"), "l_orderkey", (F.col("l_partkey") % 3).cast("string").alias("payload")
    )
    return Q.revision_rate(rows, ["provider"], "l_orderkey", "payload")


@query(
    "results_fixture_cross_check",
    "WITH " + _MT + """, f AS (SELECT * FROM mt WHERE match_id % 17 <> 0), r AS (SELECT match_id, CASE WHEN match_id % 11 = 0 THEN season + 1 ELSE season END AS wk,
        CASE WHEN match_id % 13 = 0 THEN event_time + INTERVAL 1 DAY ELSE event_time END AS tm, CASE WHEN home_team <> 'T3' THEN home_team END AS h,
        CASE WHEN match_id % 7 = 0 THEN home_team ELSE away_team END AS a FROM mt WHERE match_id % 19 <> 0),
      j AS (SELECT f.match_id AS fi, r.match_id AS ri, f.match_id IS NOT NULL AND r.match_id IS NOT NULL AS both_, f.season <> wk AS m1, CAST(f.event_time AS DATE) <> CAST(tm AS DATE) AS m2,
        f.home_team IS DISTINCT FROM h AS m4, f.away_team IS DISTINCT FROM a AS m5, h, a FROM f FULL JOIN r ON f.match_id = r.match_id)
      SELECT count(fi) AS fixtures, count(*) FILTER (both_ AND m1) AS matchweek_mismatches, count(*) FILTER (both_ AND m2) AS local_date_mismatches, CAST(0 AS BIGINT) AS local_time_mismatches,
        count(*) FILTER (both_ AND m4) AS home_key_mismatches, count(*) FILTER (both_ AND m5) AS away_key_mismatches, count(*) FILTER (ri IS NULL) AS without_result,
        count(*) FILTER (fi IS NULL) AS without_fixture, count(*) FILTER (ri IS NOT NULL AND (h IS NULL OR a IS NULL)) AS unaliased, count(*) FILTER (both_ AND (m1 OR m2 OR m4 OR m5)) AS mismatched_fixtures FROM j""",
)
def results_fixture_cross_check(t: Tables) -> DataFrame:
    m = F.col("match_id")
    base = order_matches(t)

    def shaped(df: DataFrame, week, at, home, away) -> DataFrame:
        return df.select(
            "match_id", week.alias("matchweek"), F.to_date(at).alias("local_date"),
            F.date_format(at, "HH:mm").alias("local_time"), home.alias("home_key"), away.alias("away_key"),
        )

    season, at, home, away = (F.col(c) for c in ("season", "event_time", "home_team", "away_team"))
    fixtures = shaped(base.filter(m % 17 != 0), season, at, home, away)
    results = shaped(
        base.filter(m % 19 != 0),
        F.when(m % 11 == 0, season + 1).otherwise(season),
        F.when(m % 13 == 0, at + F.expr("interval 1 day")).otherwise(at),
        F.when(home != "T3", home),
        F.when(m % 7 == 0, home).otherwise(away),
    )
    return Q.cross_check(fixtures, results, "match_id")


@query(
    "independent_confirmations",
    """SELECT l_partkey % 100 AS claim, count(*) AS reports, count(DISTINCT CASE WHEN l_suppkey % 4 > 0 THEN l_suppkey % 40 END) AS independent_confirmations FROM lineitem GROUP BY ALL""",
)
def independent_confirmations(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        (F.col("l_partkey") % 100).alias("claim"),
        F.when(F.col("l_suppkey") % 4 > 0, F.col("l_suppkey") % 40).alias("lineage"),
    )
    return Q.confirmations(rows, "claim", "lineage")


@query(
    "assessment_as_of",
    """WITH a AS (SELECT 'S' || c_nationkey % 3 AS sport, 'F' || c_nationkey % 4 AS market_family, CASE WHEN c_nationkey % 5 > 0 THEN 'C' || c_nationkey % 5 END AS competition,
         o_orderkey // 3 AS v, TIMESTAMP '2020-01-01' + o_orderkey * INTERVAL 1 HOUR - (CASE WHEN o_orderkey % 53 = 0 THEN 10000 ELSE 0 END) * INTERVAL 1 HOUR AS known
         FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT sport, market_family, competition, max(v) AS assessment_version FROM a WHERE known <= TIMESTAMP '2020-06-01' GROUP BY ALL""",
)
def assessment_as_of(t: Tables) -> DataFrame:
    return Q.assessment_as_of(
        order_assessments(t), ["sport", "market_family", "competition"],
        F.lit("2020-06-01 00:00:00").cast("timestamp"), ["assessment_version"],
    )


# ---- parlays --------------------------------------------------------------------------

_PL = """lg AS (SELECT DISTINCT l_orderkey AS parlay_id, l_linenumber AS sel, CASE WHEN l_orderkey % 4 = 0 AND l_linenumber = 1 THEN 'TENNIS' ELSE 'FOOTBALL' END AS sport, 'MR' || (l_linenumber % 6 + 1) AS mr,
   1.0 + (l_linenumber % 4 + 1) / 4.0 AS odds, 0.5 + (l_linenumber % 5) / 10.0 AS p FROM lineitem),
pr AS (SELECT a.parlay_id, CASE WHEN a.parlay_id % 5 = 0 AND a.sel = 1 THEN 'contradictory' WHEN a.parlay_id % 3 = 0 THEN 'moderate' ELSE 'independent' END AS k
   FROM lg a JOIN lg b ON a.parlay_id = b.parlay_id AND a.sel < b.sel WHERE NOT (a.parlay_id % 7 = 0 AND a.sel = 1)),
pc AS (SELECT parlay_id, count(*) AS pairs, count(*) FILTER (k <> 'independent') AS dep, count(*) FILTER (k = 'contradictory') AS con FROM pr GROUP BY ALL),
b AS (SELECT parlay_id, count(*) AS legs, max(mr) AS max_mr, count(*) FILTER (mr >= 'MR4') AS count_mr4_plus, count(*) FILTER (mr = 'MR2') AS count_mr2, min(sport) AS s0, max(sport) AS s1,
   product(odds) AS o, product(p) AS p FROM lg GROUP BY ALL)"""


@query(
    "parlay_summary",
    f"""WITH {_PL} SELECT b.parlay_id, legs, CASE WHEN legs < 2 THEN NULL WHEN legs <= 5 THEN 'L1' WHEN legs <= 7 THEN 'L2' ELSE 'L3' END AS leg_band, max_mr, count_mr2, count_mr4_plus,
      CASE WHEN s0 = s1 THEN 'MONO_SPORT' ELSE 'MULTI_SPORT' END AS sport_mix, round(o, 6) AS combined_odds,
      round(CASE WHEN coalesce(pairs, 0) = legs * (legs - 1) / 2 AND coalesce(dep, 0) = 0 THEN p END, 6) AS combined_p_safe,
      CASE WHEN coalesce(con, 0) > 0 THEN 'REJECTED_CONTRADICTORY' WHEN coalesce(pairs, 0) = legs * (legs - 1) / 2 AND coalesce(dep, 0) = 0 THEN 'INDEPENDENT' ELSE 'JOINT_MODEL_REQUIRED' END AS dependency_status
      FROM b LEFT JOIN pc ON b.parlay_id = pc.parlay_id""",
)
def parlay(t: Tables) -> DataFrame:
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    legs = t.lineitem.select(k.alias("parlay_id"), n.alias("selection_id")).distinct().select(
        "parlay_id", "selection_id",
        F.when((F.col("parlay_id") % 4 == 0) & (F.col("selection_id") == 1), "TENNIS").otherwise("FOOTBALL").alias("sport"),
        F.concat(F.lit("MR"), (F.col("selection_id") % 6 + 1).cast("string")).alias("mr"),
        (F.lit(1.0) + (F.col("selection_id") % 4 + 1) / 4).alias("odds"),
        (F.lit(0.5) + (F.col("selection_id") % 5) / 10).alias("p_safe"),
    )
    # A parlay has at most seven legs here, so its asserted pairs are bounded as well.
    a, b = legs.select("parlay_id", F.col("selection_id").alias("selection_a")), legs.select(
        "parlay_id", F.col("selection_id").alias("selection_b")
    )
    pairs = a.join(b, "parlay_id").filter("selection_a < selection_b").filter(
        ~((F.col("parlay_id") % 7 == 0) & (F.col("selection_a") == 1))
    )
    kind = F.when((F.col("parlay_id") % 5 == 0) & (F.col("selection_a") == 1), "contradictory").when(
        F.col("parlay_id") % 3 == 0, "moderate"
    ).otherwise("independent")
    made = parlay_summary(legs, pairs.withColumn("dependency_class", kind))
    return _rounded(made).select(
        "parlay_id", "legs", "leg_band", "max_mr", "count_mr2", "count_mr4_plus", "sport_mix", "combined_odds",
        "combined_p_safe", "dependency_status",
    )


# ---- fitted models: no SQL twin, checked on properties in the tests ---------------------


_RATE_ROUNDS = 8
# One row per round, competition and team: attack, defence, and the competition's home factor.
_RATES_SQL = "WITH RECURSIVE " + _MT + f""", tr AS (SELECT * FROM mt WHERE season < 1999),
  pr AS (SELECT competition, a, d, h, count(*) AS n, sum(g) AS g FROM (
    SELECT competition, home_team AS a, away_team AS d, 1 AS h, home_goals AS g FROM tr UNION ALL
    SELECT competition, away_team, home_team, 0, away_goals FROM tr) GROUP BY ALL),
  tm AS (SELECT DISTINCT competition, a AS team FROM pr),
  fit(i, competition, team, att, def, home) AS (
    SELECT 0, competition, team, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE FROM tm
    UNION ALL
    SELECT i + 1, competition, team, att, def, home FROM (
      WITH na AS (SELECT f.i, p.competition, p.a AS team, sum(p.g) / sum(p.n * f.def * CASE h WHEN 1 THEN f.home ELSE 1 END) AS att
          FROM fit f JOIN pr p ON p.competition = f.competition AND p.d = f.team WHERE f.i < {_RATE_ROUNDS} GROUP BY ALL),
        hm AS (SELECT DISTINCT competition, home FROM fit),
        nd AS (SELECT p.competition, p.d AS team, sum(p.g) / sum(p.n * na.att * CASE h WHEN 1 THEN hm.home ELSE 1 END) AS def
          FROM na JOIN pr p ON p.competition = na.competition AND p.a = na.team JOIN hm ON hm.competition = p.competition GROUP BY ALL),
        nh AS (SELECT p.competition, sum(p.g) / sum(p.n * na.att * nd.def) AS home
          FROM pr p JOIN na ON p.competition = na.competition AND p.a = na.team JOIN nd ON p.competition = nd.competition AND p.d = nd.team WHERE h = 1 GROUP BY ALL)
      SELECT na.i, na.competition, na.team, att, def, nh.home FROM na JOIN nd USING (competition, team) JOIN nh USING (competition))),
  done AS (SELECT * FROM fit WHERE i = {_RATE_ROUNDS})
"""


def _scaled_rates(t: Tables) -> L.GoalRates:
    return L.fit_goal_rates_by_scaling(order_matches(t).filter("season < 1999"), ["competition"], _RATE_ROUNDS)


@query(
    "scaled_goal_rates",
    _RATES_SQL + """SELECT match_id, round(x.att * y.def * x.home, 4) AS home_rate, round(y.att * x.def, 4) AS away_rate
      FROM mt JOIN done x ON x.competition = mt.competition AND x.team = home_team
        JOIN done y ON y.competition = mt.competition AND y.team = away_team WHERE season >= 1999""",
)
def scaled_goal_rates(t: Tables) -> DataFrame:
    return _rounded(L.predict_goal_rates_by_scaling(_scaled_rates(t), order_matches(t).filter("season >= 1999")), 4)


@query(
    "goal_rate_score_equations",
    _RATES_SQL + """SELECT competition, team, round(att, 4) AS attack, CAST(sum(g) AS DOUBLE) AS goals_for, round(sum(rate), 3) AS expected_for
      FROM (SELECT x.competition, x.team, x.att, p.g, p.n * x.att * y.def * CASE h WHEN 1 THEN x.home ELSE 1 END AS rate
        FROM pr p JOIN done x ON x.competition = p.competition AND x.team = p.a JOIN done y ON y.competition = p.competition AND y.team = p.d)
      GROUP BY competition, team, att""",
)
def goal_rate_score_equations(t: Tables) -> DataFrame:
    """How near expected goals are to scored ones: the gradient of the likelihood is their difference."""
    return _scaled_rates(t).attack.select(
        "competition", "team", F.round("attack", 4).alias("attack"), "goals_for", F.round("expected_for", 3).alias("expected_for")
    )


@query("fitted_goal_rates")
def fitted_goal_rates(t: Tables) -> DataFrame:
    matches = order_matches(t)
    model = M.fit_goal_rates(matches.filter("season < 1999"), regularization=0.01)
    return _rounded(M.predict_goal_rates(model, matches.filter("season >= 1999")), 4)


def _outcome_rows(t: Tables) -> DataFrame:
    table = X.table_before(X.team_matches(order_matches(t)))
    home = table.filter("venue = 'HOME'")
    result = F.when(F.col("goals_for") > F.col("goals_against"), 0.0).when(
        F.col("goals_for") == F.col("goals_against"), 1.0
    ).otherwise(2.0)
    return home.select(
        "match_id", "season", "season_points", "season_goal_difference", "season_games", result.alias("label")
    )


_FEATURES = ("season_points", "season_goal_difference", "season_games")
_NAMES = ("p_home", "p_draw", "p_away")


@query("outcome_logistic_challenger")
def outcome_logistic_challenger(t: Tables) -> DataFrame:
    rows = _outcome_rows(t)
    model = M.fit_outcome_logistic(rows.filter("season < 1999"), _FEATURES, "label", 0.01)
    return _rounded(M.outcome_probabilities(model, rows.filter("season >= 1999").select("match_id", *_FEATURES), _NAMES), 4)


_LOGISTIC_SQL = "WITH " + _TM + """, lt AS (SELECT season, venue, gf, ga, coalesce(sum(points) OVER w, 0) AS season_points,
      coalesce(sum(gf - ga) OVER w, 0) AS season_goal_difference, count(*) OVER w AS season_games FROM tp
      WINDOW w AS (PARTITION BY season, team ORDER BY event_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)),
    o AS (SELECT CAST(CASE WHEN gf > ga THEN 0 WHEN gf = ga THEN 1 ELSE 2 END AS INTEGER) AS outcome, * FROM lt WHERE venue = 'HOME' AND season < 1999)
    SELECT outcome, f.feature, CAST(sum(CASE f.feature WHEN 'rows' THEN 1 WHEN 'season_points' THEN season_points
      WHEN 'season_goal_difference' THEN season_goal_difference ELSE season_games END) AS DOUBLE) AS total
    FROM o, (VALUES ('rows'), ('season_points'), ('season_goal_difference'), ('season_games')) f(feature) GROUP BY ALL"""


@query("outcome_logistic_score_equations", _LOGISTIC_SQL)
def outcome_logistic_score_equations(t: Tables) -> DataFrame:
    """At the maximum of the likelihood the fitted totals of every feature per class are the observed ones."""
    rows = _outcome_rows(t).filter("season < 1999")
    fit = L.fit_logistic(rows, _FEATURES, "label", 3)
    scored = L.outcome_probabilities(fit, rows, _NAMES)
    entries = F.array(*[
        F.struct(F.lit(k).alias("outcome"), F.lit(f).alias("feature"), (F.col(p) * (F.lit(1.0) if f == "rows" else F.col(f))).alias("part"))
        for k, p in enumerate(_NAMES) for f in ("rows", *_FEATURES)
    ])
    totals = scored.select(F.inline(entries)).groupBy("outcome", "feature").agg(F.sum("part").alias("total"))
    return totals.select("outcome", "feature", F.round("total", 3).alias("total"))


@query("outcome_boosting_challenger")
def outcome_boosting_challenger(t: Tables) -> DataFrame:
    rows = _outcome_rows(t)
    models = M.fit_outcome_boosting(rows.filter("season < 1999"), _FEATURES, "label", 3, 3, 3, seed=7)
    return _rounded(M.boosting_probabilities(models, rows.filter("season >= 1999").select("match_id", *_FEATURES), _NAMES), 4)


_PLATT_ROUNDS = 12
_PLATT_SQL = f"""WITH RECURSIVE {_FC}, fit(i, a, b) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, a + (g0 * h11 - g1 * h01) / (h00 * h11 - h01 * h01), b + (g1 * h00 - g0 * h01) / (h00 * h11 - h01 * h01) FROM (
    SELECT i, a, b, sum(y - q) AS g0, sum((y - q) * p) AS g1, sum(q * (1 - q)) AS h00, sum(q * (1 - q) * p) AS h01, sum(q * (1 - q) * p * p) AS h11
    FROM (SELECT i, a, b, y, p, 1 / (1 + exp(-(a + b * p))) AS q FROM fit, fc WHERE seg = 0 AND i < {_PLATT_ROUNDS}) GROUP BY i, a, b))
SELECT doc_id, y, seg, round(p, 4) AS p, round(1 / (1 + exp(-(a + b * p))), 4) AS p_calibrated
FROM fc, (SELECT a, b FROM fit WHERE i = {_PLATT_ROUNDS})"""


@query("platt_calibration", _PLATT_SQL)
def platt_calibration(t: Tables) -> DataFrame:
    rows = _forecasts(t)
    return _rounded(L.apply_platt(L.fit_platt(rows.filter("seg = 0"), "p", "y"), rows, "p_calibrated"), 4)


# Each fitted value is the largest, over scores up to its own, of the least mean label of a stretch that begins there and holds it.
_ISO_SQL = f"""WITH {_FC}, d AS (SELECT p, count(*) AS w, sum(y) AS s FROM fc WHERE seg = 0 GROUP BY p),
  c AS (SELECT p, row_number() OVER (ORDER BY p) AS i, sum(w) OVER (ORDER BY p) AS w, sum(s) OVER (ORDER BY p) AS s, w AS own_w, s AS own_s FROM d),
  m AS (SELECT a.i AS a, b.i AS b, (b.s - a.s + a.own_s) / CAST(b.w - a.w + a.own_w AS DOUBLE) AS mean FROM c a JOIN c b ON a.i <= b.i),
  least_ AS (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM m),
  f AS (SELECT c.p, max(v) AS v FROM least_ JOIN c USING (i) GROUP BY c.p),
  n AS (SELECT fc.*, (SELECT max(p) FROM f WHERE f.p <= fc.p) AS lo, (SELECT min(p) FROM f WHERE f.p >= fc.p) AS hi FROM fc)
SELECT doc_id, y, seg, round(n.p, 4) AS p, round(CASE WHEN lo IS NULL THEN h.v WHEN hi IS NULL OR lo = hi THEN l.v
  ELSE l.v + (h.v - l.v) * (n.p - lo) / (hi - lo) END, 4) AS p_calibrated
FROM n LEFT JOIN f l ON l.p = lo LEFT JOIN f h ON h.p = hi"""


@query("isotonic_calibration", _ISO_SQL)
def isotonic_calibration(t: Tables) -> DataFrame:
    rows = _forecasts(t)
    return _rounded(I.apply_isotonic(I.fit_isotonic(rows.filter("seg = 0"), "p", "y"), rows, "p", "p_calibrated", ["doc_id", "y", "seg"]), 4)
