"""Dataset consistency checks over plans, fixtures and version chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import state_rank
from knownby.operators import checks as K
from knownby.operators.decisions import combine_states, market_catalog
from knownby.plans.registry import Tables, query

_OFFSETS = ("T-24h", "T-1h", "T-15m")

# One kickoff group per customer. Remainders of the id spoil cutoffs in known ways.
_GROUPS = """
g AS (SELECT c_custkey AS k, 'G' || (CASE WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END) AS group_id,
        TIMESTAMP '2024-08-16 19:00:00' + c_custkey * INTERVAL 1 HOUR AS kickoff FROM customer),
gc AS (SELECT k, group_id, kickoff, 'T-24h' AS cutoff, 86400 AS seconds, kickoff - INTERVAL 24 HOUR - (CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) * INTERVAL 1 MINUTE AS cat FROM g
       UNION ALL SELECT k, group_id, kickoff, 'T-1h', 3600, kickoff - INTERVAL 1 HOUR FROM g WHERE k % 11 <> 0
       UNION ALL SELECT k, group_id, kickoff, 'T-15m', 900, kickoff - INTERVAL 15 MINUTE FROM g),
qy AS (SELECT CASE WHEN k % 13 = 0 THEN 'G-lost' || k ELSE group_id END AS group_id, CASE WHEN k % 17 = 0 AND cutoff = 'T-15m' THEN 'T-5m' ELSE cutoff END AS cutoff,
         cat + (CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END) * INTERVAL 1 SECOND AS cat FROM gc)
"""


def _groups(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    kickoff = F.timestamp_micros(
        F.unix_micros(F.lit("2024-08-16 19:00:00").cast("timestamp")) + k * F.lit(3_600_000_000)
    )

    def before(seconds: int, extra=None):
        micros = F.unix_micros("kickoff") - F.lit(seconds * 1_000_000)
        return F.timestamp_micros(micros if extra is None else micros - extra)

    late = F.when(F.col("k") % 7 == 0, 60_000_000).otherwise(0)
    full = F.create_map(
        F.lit("T-24h"), before(86400, late), F.lit("T-1h"), before(3600), F.lit("T-15m"), before(900)
    )
    return (
        t.customer.select(
            k.alias("k"),
            F.concat(F.lit("G"), F.when(k % 50 == 49, k - 1).otherwise(k).cast("string")).alias("group_id"),
            kickoff.alias("kickoff"),
        )
        .withColumn(
            "cutoffs",
            F.when(F.col("k") % 11 == 0, F.map_filter(full, lambda name, _: name != "T-1h")).otherwise(full),
        )
    )


def _queries(t: Tables) -> DataFrame:
    k = F.col("k")
    each = _groups(t).select("k", "group_id", F.explode("cutoffs").alias("cutoff", "at"))
    shifted = F.timestamp_micros(F.unix_micros("at") + F.when(k % 19 == 0, 1_000_000).otherwise(0))
    return each.select(
        F.when(k % 13 == 0, F.concat(F.lit("G-lost"), k.cast("string"))).otherwise(F.col("group_id")).alias("group_id"),
        F.when((k % 17 == 0) & (F.col("cutoff") == "T-15m"), "T-5m").otherwise(F.col("cutoff")).alias("cutoff"),
        shifted.alias("requested_at"),
    )


@query(
    "plan_cutoff_check",
    "WITH " + _GROUPS + """SELECT 'DUPLICATE_GROUP' AS code, group_id AS subject, CAST(count(*) AS VARCHAR) AS detail FROM g GROUP BY group_id HAVING count(*) > 1
      UNION ALL SELECT 'MISSING_CUTOFF', group_id || '|T-1h', NULL FROM g WHERE k % 11 = 0
      UNION ALL SELECT 'CUTOFF_DELTA_MISMATCH', group_id || '|' || cutoff, CAST(CAST(epoch(kickoff - cat) AS BIGINT) AS VARCHAR)
        FROM gc WHERE epoch(kickoff - cat) <> seconds""",
)
def plan_cutoff_check(t: Tables) -> DataFrame:
    return K.plan_cutoff_violations(_groups(t))


@query(
    "plan_query_check",
    "WITH " + _GROUPS + """, s AS (SELECT DISTINCT group_id, cutoff, cat FROM gc), o AS (SELECT DISTINCT group_id, cutoff, cat FROM qy)
      SELECT 'UNKNOWN_GROUP' AS code, group_id AS subject, NULL AS detail FROM (SELECT DISTINCT group_id FROM qy WHERE group_id NOT IN (SELECT group_id FROM g))
      UNION ALL SELECT 'UNEXPECTED_CUTOFF', group_id || '|' || cutoff, NULL FROM qy WHERE cutoff NOT IN ('T-24h', 'T-1h', 'T-15m')
      UNION ALL SELECT 'DUPLICATE_QUERY', group_id || '|' || cutoff, CAST(count(*) AS VARCHAR) FROM qy GROUP BY group_id, cutoff HAVING count(*) > 1
      UNION ALL SELECT 'QUERY_SET_MISMATCH', group_id || '|' || cutoff || '|' || strftime(cat, '%Y-%m-%d %H:%M:%S'), 'declared only' FROM (SELECT * FROM s EXCEPT SELECT * FROM o)
      UNION ALL SELECT 'QUERY_SET_MISMATCH', group_id || '|' || cutoff || '|' || strftime(cat, '%Y-%m-%d %H:%M:%S'), 'observed only' FROM (SELECT * FROM o EXCEPT SELECT * FROM s)""",
)
def plan_query_check(t: Tables) -> DataFrame:
    return K.plan_query_violations(_queries(t), _groups(t), _OFFSETS)


# Fixtures per order: week by id, teams by customer nation.
_FIXTURES = """
f AS (SELECT o_orderkey AS i, CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 'MW' || (o_orderkey % 5 + 1) END AS week,
        'Club ' || o_custkey % 20 AS home, 'Club ' || (o_custkey + o_orderkey) % 20 AS away,
        'K' || o_custkey % 20 AS hk, 'K' || (o_custkey + o_orderkey) % 20 AS ak,
        o_orderdate AS kickoff, 'G' || o_orderkey % 40 AS grp FROM orders),
gr AS (SELECT 'G' || o_orderkey % 40 AS grp, min(o_orderdate) AS kickoff FROM orders WHERE o_orderkey % 40 < 38 GROUP BY ALL)
"""


def _fixtures(t: Tables) -> DataFrame:
    i, c = F.col("o_orderkey"), F.col("o_custkey")

    def named(prefix: str, number):
        return F.concat(F.lit(prefix), number.cast("string"))

    return t.orders.select(
        i.alias("fixture_index"),
        F.when(i % 101 != 0, named("MW", i % 5 + 1)).alias("matchweek"),
        named("Club ", c % 20).alias("official_home_name"),
        named("Club ", (c + i) % 20).alias("official_away_name"),
        named("K", c % 20).alias("home_key"),
        named("K", (c + i) % 20).alias("away_key"),
        F.col("o_orderdate").alias("kickoff"),
        named("G", i % 40).alias("kickoff_group_id"),
        F.when(i % 97 == 0, "event-1").alias("canonical_event_id"),
        F.when(i % 89 == 0, F.create_map(F.lit("p"), F.lit("1")))
        .when(i % 89 != 1, F.create_map().cast("map<string,string>"))
        .alias("provider_event_ids"),
    )


@query(
    "fixture_check",
    "WITH " + _FIXTURES + """SELECT 'INVALID_IDENTITY_FIELDS' AS code, CAST(i AS VARCHAR) AS subject, NULL AS detail FROM f WHERE week IS NULL
      UNION ALL SELECT 'UNEXPECTED_MATCHWEEK', CAST(i AS VARCHAR), NULL FROM f WHERE week = 'MW5'
      UNION ALL SELECT 'SELF_MATCH', CAST(i AS VARCHAR), NULL FROM f WHERE home = away
      UNION ALL SELECT 'UNKNOWN_GROUP', CAST(i AS VARCHAR), NULL FROM f WHERE grp NOT IN (SELECT grp FROM gr)
      UNION ALL SELECT 'GROUP_KICKOFF_MISMATCH', CAST(i AS VARCHAR), NULL FROM f JOIN gr ON f.grp = gr.grp WHERE f.kickoff <> gr.kickoff
      UNION ALL SELECT 'CANONICAL_ID_ASSIGNED', CAST(i AS VARCHAR), NULL FROM f WHERE i % 97 = 0
      UNION ALL SELECT 'PROVIDER_IDS_NOT_EMPTY', CAST(i AS VARCHAR), NULL FROM f WHERE i % 89 IN (0, 1)
      UNION ALL SELECT 'DUPLICATE_FIXTURE', home || '|' || away || '|' || strftime(kickoff, '%Y-%m-%d %H:%M:%S'), CAST(count(*) AS VARCHAR) FROM f GROUP BY home, away, kickoff HAVING count(*) > 1
      UNION ALL SELECT 'DUPLICATE_FIXTURE_IDENTITY', strftime(kickoff, '%Y-%m-%d %H:%M:%S') || '|' || hk || '|' || ak, CAST(count(*) AS VARCHAR) FROM f GROUP BY kickoff, hk, ak HAVING count(*) > 1""",
)
def fixture_check(t: Tables) -> DataFrame:
    groups = t.orders.filter("o_orderkey % 40 < 38").select(
        F.concat(F.lit("G"), (F.col("o_orderkey") % 40).cast("string")).alias("group_id"),
        F.col("o_orderdate").alias("kickoff"),
    )
    return K.fixture_violations(_fixtures(t), groups, ("MW1", "MW2", "MW3", "MW4"))


@query(
    "team_week_appearances",
    "WITH " + _FIXTURES + """SELECT 'TEAM_WEEK_COUNT' AS code, coalesce(week || '|', '') || team AS subject, CAST(count(*) AS VARCHAR) AS detail FROM
      (SELECT week, home AS team FROM f UNION ALL SELECT week, away FROM f) GROUP BY week, team HAVING count(*) <> (SELECT greatest(1, count(*) // 50) FROM f)""",
)
def team_week_appearances(t: Tables) -> DataFrame:
    fixtures = _fixtures(t)
    return K.team_appearances(
        fixtures, "matchweek", "official_home_name", "official_away_name", expected=max(1, fixtures.count() // 50)
    )


@query(
    "fixtures_per_week",
    "WITH " + _FIXTURES + """, d AS (SELECT unnest(['MW1', 'MW2', 'MW3', 'MW4', 'MW5', 'MW6']) AS week)
      SELECT 'WEEK_FIXTURE_COUNT' AS code, d.week AS subject, CAST(count(f.i) AS VARCHAR) AS detail FROM d LEFT JOIN f ON d.week = f.week
      GROUP BY d.week HAVING count(f.i) <> 10""",
)
def fixtures_per_week(t: Tables) -> DataFrame:
    weeks = t.nation.filter("n_nationkey between 1 and 6").select(
        F.concat(F.lit("MW"), F.col("n_nationkey").cast("string")).alias("matchweek")
    )
    return K.group_cardinality(_fixtures(t), ["matchweek"], 10, "WEEK_FIXTURE_COUNT", domain=weeks)


@query(
    "declared_team_keys",
    "WITH " + _FIXTURES + """, o AS (SELECT hk AS key FROM f UNION SELECT ak FROM f), d AS (SELECT DISTINCT 'K' || n_nationkey AS key FROM nation WHERE n_nationkey % 3 <> 0)
      SELECT 'TEAM_KEYS_MISMATCH' AS code, key AS subject, 'declared only' AS detail FROM (SELECT key FROM d EXCEPT SELECT key FROM o)
      UNION ALL SELECT 'TEAM_KEYS_MISMATCH', key, 'observed only' FROM (SELECT key FROM o EXCEPT SELECT key FROM d)""",
)
def declared_team_keys(t: Tables) -> DataFrame:
    observed = _fixtures(t).select(F.explode(F.array("home_key", "away_key")).alias("key"))
    declared = t.nation.filter("n_nationkey % 3 <> 0").select(
        F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("key")
    )
    return K.set_difference(declared, observed, ["key"], "TEAM_KEYS_MISMATCH")


@query(
    "alias_target_reference",
    """SELECT 'UNKNOWN_ALIAS_TARGET' AS code, CAST(o_custkey AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS detail FROM (SELECT DISTINCT o_custkey FROM orders)
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def alias_target_reference(t: Tables) -> DataFrame:
    return K.unknown_reference(
        t.orders, "o_custkey", t.customer.filter("c_mktsegment <> 'BUILDING'"), "c_custkey", "UNKNOWN_ALIAS_TARGET"
    )


@query(
    "contiguous_fixture_index",
    """WITH v AS (SELECT CASE WHEN o_orderkey % 500 = 3 THEN o_orderkey + 1 ELSE o_orderkey END AS i FROM orders WHERE o_orderkey % 700 <> 9),
       c AS (SELECT i, count(*) AS n FROM v GROUP BY i),
       x AS (SELECT i, lag(i, 1, 0) OVER (ORDER BY i) AS p FROM (SELECT i FROM c WHERE i BETWEEN 1 AND (SELECT count(*) FROM orders) UNION ALL SELECT count(*) + 1 FROM orders))
       SELECT 'DUPLICATE_INDEX' AS code, CAST(i AS VARCHAR) AS subject, CAST(n AS VARCHAR) AS detail FROM c WHERE n > 1
       UNION ALL SELECT 'INDEX_OUT_OF_RANGE', CAST(i AS VARCHAR), NULL FROM c WHERE i NOT BETWEEN 1 AND (SELECT count(*) FROM orders)
       UNION ALL SELECT 'MISSING_INDEX', CAST(p + 1 AS VARCHAR), CAST(i - 1 AS VARCHAR) FROM x WHERE i - p > 1""",
)
def contiguous_fixture_index(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    index = t.orders.filter(k % 700 != 9).select(F.when(k % 500 == 3, k + 1).otherwise(k).alias("i"))
    return K.contiguous_index(index, "i", t.orders.count())


@query(
    "market_catalog_lookup",
    """SELECT fam AS market_family, CASE WHEN fam <> 'FOOTBALL_CORNERS' THEN 'FOOTBALL' END AS sport,
         CASE WHEN fam IN ('FOOTBALL_1X2', 'FOOTBALL_TOTAL_GOALS_MAIN') THEN 'PHASE_1' WHEN fam <> 'FOOTBALL_CORNERS' THEN 'PHASE_2' END AS phase,
         CASE WHEN fam <> 'FOOTBALL_CORNERS' THEN 'MR2' END AS mr_base, count(*) AS rows
       FROM (SELECT CASE p_partkey % 6 WHEN 0 THEN 'FOOTBALL_1X2' WHEN 1 THEN 'FOOTBALL_TOTAL_GOALS_MAIN' WHEN 2 THEN 'FOOTBALL_ASIAN_HANDICAP'
         WHEN 3 THEN 'FOOTBALL_BTTS' WHEN 4 THEN 'FOOTBALL_TEAM_TOTALS' ELSE 'FOOTBALL_CORNERS' END AS fam FROM part) GROUP BY ALL""",
)
def market_catalog_lookup(t: Tables) -> DataFrame:
    families = F.array(*[F.lit(x) for x in (
        "FOOTBALL_1X2", "FOOTBALL_TOTAL_GOALS_MAIN", "FOOTBALL_ASIAN_HANDICAP", "FOOTBALL_BTTS",
        "FOOTBALL_TEAM_TOTALS", "FOOTBALL_CORNERS",
    )])
    rows = t.part.select(F.get(families, (F.col("p_partkey") % 6).cast("int")).alias("market_family"))
    counted = rows.groupBy("market_family").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(F.broadcast(market_catalog(t.spark)), "market_family", "left").select(
        "market_family", "sport", "phase", "mr_base", "rows"
    )


@query(
    "snapshot_request_grid",
    """WITH f AS (SELECT DISTINCT 'G' || strftime(o_orderdate, '%Y%m%d') AS group_id, o_orderdate AS kickoff FROM orders),
       o(cutoff, s, slug) AS (VALUES ('T-24h', 86400, 't24h'), ('T-1h', 3600, 't1h'), ('T-15m', 900, 't15m'))
       SELECT group_id, cutoff, epoch_us(kickoff - s * INTERVAL 1 SECOND) AS requested_micros, 'stage-a-' || lower(group_id) || '-' || slug AS probe_name,
         'https://provider.example/v4/odds?regions=eu&markets=h2h,totals&oddsFormat=decimal&date='
         || replace(strftime(kickoff - s * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ'), ':', '%3A') AS url FROM f, o""",
)
def snapshot_request_grid(t: Tables) -> DataFrame:
    return _grid(t).select("group_id", "cutoff", F.unix_micros("requested_at").alias("requested_micros"), "probe_name", "url")


def _grid(t: Tables) -> DataFrame:
    fixtures = t.orders.select(
        F.concat(F.lit("G"), F.date_format("o_orderdate", "yyyyMMdd")).alias("kickoff_group_id"),
        F.col("o_orderdate").alias("kickoff"),
    )
    return K.request_grid(
        fixtures, "https://provider.example/v4/odds",
        {"regions": "eu", "markets": "h2h,totals", "oddsFormat": "decimal"},
    )


@query(
    "request_slice",
    """WITH f AS (SELECT DISTINCT 'G' || strftime(o_orderdate, '%Y%m%d') AS group_id FROM orders),
       o(cutoff) AS (VALUES ('T-24h'), ('T-1h'), ('T-15m'))
       SELECT group_id, cutoff FROM f, o ORDER BY group_id, cutoff LIMIT 100 OFFSET 40""",
)
def request_slice(t: Tables) -> DataFrame:
    return K.request_slice(_grid(t).select("group_id", "cutoff"), ["group_id", "cutoff"], 40, 100)


@query(
    "request_credits",
    "SELECT 3 * count(DISTINCT o_orderdate) AS request_count, 60 * count(DISTINCT o_orderdate) AS credits FROM orders",
)
def request_credits(t: Tables) -> DataFrame:
    return K.estimated_credits(_grid(t), 20)


@query(
    "assessment_version_chain",
    """WITH a AS (SELECT 'S' || c_nationkey % 3 AS sport, 'F' || c_nationkey % 4 AS fam, CASE WHEN c_nationkey % 5 > 0 THEN 'C' || c_nationkey % 5 END AS comp,
         o_orderkey // 3 AS v, TIMESTAMP '2020-01-01' + o_orderkey * INTERVAL 1 HOUR - (CASE WHEN o_orderkey % 53 = 0 THEN 10000 ELSE 0 END) * INTERVAL 1 HOUR AS known
         FROM orders JOIN customer ON o_custkey = c_custkey),
       s AS (SELECT sport || '|' || fam || '|' || coalesce(comp, '-') AS sc, v, count(*) AS n, min(known) AS lo, max(known) AS hi FROM a GROUP BY ALL),
       l AS (SELECT *, lag(hi) OVER (PARTITION BY sc ORDER BY v) AS prior FROM s)
       SELECT 'ASSESSMENT_VERSION_NOT_INCREASING' AS code, sc || '|' || v AS subject, CAST(n AS VARCHAR) AS detail FROM s WHERE n > 1
       UNION ALL SELECT 'ASSESSMENT_KNOWN_AT_REGRESSION', sc || '|' || v, NULL FROM l WHERE lo < prior""",
)
def assessment_version_chain(t: Tables) -> DataFrame:
    return K.successor_violations(order_assessments(t))


def order_assessments(t: Tables) -> DataFrame:
    n, k = F.col("c_nationkey"), F.col("o_orderkey")
    hours = k - F.when(k % 53 == 0, 10_000).otherwise(0)
    known = F.timestamp_micros(
        F.unix_micros(F.lit("2020-01-01 00:00:00").cast("timestamp")) + hours * F.lit(3_600_000_000)
    )
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("S"), (n % 3).cast("string")).alias("sport"),
        F.concat(F.lit("F"), (n % 4).cast("string")).alias("market_family"),
        F.when(n % 5 > 0, F.concat(F.lit("C"), (n % 5).cast("string"))).alias("competition"),
        F.floor(k / 3).alias("assessment_version"),
        known.alias("known_at"),
    )


@query(
    "combined_decision_states",
    """WITH d AS (SELECT user_id, CASE event_type WHEN 'signup' THEN 'QUALIFIED' WHEN 'click' THEN 'NO_BET' WHEN 'view' THEN 'WAIT'
         WHEN 'purchase' THEN 'REVIEW' ELSE 'BLOCKED' END AS state FROM events)
       SELECT user_id, CASE max(CASE state WHEN 'QUALIFIED' THEN 0 WHEN 'NO_BET' THEN 1 WHEN 'WAIT' THEN 2 WHEN 'REVIEW' THEN 3 ELSE 4 END)
         WHEN 0 THEN 'QUALIFIED' WHEN 1 THEN 'NO_BET' WHEN 2 THEN 'WAIT' WHEN 3 THEN 'REVIEW' ELSE 'BLOCKED' END AS state,
         CAST(max(CASE state WHEN 'QUALIFIED' THEN 0 WHEN 'NO_BET' THEN 1 WHEN 'WAIT' THEN 2 WHEN 'REVIEW' THEN 3 ELSE 4 END) AS INTEGER) AS precedence
       FROM d GROUP BY user_id""",
)
def combined_decision_states(t: Tables) -> DataFrame:
    names = {"signup": "QUALIFIED", "click": "NO_BET", "view": "WAIT", "purchase": "REVIEW", "error": "BLOCKED"}
    state = F.lit(None).cast("string")
    for event, name in names.items():
        state = F.when(F.col("event_type") == event, F.lit(name)).otherwise(state)
    rows = t.events.select("user_id", state.alias("state"))
    return combine_states(rows, ["user_id"]).withColumn("precedence", state_rank(F.col("state")))


@query(
    "declared_plan_document",
    """WITH d AS (SELECT c_custkey AS k FROM customer)
       SELECT code, CAST(k AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS detail FROM (
         SELECT k, 'GROUP_COUNT_DECLARED' AS code FROM d WHERE k % 5 = 0 UNION ALL SELECT k, 'CUTOFFS_DECLARED' FROM d WHERE k % 7 = 0
         UNION ALL SELECT k, 'QUERY_COUNT_DECLARED' FROM d WHERE k % 11 IN (0, 1) UNION ALL SELECT k, 'GROUP_COUNT' FROM d WHERE k % 13 = 0
         UNION ALL SELECT k, 'QUERY_COUNT' FROM d WHERE k % 17 = 0)""",
)
def declared_plan_document(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    cutoffs = [F.lit(c) for c in _OFFSETS]
    documents = t.customer.select(
        k.alias("k"),
        F.when(k % 5 == 0, 22).otherwise(23).alias("kickoff_group_count"),
        F.when(k % 7 == 0, F.array(*reversed(cutoffs))).otherwise(F.array(*cutoffs)).alias("cutoffs_per_group"),
        F.when(k % 11 == 0, 70).when(k % 11 != 1, 69).alias("planned_query_count"),
        F.sequence(F.lit(1), F.when(k % 13 == 0, 24).otherwise(23)).alias("kickoff_groups"),
        F.sequence(F.lit(1), F.when(k % 17 == 0, 68).otherwise(69)).alias("query_plan"),
    )
    return K.declared_plan_violations(documents, "k", 23, _OFFSETS)


@query(
    "declared_fixture_document",
    """WITH d AS (SELECT o_orderkey AS k FROM orders)
       SELECT code, CAST(k AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS detail FROM (
         SELECT k, 'FIXTURE_COUNT_DECLARED' AS code FROM d WHERE k % 5 = 0 UNION ALL SELECT k, 'FIXTURE_COUNT' FROM d WHERE k % 7 = 0
         UNION ALL SELECT k, 'WEEKS_DECLARED' FROM d WHERE k % 11 = 0 UNION ALL SELECT k, 'TEAM_KEY_COUNT' FROM d WHERE k % 13 = 0
         UNION ALL SELECT k, 'TEAM_KEYS_REPEATED' FROM d WHERE k % 17 = 0 UNION ALL SELECT k, 'ALIAS_MAP' FROM d WHERE k % 19 IN (0, 1))""",
)
def declared_fixture_document(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")

    def keys(count, repeated):
        numbers = F.sequence(F.lit(1), count)
        return F.transform(numbers, lambda n: F.concat(F.lit("K"), F.when(repeated & (n == 2), 1).otherwise(n).cast("string")))

    documents = t.orders.select(
        k.alias("k"),
        F.when(k % 5 == 0, 41).otherwise(40).alias("fixture_count"),
        F.sequence(F.lit(1), F.when(k % 7 == 0, 39).otherwise(40)).alias("fixtures"),
        F.when(k % 11 == 0, F.array(F.lit("MW1"))).otherwise(F.array(F.lit("MW1"), F.lit("MW2"))).alias("matchweeks"),
        keys(F.when(k % 13 == 0, 19).otherwise(20), k % 17 == 0).alias("source_identity_team_keys"),
        F.when(k % 19 == 0, F.create_map(F.lit("Short"), F.lit("Other")))
        .when(k % 19 != 1, F.create_map(F.lit("Short"), F.lit("Long")))
        .alias("source_label_aliases"),
    )
    return K.declared_fixture_violations(documents, "k", 40, ("MW1", "MW2"), 20, {"Short": "Long"})
