"""Queries at the edges of a job: refused inputs as codes, files written and read back, local readings, value runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.functions import timeops
from knownby.operators import checks as K
from knownby.operators import features as X
from knownby.operators import quality as Q
from knownby.operators.asof import select_one_key
from knownby.operators.decisions import combine_declared
from knownby.plans.kernel import _ONE, CUTOFF, lineitem_observations
from knownby.plans.records import _ZONES, _pick, _pick_sql
from knownby.plans.registry import Tables, query
from knownby.plans.research import _MT, order_matches
from knownby.sources.documents import read_documents
from knownby.sources.sinks import read_ordered, write_ordered
from knownby.sources.text_lines import read_numbered_lines
from knownby.storage import shared_folder


def _fresh_path(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/knownby-{uuid.uuid4().hex}"


# ---- refused inputs as rows -------------------------------------------------------------


@query(
    "wall_time_violations",
    f"""WITH w AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 48) * INTERVAL 30 MINUTE AS wall, {_pick_sql('o_orderkey', _ZONES)} AS zone FROM orders),
      k AS (SELECT *, CASE WHEN zone = 'Not/AZone' THEN 'UTC' ELSE zone END AS z FROM w), u AS (SELECT *, wall AT TIME ZONE z AS i FROM k)
      SELECT o_orderkey, zone, 'INVALID_TIMEZONE' AS code FROM u WHERE zone = 'Not/AZone' OR (i AT TIME ZONE z) <> wall
        OR ((i + INTERVAL 1 HOUR) AT TIME ZONE z) = wall OR ((i - INTERVAL 1 HOUR) AT TIME ZONE z) = wall
        OR ((i + INTERVAL 30 MINUTE) AT TIME ZONE z) = wall OR ((i - INTERVAL 30 MINUTE) AT TIME ZONE z) = wall""",
)
def wall_time_violations(t: Tables) -> DataFrame:
    """Wall times without one instant: unknown zones, repeated and skipped hours."""
    wall = F.timestamp_micros(F.unix_micros("o_orderdate") + (F.col("o_orderkey") % 48) * F.lit(1_800_000_000))
    rows = t.orders.select("o_orderkey", wall.alias("wall"), _pick("o_orderkey", _ZONES).alias("zone"))
    known = F.col("zone").isin(*[z for z in _ZONES if z != "Not/AZone"])
    _, status = timeops.localize_strict(F.col("wall"), F.col("zone"), known)
    return rows.select("o_orderkey", "zone", timeops.zone_violation(status).alias("code")).filter("code is not null")


@query(
    "declared_decision_states",
    """WITH d AS (SELECT user_id, CASE WHEN user_id % 4 > 0 THEN 's' || user_id % 4 END AS seg, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS rank FROM events),
      g AS (SELECT DISTINCT user_id, seg FROM d UNION SELECT user_id + 1000000, seg FROM d WHERE user_id % 3 = 0 UNION SELECT user_id, '-' FROM d WHERE seg IS NULL),
      b AS (SELECT user_id, seg, max(rank) AS top FROM d WHERE rank IS NOT NULL GROUP BY ALL)
      SELECT g.user_id, g.seg, CASE top WHEN 1 THEN 'NO_BET' WHEN 2 THEN 'WAIT' WHEN 3 THEN 'REVIEW' WHEN 4 THEN 'BLOCKED' END AS state, CASE WHEN top IS NULL THEN 'NO_STATES' END AS code
      FROM g LEFT JOIN b ON g.user_id = b.user_id AND g.seg IS NOT DISTINCT FROM b.seg""",
)
def declared_decision_states(t: Tables) -> DataFrame:
    """Declared groups with a null segment and with the segment "-" are two groups; those without any state say so."""
    user = F.col("user_id")
    state = F.create_map(*[F.lit(x) for x in ("click", "NO_BET", "view", "WAIT", "purchase", "REVIEW", "error", "BLOCKED")])
    rows = t.events.select(
        user, F.when(user % 4 > 0, F.concat(F.lit("s"), (user % 4).cast("string"))).alias("seg"),
        F.try_element_at(state, F.col("event_type")).alias("state"),
    )
    declared = rows.select("user_id", "seg").union(rows.filter(user % 3 == 0).select(user + 1_000_000, "seg")).union(
        rows.filter("seg is null").select("user_id", F.lit("-"))
    )
    return combine_declared(declared, rows, ["user_id", "seg"])


@query(
    "declared_assessment_successors",
    """WITH a AS (SELECT o_orderkey AS id, o_orderkey - CASE WHEN o_orderkey % 4 = 0 THEN 32 ELSE 64 END AS prev, c_nationkey % 2 AS sport, 'F' AS fam, CASE WHEN c_nationkey % 3 > 0 THEN 'C' END AS comp,
         o_orderkey // 3 % 50 AS v, TIMESTAMP '2020-01-01' + o_orderkey * INTERVAL 1 HOUR - (CASE WHEN o_orderkey % 53 = 0 THEN 10000 ELSE 0 END) * INTERVAL 1 HOUR AS known
         FROM orders JOIN customer ON o_custkey = c_custkey),
       j AS (SELECT a.id, a.prev, CASE WHEN b.id IS NULL THEN 'REFERENCE_UNKNOWN' WHEN a.sport <> b.sport OR a.comp IS DISTINCT FROM b.comp THEN 'ASSESSMENT_SCOPE_MISMATCH'
         WHEN a.v <= b.v THEN 'ASSESSMENT_VERSION_NOT_INCREASING' WHEN a.known < b.known THEN 'ASSESSMENT_KNOWN_AT_REGRESSION' END AS code
         FROM a LEFT JOIN a b ON a.prev = b.id)
       SELECT code, CAST(id AS VARCHAR) AS subject, CAST(prev AS VARCHAR) AS detail FROM j WHERE code IS NOT NULL""",
)
def declared_assessment_successors(t: Tables) -> DataFrame:
    n, k = F.col("c_nationkey"), F.col("o_orderkey")
    hours = k - F.when(k % 53 == 0, 10_000).otherwise(0)
    start = F.unix_micros(F.lit("2020-01-01 00:00:00").cast("timestamp"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("id"), (k - F.when(k % 4 == 0, 32).otherwise(64)).alias("previous"), (n % 2).alias("sport"), F.lit("F").alias("market_family"),
        F.when(n % 3 > 0, "C").alias("competition"), (F.floor(k / 3) % 50).alias("assessment_version"),
        F.timestamp_micros(start + hours * F.lit(3_600_000_000)).alias("known_at"),
    )
    return K.declared_successor_violations(rows, "id", "previous")


@query("pit_single_key", _ONE + "SELECT logical_key, status, selected_record_digest, distinct_count, input_count FROM outc WHERE logical_key = (SELECT min(logical_key) FROM outc)")
def pit_single_key(t: Tables) -> DataFrame:
    """The guarded form for one key, here the first one."""
    observations = lineitem_observations(t)
    key = observations.agg(F.min("logical_key").alias("key"))
    one = observations.join(F.broadcast(key), F.col("logical_key") == F.col("key")).drop("key")
    return select_one_key(one, CUTOFF).outcomes.select("logical_key", "status", "selected_record_digest", "distinct_count", "input_count")


@query(
    "expanding_folds",
    """WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS rows FROM orders GROUP BY ALL),
       n AS (SELECT *, row_number() OVER (ORDER BY season) AS n, count(*) OVER () AS total FROM s),
       f AS (SELECT n.*, g.range AS fold_id FROM n, range(1, 100) g WHERE g.range <= total - 3)
       SELECT CAST(fold_id AS INTEGER) AS fold_id, CASE WHEN n <= fold_id THEN 'TRAIN' WHEN n = fold_id + 1 THEN 'VALIDATION' WHEN n = fold_id + 2 THEN 'CALIBRATION' ELSE 'EVALUATION' END AS role,
         season, rows FROM f WHERE n <= fold_id + 3""",
)
def expanding_folds(t: Tables) -> DataFrame:
    """Training grows over all earlier seasons."""
    rows = t.orders.select(F.year("o_orderdate").alias("season"))
    return X.walk_forward_folds(rows, "season", None, 1, 1, 1)


# ---- files written and read back --------------------------------------------------------


@query(
    "ordered_report",
    """SELECT row_number() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) AS ordinal, c_mktsegment, c_nationkey, c_custkey FROM customer""",
)
def ordered_report(t: Tables) -> DataFrame:
    """Written in canonical order in several files; their order and that of their lines is the order of the rows."""
    path = _fresh_path(t)
    rows = t.customer.select("c_mktsegment", "c_nationkey", "c_custkey")
    write_ordered(rows, ["c_mktsegment", "c_nationkey", "c_custkey"], path, rows_per_file=250)
    return read_ordered(t.spark, path, "c_mktsegment string, c_nationkey int, c_custkey long").select(
        "ordinal", "c_mktsegment", F.col("c_nationkey").cast(t.customer.schema["c_nationkey"].dataType).alias("c_nationkey"), "c_custkey"
    )


@query(
    "numbered_lines_round_trip",
    """WITH l AS (SELECT c_nationkey AS nation, c_custkey AS k, unnest(CASE WHEN c_custkey % 7 = 0 THEN ['line ' || c_custkey, 'more of it'] ELSE ['line ' || c_custkey] END) AS text,
         unnest(CASE WHEN c_custkey % 7 = 0 THEN [1, 2] ELSE [1] END) AS piece FROM customer)
       SELECT CAST(nation AS INTEGER) AS nation, row_number() OVER (PARTITION BY nation ORDER BY k, piece) AS line_number, text FROM l""",
)
def numbered_lines_round_trip(t: Tables) -> DataFrame:
    """One text file per nation, some lines ended by a line separator inside; numbered from 1 in every file."""
    path = _fresh_path(t)
    k = F.col("c_custkey").cast("string")
    text = F.concat(F.lit("line "), k, F.when(F.col("c_custkey") % 7 == 0, "\u2028more of it").otherwise(""))
    rows = t.customer.select("c_nationkey", "c_custkey", text.alias("text")).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.select("c_nationkey", "text").write.partitionBy("c_nationkey").text(path)
    nation = F.regexp_extract("file", r"c_nationkey=(\d+)", 1).cast("int")
    return read_numbered_lines(t.spark, path).select(nation.alias("nation"), "line_number", "text")


@query(
    "json_document_round_trip",
    """SELECT n_name, n_regionkey, c_custkey, c_mktsegment FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def json_document_round_trip(t: Tables) -> DataFrame:
    """One JSON document per nation with its customers inside, read back with an explicit schema."""
    path = _fresh_path(t)
    members = t.customer.groupBy("c_nationkey").agg(F.collect_list(F.struct("c_custkey", "c_mktsegment")).alias("customers"))
    documents = t.nation.join(members, F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "n_name", "n_regionkey", "customers")
    documents.write.partitionBy("n_nationkey").json(path)
    kinds = dict(t.nation.dtypes) | dict(t.customer.dtypes)
    ddl = f"n_name string, n_regionkey {kinds['n_regionkey']}, customers array<struct<c_custkey: {kinds['c_custkey']}, c_mktsegment: string>>"
    return read_documents(t.spark, path, ddl).select("n_name", "n_regionkey", F.inline("customers"))


# ---- local readings and value runs -------------------------------------------------------

_LOCAL = ("Europe/London", "America/New_York", "Asia/Kathmandu")


@query(
    "local_time_cross_check",
    "WITH " + _MT + f""", z AS (SELECT *, {_pick_sql('match_id', _LOCAL)} AS zone FROM mt),
      f AS (SELECT match_id, season, timezone(zone, event_time::TIMESTAMP AT TIME ZONE 'UTC') AS at, home_team, away_team FROM z),
      r AS (SELECT match_id, season, timezone(zone, (event_time + CASE WHEN match_id % 13 = 0 THEN INTERVAL 1 DAY WHEN match_id % 9 = 0 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 DAY END)::TIMESTAMP AT TIME ZONE 'UTC') AS at,
        home_team, away_team FROM z WHERE match_id % 19 <> 0)
      SELECT count(f.match_id) AS fixtures, CAST(0 AS BIGINT) AS matchweek_mismatches, count(*) FILTER (CAST(f.at AS DATE) <> CAST(r.at AS DATE)) AS local_date_mismatches,
        count(*) FILTER (strftime(f.at, '%H:%M') <> strftime(r.at, '%H:%M')) AS local_time_mismatches, CAST(0 AS BIGINT) AS home_key_mismatches, CAST(0 AS BIGINT) AS away_key_mismatches,
        count(*) FILTER (r.match_id IS NULL) AS without_result, CAST(0 AS BIGINT) AS without_fixture, CAST(0 AS BIGINT) AS unaliased,
        count(*) FILTER (CAST(f.at AS DATE) <> CAST(r.at AS DATE) OR strftime(f.at, '%H:%M') <> strftime(r.at, '%H:%M')) AS mismatched_fixtures FROM f LEFT JOIN r USING (match_id)""",
)
def local_time_cross_check(t: Tables) -> DataFrame:
    """Dates and times as the clocks at the ground show them: a day added to an instant moves the clock by an hour over a change to summer time."""
    m = F.col("match_id")
    base = order_matches(t).withColumn("zone", _pick("match_id", _LOCAL))

    def shaped(df: DataFrame, at) -> DataFrame:
        date, time = timeops.local_reading(at, F.col("zone"))
        return df.select(
            "match_id", F.col("season").alias("matchweek"), date.alias("local_date"), time.alias("local_time"),
            F.col("home_team").alias("home_key"), F.col("away_team").alias("away_key"),
        )

    moved = F.when(m % 13 == 0, 86_400_000_000).when(m % 9 == 0, 1_800_000_000).otherwise(0)
    later = F.timestamp_micros(F.unix_micros("event_time") + moved)
    return Q.cross_check(shaped(base, F.col("event_time")), shaped(base.filter(m % 19 != 0), later), "match_id")


@query(
    "value_change_runs",
    """WITH p AS (SELECT l_suppkey % 40 AS provider, l_shipdate AS seen, l_orderkey AS k, l_linenumber AS n, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS v FROM lineitem),
      q AS (SELECT *, lag(v) OVER w AS b, row_number() OVER w AS i FROM p WINDOW w AS (PARTITION BY provider ORDER BY seen, k, n, v)),
      r AS (SELECT *, sum(CASE WHEN i = 1 OR v IS DISTINCT FROM b THEN 1 ELSE 0 END) OVER (PARTITION BY provider ORDER BY i) AS run FROM q),
      g AS (SELECT provider, run, count(*) AS c FROM r GROUP BY ALL)
      SELECT provider, CAST(sum(c) AS BIGINT) AS rows, count(*) AS runs, max(c) AS longest_run, count(*) - 1 AS changes FROM g GROUP BY provider""",
)
def value_change_runs(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        (F.col("l_suppkey") % 40).alias("provider"), F.col("l_shipdate").cast("timestamp").alias("seen"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("v"),
    )
    return Q.value_runs(rows, ["provider"], "seen", ["k", "n"], "v", block_rows=500)
