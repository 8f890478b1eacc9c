"""Reconciliation and coverage over fixtures and events projected from orders and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.operators import coverage as V
from knownby.operators.reconcile import Reconciliation
from knownby.plans.registry import Tables, query
from knownby.sources import snapshots
from knownby.sources.documents import alias_entries

_MATCHES = """
m AS (SELECT o_orderkey AS k, o_orderdate AS kickoff, c_nationkey AS h,
        (c_nationkey + 1 + o_orderkey % 24) % 25 AS a
      FROM orders JOIN customer ON o_custkey = c_custkey),
fx AS (SELECT k AS fixture_index, kickoff, 'NATION_' || h AS home_key, 'NATION_' || a AS away_key,
        'G' || strftime(kickoff, '%Y%m%d') || '-' || k % 3 AS kickoff_group_id FROM m WHERE k % 2 = 0),
e0 AS (SELECT * FROM m WHERE k % 10 NOT IN (0, 4) AND (k % 2 = 0 OR k % 3 = 0)),
ev AS (SELECT 'ev-' || k AS provider_event_id, kickoff, 'Club ' || h AS home, 'Club ' || a AS away, h, a FROM e0
       UNION ALL SELECT 'ev-' || k || '-b', kickoff, 'Club ' || h, 'Club ' || a, h, a FROM e0 WHERE k % 34 = 2),
evk AS (SELECT *, CASE WHEN h <> 7 THEN 'NATION_' || h END AS home_key, CASE WHEN a <> 7 THEN 'NATION_' || a END AS away_key FROM ev),
res AS (SELECT f.fixture_index, f.kickoff, f.home_key, f.away_key, f.kickoff_group_id, count(e.provider_event_id) AS candidate_count,
         min(e.provider_event_id) AS candidate_id
       FROM fx f LEFT JOIN evk e ON e.kickoff = f.kickoff AND e.home_key = f.home_key AND e.away_key = f.away_key GROUP BY ALL),
st AS (SELECT *, CASE WHEN candidate_count = 1 THEN 'RESOLVED_EXACT_ALIAS' WHEN candidate_count > 1 THEN 'AMBIGUOUS_ALIAS_MATCH'
        ELSE 'UNRESOLVED' END AS status FROM res)
"""


def _matches(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").alias("kickoff"),
        F.col("c_nationkey").alias("h"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int").alias("a"),
    )


def _named(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def order_reconciliation(t: Tables) -> Reconciliation:
    matches = _matches(t)
    k = F.col("k")
    fixtures = matches.filter(k % 2 == 0).select(
        k.alias("fixture_index"), "kickoff", _named("NATION_", "h").alias("home_key"),
        _named("NATION_", "a").alias("away_key"),
        F.concat(F.lit("G"), F.date_format("kickoff", "yyyyMMdd"), F.lit("-"), (k % 3).cast("string")).alias(
            "kickoff_group_id"
        ),
    )
    offered = matches.filter(~(k % 10).isin(0, 4) & ((k % 2 == 0) | (k % 3 == 0)))
    copies = F.when(k % 34 == 2, F.array(F.lit(""), F.lit("-b"))).otherwise(F.array(F.lit("")))
    events = offered.select("*", F.explode(copies).alias("suffix")).select(
        F.concat(_named("ev-", "k"), F.col("suffix")).alias("provider_event_id"), "kickoff",
        _named("Club ", "h").alias("provider_home_team"), _named("Club ", "a").alias("provider_away_team"),
    )
    aliases = t.nation.filter("n_nationkey <> 7").select(
        _named("Club ", "n_nationkey").alias("provider_label"), F.col("n_name").alias("identity_key")
    )
    return Reconciliation(fixtures, events, aliases)


def _day(column: str = "kickoff"):
    return F.date_format(column, "yyyy-MM-dd").alias("kickoff_day")


@query(
    "fixture_reconciliation",
    "WITH " + _MATCHES + """SELECT fixture_index, strftime(kickoff, '%Y-%m-%d') AS kickoff_day, home_key, away_key, status,
      candidate_count, CASE WHEN candidate_count = 1 THEN candidate_id END AS provider_event_id FROM st""",
)
def fixture_reconciliation(t: Tables) -> DataFrame:
    return order_reconciliation(t).fixture_results.select(
        "fixture_index", _day(), "home_key", "away_key", "status", "candidate_count", "provider_event_id"
    )


@query(
    "resolved_fixture_pairs",
    "WITH " + _MATCHES + """SELECT fixture_index, candidate_id AS provider_event_id, strftime(kickoff, '%Y-%m-%d') AS kickoff_day,
      'EXACT_PROVIDER_LABEL_ALIAS_AND_KICKOFF' AS resolution_basis FROM st WHERE candidate_count = 1""",
)
def resolved_fixture_pairs(t: Tables) -> DataFrame:
    return order_reconciliation(t).resolved_pairs.select(
        "fixture_index", "provider_event_id", _day(), "resolution_basis"
    )


@query(
    "kickoff_groups",
    "WITH " + _MATCHES + """, x AS (SELECT kickoff, count(*) AS expected_fixture_count, count(DISTINCT kickoff_group_id) AS group_id_count,
        min(kickoff_group_id) AS first_group_id FROM fx GROUP BY kickoff),
      o AS (SELECT kickoff, count(*) AS n FROM ev GROUP BY kickoff)
      SELECT strftime(x.kickoff, '%Y-%m-%d') AS kickoff_day, expected_fixture_count, coalesce(n, 0) AS provider_event_count,
        CASE WHEN coalesce(n, 0) = 0 THEN 'NO_PROVIDER_EVENTS' WHEN n <> expected_fixture_count THEN 'COUNT_MISMATCH'
          ELSE 'KICKOFF_CANDIDATES' END AS group_status, group_id_count, first_group_id
      FROM x LEFT JOIN o ON x.kickoff = o.kickoff""",
)
def kickoff_groups(t: Tables) -> DataFrame:
    return order_reconciliation(t).groups.select(
        _day(), "expected_fixture_count", "provider_event_count", "group_status", "group_id_count", "first_group_id"
    )


@query(
    "kickoff_group_ids",
    "WITH " + _MATCHES + "SELECT DISTINCT strftime(kickoff, '%Y-%m-%d') AS kickoff_day, kickoff_group_id FROM fx",
)
def kickoff_group_ids(t: Tables) -> DataFrame:
    return order_reconciliation(t).group_ids.select(_day(), "kickoff_group_id")


@query(
    "reconciliation_totals",
    "WITH " + _MATCHES + """SELECT (SELECT count(*) FROM fx) AS expected_fixture_count, (SELECT count(*) FROM ev) AS provider_event_count_total,
      count(*) FILTER (status = 'RESOLVED_EXACT_ALIAS') AS resolved_fixture_count,
      count(*) FILTER (status <> 'RESOLVED_EXACT_ALIAS') AS unresolved_fixture_count, CAST(24 AS BIGINT) AS alias_map_entries FROM st""",
)
def reconciliation_totals(t: Tables) -> DataFrame:
    return order_reconciliation(t).totals


@query(
    "unmatched_provider_events",
    "WITH " + _MATCHES + """SELECT DISTINCT strftime(e.kickoff, '%Y-%m-%d') AS kickoff_day, e.provider_event_id FROM ev e
      WHERE e.kickoff IN (SELECT kickoff FROM fx)
        AND e.provider_event_id NOT IN (SELECT candidate_id FROM st WHERE candidate_count = 1)""",
)
def unmatched_provider_events(t: Tables) -> DataFrame:
    return order_reconciliation(t).unmatched_events.select(_day(), "provider_event_id")


@query(
    "events_outside_manifest",
    "WITH " + _MATCHES + """SELECT strftime(kickoff, '%Y-%m-%d') AS kickoff_day, provider_event_id, home AS provider_home_team,
      away AS provider_away_team FROM ev WHERE kickoff NOT IN (SELECT kickoff FROM fx)""",
)
def events_outside_manifest(t: Tables) -> DataFrame:
    return order_reconciliation(t).outside_events.select(
        _day(), "provider_event_id", "provider_home_team", "provider_away_team"
    )


@query(
    "ambiguous_event_candidates",
    "WITH " + _MATCHES + """SELECT DISTINCT e.provider_event_id, e.home_key, e.away_key FROM evk e JOIN st s
      ON e.kickoff = s.kickoff AND e.home_key = s.home_key AND e.away_key = s.away_key WHERE s.candidate_count > 1""",
)
def ambiguous_event_candidates(t: Tables) -> DataFrame:
    return order_reconciliation(t).ambiguous_candidates.select("provider_event_id", "home_key", "away_key")


@query(
    "events_shared_by_fixtures",
    "WITH " + _MATCHES + """SELECT candidate_id AS provider_event_id, count(*) AS fixture_count FROM st WHERE candidate_count = 1
      GROUP BY ALL HAVING count(*) > 1""",
)
def events_shared_by_fixtures(t: Tables) -> DataFrame:
    return order_reconciliation(t).shared_events.select("provider_event_id", "fixture_count")


# ---- payload readers ------------------------------------------------------------------


def _payloads(t: Tables) -> DataFrame:
    """One provider payload per order: wrapper, bare list, scalar or broken text."""
    text = F.expr(
        """CASE o_orderkey % 6
             WHEN 0 THEN '{"timestamp":"2024-01-01T00:00:00Z","data":[' || ev || ',7,' || ev2 || ']}'
             WHEN 1 THEN '[' || ev || ',null,' || ev2 || ']'
             WHEN 2 THEN '{"timestamp":"2024-01-01T00:00:00+00:00","data":[' || ev || ']}'
             WHEN 3 THEN '{"timestamp":17,"data":[' || ev || ']}'
             WHEN 4 THEN '{"timestamp":"2024-01-01T00:00:00Z","data":"none"}'
             ELSE '{"timestamp":' END"""
    )
    return (
        t.orders.withColumn(
            "ev",
            F.expr(
                """'{"id":"e' || o_orderkey || '","commence_time":"' || date_format(o_orderdate, 'yyyy-MM-dd') || 'T15:00:00Z",'
                   || '"home_team":"Club ' || o_custkey || '","away_team":"Club ' || (o_custkey + 1) || '"}'"""
            ),
        )
        .withColumn(
            "ev2",
            F.expr(
                """'{"id":' || CASE WHEN o_orderkey % 12 < 6 THEN '5' ELSE '"x' || o_orderkey || '"' END
                   || ',"commence_time":"t","home_team":"A","away_team":"' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'B' END || '"}'"""
            ),
        )
        .select("o_orderkey", text.alias("payload"))
    )


@query(
    "provider_event_scan",
    """WITH x AS (SELECT * FROM orders)
      SELECT o_orderkey, 'e' || o_orderkey AS provider_event_id, strftime(o_orderdate, '%Y-%m-%d') || 'T15:00:00Z' AS kickoff,
        'Club ' || o_custkey AS provider_home_team, 'Club ' || (o_custkey + 1) AS provider_away_team FROM x WHERE o_orderkey % 6 < 4
      UNION ALL SELECT o_orderkey, 'x' || o_orderkey, 't', 'A', 'B' FROM x
      WHERE o_orderkey % 6 < 2 AND o_orderkey % 12 >= 6 AND o_orderkey % 5 <> 0""",
)
def provider_event_scan(t: Tables) -> DataFrame:
    return snapshots.provider_events(_payloads(t), ["o_orderkey"])


@query(
    "snapshot_envelopes",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'NOT_AN_OBJECT' WHEN 2 THEN 'TIMESTAMP_NOT_UTC_Z'
        WHEN 3 THEN 'MISSING_TIMESTAMP' WHEN 4 THEN 'MISSING_DATA' ELSE 'NOT_AN_OBJECT' END AS code,
      CASE WHEN o_orderkey % 6 IN (0, 4) THEN epoch_us(TIMESTAMP '2024-01-01') END AS provider_micros,
      CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 END AS event_count FROM orders""",
)
def snapshot_envelopes(t: Tables) -> DataFrame:
    read = snapshots.envelopes(_payloads(t), ["o_orderkey"])
    return read.select(
        "o_orderkey", "code", F.unix_micros("provider_snapshot_at").alias("provider_micros"),
        F.size("events").alias("event_count"),
    )


@query(
    "alias_document_scan",
    """SELECT n_nationkey, CASE n_nationkey % 4 WHEN 3 THEN NULL ELSE CASE WHEN n_nationkey = 8 THEN '' ELSE 'Club ' || n_nationkey END END AS provider_label,
        CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN NULL WHEN 2 THEN '' END AS identity_key,
        CASE n_nationkey % 4 WHEN 0 THEN CASE WHEN n_nationkey = 8 THEN 'EMPTY_VALUE' END WHEN 1 THEN 'NOT_A_STRING' WHEN 2 THEN 'EMPTY_VALUE' ELSE 'NOT_AN_OBJECT' END AS code
      FROM nation""",
)
def alias_document_scan(t: Tables) -> DataFrame:
    text = F.expr(
        """CASE n_nationkey % 4 WHEN 3 THEN '["Club"]' ELSE '{"' || CASE WHEN n_nationkey = 8 THEN '' ELSE 'Club ' || n_nationkey END || '":'
             || CASE n_nationkey % 4 WHEN 0 THEN '"' || n_name || '"' WHEN 1 THEN '5' ELSE '""' END || '}' END"""
    )
    docs = t.nation.select("n_nationkey", text.alias("payload"))
    return alias_entries(docs, keep=["n_nationkey"])


# ---- coverage -------------------------------------------------------------------------

_ODDS = """
od AS (SELECT 'snap-' || l_orderkey % 20 AS snapshot_id, 'ev-' || l_orderkey AS ev, l_suppkey % 4 AS book, l_linenumber AS n,
         CASE WHEN l_linenumber <= 4 THEN 'h2h' ELSE 'totals' END AS market, round(l_quantity / 2) / 2 AS point FROM lineitem),
bk AS (SELECT snapshot_id, ev, book, bool_or(market = 'h2h') AS h2h,
         (bool_or(n = 1) AND bool_or(n = 2) AND bool_or(n = 3)) AS complete, bool_or(market = 'totals') AS totals FROM od GROUP BY ALL),
es AS (SELECT snapshot_id, ev AS provider_event_id, count(*) AS bookmaker_count, count(*) FILTER (h2h) AS h2h_bookmaker_count,
         count(*) FILTER (complete) AS complete_h2h_bookmaker_count, count(*) FILTER (totals) AS totals_bookmaker_count
       FROM bk GROUP BY ALL),
pt AS (SELECT snapshot_id, ev, string_agg(CAST(point AS VARCHAR), ',' ORDER BY point) AS points
       FROM (SELECT DISTINCT snapshot_id, ev, point FROM od WHERE n IN (5, 6)) GROUP BY ALL)
"""


def item_odds(t: Tables, keep: dict[str, str] | None = None) -> DataFrame:
    """One offered outcome per line item; ``keep`` adds source columns under new names."""
    n = F.col("l_linenumber")
    event = F.col("l_orderkey").cast("string")
    names = {1: F.concat(F.lit("Home "), event), 2: F.lit("Draw"), 3: F.concat(F.lit("Away "), event),
             4: F.lit("Other"), 5: F.lit("Over"), 6: F.lit("Under"), 7: F.lit("Exact")}
    name = F.lit(None).cast("string")
    for number, label in names.items():
        name = F.when(n == number, label).otherwise(name)
    return t.lineitem.select(
        F.concat(F.lit("snap-"), (F.col("l_orderkey") % 20).cast("string")).alias("snapshot_id"),
        F.concat(F.lit("ev-"), event).alias("provider_event_id"),
        F.concat(F.lit("Home "), event).alias("home_team"),
        F.concat(F.lit("Away "), event).alias("away_team"),
        (F.col("l_suppkey") % 4).cast("int").alias("bookmaker_no"),
        (F.col("l_suppkey") % 4).cast("string").alias("bookmaker"),
        F.when(n <= 4, 0).otherwise(1).alias("market_no"),
        F.when(n <= 4, "h2h").otherwise("totals").alias("market_key"),
        name.alias("outcome_name"),
        (F.lit(1.0) + F.col("l_discount") * 20).alias("price"),
        (F.round(F.col("l_quantity") / 2) / 2).alias("point"),
        *[F.col(source).alias(name) for name, source in (keep or {}).items()],
    )


@query(
    "event_market_summary",
    "WITH " + _ODDS + """SELECT es.*, coalesce(pt.points, '') AS totals_distinct_points, h2h_bookmaker_count > 0 AS h2h_present,
      complete_h2h_bookmaker_count > 0 AS h2h_complete_present, totals_bookmaker_count > 0 AS totals_present
      FROM es LEFT JOIN pt ON es.snapshot_id = pt.snapshot_id AND es.provider_event_id = pt.ev""",
)
def event_market_summary(t: Tables) -> DataFrame:
    return V.event_market_summary(item_odds(t)).withColumn(
        "totals_distinct_points", F.array_join("totals_distinct_points", ",")
    )


@query(
    "snapshot_coverage",
    "WITH " + _ODDS + """, pr AS (SELECT 'snap-' || o_orderkey % 20 AS snapshot_id, 'ev-' || o_orderkey AS ev FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 20 = 1),
      ex AS (SELECT 'snap-' || o_orderkey % 20 AS snapshot_id, count(*) AS n FROM orders WHERE o_orderkey % 20 <> 3 GROUP BY ALL
             UNION ALL SELECT 'snap-3', 0),
      j AS (SELECT pr.snapshot_id, es.* EXCLUDE (snapshot_id) FROM pr LEFT JOIN es ON pr.snapshot_id = es.snapshot_id AND pr.ev = es.provider_event_id),
      c AS (SELECT snapshot_id, count(*) AS r, count(*) FILTER (provider_event_id IS NULL) AS missing,
        count(*) FILTER (h2h_bookmaker_count > 0) AS h, count(*) FILTER (complete_h2h_bookmaker_count > 0) AS c,
        count(*) FILTER (totals_bookmaker_count > 0) AS tt, min(bookmaker_count) AS lo, median(bookmaker_count) AS md, max(bookmaker_count) AS hi
        FROM j GROUP BY ALL)
      SELECT ex.snapshot_id, n AS expected_fixture_count, coalesce(r, 0) AS resolved_fixture_count, coalesce(missing, 0) AS missing_resolved_count,
        coalesce(h, 0) AS h2h_present_count, coalesce(c, 0) AS complete_h2h_count, coalesce(tt, 0) AS totals_present_count,
        n - coalesce(r, 0) AS unresolved_fixture_count,
        CASE WHEN n > 0 THEN coalesce(r, 0)::DOUBLE / n END AS fixture_resolution_coverage, CASE WHEN n > 0 THEN coalesce(h, 0)::DOUBLE / n END AS h2h_coverage,
        CASE WHEN n > 0 THEN coalesce(c, 0)::DOUBLE / n END AS complete_h2h_coverage, CASE WHEN n > 0 THEN coalesce(tt, 0)::DOUBLE / n END AS totals_coverage,
        lo AS bookmaker_count_min, md AS bookmaker_count_median, hi AS bookmaker_count_max
      FROM ex LEFT JOIN c ON ex.snapshot_id = c.snapshot_id""",
)
def snapshot_coverage(t: Tables) -> DataFrame:
    """Pairs are half of the orders; snapshot 3 expects nothing, so its ratios are null."""
    k = F.col("o_orderkey")
    snapshot = F.concat(F.lit("snap-"), (k % 20).cast("string"))
    pairs = t.orders.filter((k % 2 == 0) | (k % 20 == 1)).select(
        k.alias("fixture_index"), snapshot.alias("snapshot_id"),
        F.concat(F.lit("ev-"), k.cast("string")).alias("provider_event_id"),
    )
    expected = t.orders.groupBy(snapshot.alias("snapshot_id")).agg(
        F.count(F.when(k % 20 != 3, 1)).alias("expected_fixture_count")
    )
    resolved = V.resolved_summaries(pairs, V.event_market_summary(item_odds(t)))
    return V.coverage(resolved, expected)


@query(
    "snapshot_payload_coverage",
    """WITH b AS (SELECT o_orderkey AS k, o_orderkey % 3 AS books, o_orderkey % 4 AS shape FROM orders)
      SELECT 's-' || k AS snapshot_id, 'e' || k AS provider_event_id, CAST(books AS BIGINT) AS bookmaker_count,
        CASE WHEN shape = 3 THEN 0 ELSE CAST(books AS BIGINT) END AS h2h_bookmaker_count,
        CASE WHEN shape = 0 THEN CAST(books AS BIGINT) ELSE 0 END AS complete_h2h_bookmaker_count,
        CASE WHEN shape IN (1, 3) THEN CAST(books AS BIGINT) ELSE 0 END AS totals_bookmaker_count,
        CASE WHEN shape IN (1, 3) AND books > 0 THEN CASE WHEN shape = 1 THEN '2.5' ELSE '2.5,3.5' END ELSE '' END AS points
      FROM b""",
)
def snapshot_payload_coverage(t: Tables) -> DataFrame:
    """Nested payload text -> envelope -> outcome rows -> event summary.

    The event id occurs twice in every payload; the first copy is a decoy that must lose. In every
    fifth payload all bookmakers share a key and complete a market only together, which does not
    count; in the next ones the key is missing.
    """
    h2h = """'{"key":"h2h","outcomes":[{"name":"H","price":2.0},{"name":"A","price":3.5}' || CASE WHEN shape = 0 THEN ',{"name":"Draw","price":3}' ELSE '' END || ']}'"""
    totals = """'{"key":"totals","outcomes":[{"name":"Over","price":1.9,"point":2.5},{"name":"Exact","point":9},{"name":"Under","price":1.9,"point":' || CASE WHEN shape = 3 THEN '3.5' ELSE '"n/a"' END || '}]}'"""
    half = """'{"key":"h2h","outcomes":[' || CASE i WHEN 1 THEN '{"name":"H","price":2.0},{"name":"Draw","price":3}' ELSE '{"name":"A","price":3.5}' END || ']}'"""
    market = f"CASE WHEN shape = 2 AND k % 5 = 0 THEN {half} ELSE CASE shape WHEN 1 THEN {h2h} || ',' || {totals} WHEN 3 THEN {totals} ELSE {h2h} END END"
    book = f"""'{{"key":"b","markets":[' || {market} || ']}}'"""
    body = F.expr(
        f"""'{{"timestamp":"2024-01-01T00:00:00Z","next_timestamp":"2024-01-01T00:05:00Z","data":['
            || '{{"id":"e' || k || '","home_team":"decoy","away_team":"A","bookmakers":[{{"key":"z"}},{{"key":"y"}},{{"key":"x"}},{{"key":"w"}}]}},'
            || '{{"id":"e' || k || '","home_team":"H","away_team":"A","bookmakers":'
            || CASE WHEN books = 0 THEN '"none"' ELSE '[' || array_join(transform(sequence(1, books), i -> replace({book}, '"key":"b"', CASE k % 5 WHEN 0 THEN '"key":"b"' WHEN 1 THEN '"title":"b"' ELSE '"key":"b' || i || '"' END)), ',') || ']' END
            || '}}]}}'"""
    )
    payloads = t.orders.selectExpr(
        "o_orderkey AS k", "cast(o_orderkey % 3 AS int) AS books", "o_orderkey % 4 AS shape"
    ).select(F.concat(F.lit("s-"), F.col("k").cast("string")).alias("snapshot_id"), body.alias("payload"))
    rows = snapshots.outcome_rows(snapshots.envelopes(payloads, ["snapshot_id"]), ["snapshot_id"])
    return V.event_market_summary(rows).select(
        "snapshot_id", "provider_event_id", "bookmaker_count", "h2h_bookmaker_count",
        "complete_h2h_bookmaker_count", "totals_bookmaker_count",
        F.array_join("totals_distinct_points", ",").alias("points"),
    )
