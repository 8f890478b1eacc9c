"""Odds queries over offers projected from line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.operators import odds as O
from knownby.plans.reconciliation import item_odds
from knownby.plans.registry import Tables, query

_CO = """
co AS (SELECT 'snap-' || l_orderkey % 20 AS snapshot_id, 'ev-' || l_orderkey AS provider_event_id, CAST(l_suppkey % 4 AS VARCHAR) AS bookmaker,
  CASE WHEN l_linenumber <= 4 THEN 'FOOTBALL_1X2' ELSE 'FOOTBALL_TOTAL_GOALS_MAIN' END AS market_family,
  CASE WHEN l_linenumber <= 4 THEN 'FOOTBALL_1X2' ELSE 'FOOTBALL_TOTAL_GOALS_MAIN|' || CAST(round(l_quantity / 2) / 2 AS VARCHAR) END AS market_instance,
  CASE WHEN l_linenumber > 4 THEN round(l_quantity / 2) / 2 END AS line,
  CASE l_linenumber WHEN 1 THEN 'HOME' WHEN 2 THEN 'DRAW' WHEN 3 THEN 'AWAY' WHEN 5 THEN 'OVER' WHEN 6 THEN 'UNDER' END AS outcome_key,
  1.0 + l_discount * 20 AS decimal_odds, l_shipdate AS observed_at FROM lineitem WHERE l_linenumber NOT IN (4, 7)),
ofr AS (SELECT snapshot_id, provider_event_id, bookmaker, market_family, market_instance, count(*) AS outcomes,
    count(*) FILTER (decimal_odds <= 1) AS invalid, count(DISTINCT outcome_key) AS kinds, min(observed_at) AS observed_at,
    max(CASE WHEN outcome_key = 'HOME' THEN 1 / decimal_odds END) AS qh, max(CASE WHEN outcome_key = 'DRAW' THEN 1 / decimal_odds END) AS qd,
    max(CASE WHEN outcome_key = 'AWAY' THEN 1 / decimal_odds END) AS qa, max(CASE WHEN outcome_key = 'OVER' THEN 1 / decimal_odds END) AS qo,
    max(CASE WHEN outcome_key = 'UNDER' THEN 1 / decimal_odds END) AS qu FROM co GROUP BY ALL),
off AS (SELECT *, CASE WHEN invalid > 0 THEN 'INVALID_ODDS' WHEN kinds < (CASE market_family WHEN 'FOOTBALL_1X2' THEN 3 ELSE 2 END) THEN 'INCOMPLETE'
    WHEN outcomes = kinds THEN 'COMPLETE' ELSE 'REPEATED_OUTCOME' END AS status FROM ofr),
cp AS (SELECT *, coalesce(qh, 0) + coalesce(qd, 0) + coalesce(qa, 0) + coalesce(qo, 0) + coalesce(qu, 0) AS booked FROM off WHERE status = 'COMPLETE'),
nv AS (SELECT snapshot_id, provider_event_id, bookmaker, market_family, market_instance, observed_at, outcome_key, q / booked AS p FROM (
   SELECT *, 'HOME' AS outcome_key, qh AS q FROM cp UNION ALL SELECT *, 'DRAW', qd FROM cp UNION ALL SELECT *, 'AWAY', qa FROM cp
   UNION ALL SELECT *, 'OVER', qo FROM cp UNION ALL SELECT *, 'UNDER', qu FROM cp) WHERE q IS NOT NULL)
"""


def _observations(t: Tables) -> DataFrame:
    """Item odds with the ship date as observation time."""
    base = item_odds(t, keep={"observed_at": "l_shipdate"})
    return O.canonical_observations(base)


@query(
    "canonical_odds_observations",
    "WITH " + _CO + """SELECT snapshot_id, provider_event_id, bookmaker, market_family, market_instance, line, outcome_key, decimal_odds,
      strftime(observed_at, '%Y-%m-%d') AS observed_on FROM co""",
)
def canonical_odds_observations(t: Tables) -> DataFrame:
    return _observations(t).withColumn("observed_on", F.date_format("observed_at", "yyyy-MM-dd")).drop(
        "observed_at", "provider_outcome_name"
    )


@query(
    "repeated_odds_observations",
    "WITH " + _CO + """SELECT snapshot_id, provider_event_id, bookmaker, market_family, market_instance, outcome_key, count(*) AS observations
      FROM co GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_odds_observations(t: Tables) -> DataFrame:
    return O.repeated_observations(_observations(t))


@query(
    "implied_probabilities",
    "WITH " + _CO + """SELECT outcome_key, decimal_odds, CASE WHEN decimal_odds > 1 THEN 1 / decimal_odds END AS implied,
       CASE WHEN decimal_odds <= 1 THEN 'ODDS_NOT_ABOVE_ONE' END AS violation, count(*) AS rows FROM co GROUP BY ALL""",
)
def implied_probabilities(t: Tables) -> DataFrame:
    q = O.implied_probability(F.col("decimal_odds"))
    return _observations(t).groupBy("outcome_key", "decimal_odds").agg(F.count(F.lit(1)).alias("rows")).select(
        "outcome_key", "decimal_odds", q.alias("implied"),
        F.when(q.isNull(), "ODDS_NOT_ABOVE_ONE").alias("violation"), "rows",
    )


@query(
    "market_offer_margins",
    "WITH " + _CO + """SELECT snapshot_id, provider_event_id, bookmaker, market_instance, outcomes, status,
      round(CASE WHEN status = 'COMPLETE' THEN coalesce(qh, 0) + coalesce(qd, 0) + coalesce(qa, 0) + coalesce(qo, 0) + coalesce(qu, 0) - 1 END, 9) AS overround FROM off""",
)
def market_offer_margins(t: Tables) -> DataFrame:
    return O.market_offers(_observations(t)).select(
        "snapshot_id", "provider_event_id", "bookmaker", "market_instance", "outcomes", "status",
        F.round("overround", 9).alias("overround"),
    )


@query(
    "no_vig_probabilities",
    "WITH " + _CO + "SELECT snapshot_id, provider_event_id, bookmaker, market_instance, outcome_key, round(p, 9) AS p_no_vig FROM nv",
)
def no_vig_probabilities(t: Tables) -> DataFrame:
    return O.no_vig(O.market_offers(_observations(t))).select(
        "snapshot_id", "provider_event_id", "bookmaker", "market_instance", "outcome_key",
        F.round("p_no_vig", 9).alias("p_no_vig"),
    )


@query(
    "consensus_inputs",
    "WITH " + _CO + """, x AS (SELECT *, coalesce(epoch(TIMESTAMP '2001-01-01' - observed_at) <= 86400 * 1500, false) AS fresh FROM nv)
      SELECT snapshot_id, market_instance, outcome_key, count(DISTINCT CASE WHEN fresh THEN bookmaker END) AS book_count,
        count(DISTINCT CASE WHEN NOT fresh THEN bookmaker END) AS stale_books,
        coalesce(string_agg(DISTINCT CASE WHEN fresh THEN bookmaker END, ',' ORDER BY CASE WHEN fresh THEN bookmaker END), '') AS bookmakers,
        strftime(min(CASE WHEN fresh THEN observed_at END), '%Y-%m-%d') AS first_on, strftime(max(CASE WHEN fresh THEN observed_at END), '%Y-%m-%d') AS last_on,
        round(stddev_pop(CASE WHEN fresh THEN p END), 6) AS dispersion, round(median(CASE WHEN fresh THEN p END), 6) AS p_consensus FROM x GROUP BY ALL""",
)
def consensus_inputs(t: Tables) -> DataFrame:
    offers = O.market_offers(_observations(t), ["observed_at"])
    rows = O.no_vig(offers, ["observed_at"]).withColumn("snapshot_at", F.lit("2001-01-01 00:00:00").cast("timestamp"))
    made = O.consensus_inputs(
        rows, "observed_at", "snapshot_at", 86_400 * 1500, F.median,
        by=("snapshot_id", "market_instance", "outcome_key"),
    )
    return made.select(
        "snapshot_id", "market_instance", "outcome_key", "book_count", "stale_books", "bookmakers",
        F.date_format("first_observed_at", "yyyy-MM-dd").alias("first_on"),
        F.date_format("last_observed_at", "yyyy-MM-dd").alias("last_on"),
        F.round("dispersion", 6).alias("dispersion"), F.round("p_consensus", 6).alias("p_consensus"),
    )


@query(
    "price_milestones",
    """WITH o AS (SELECT l_orderkey, l_suppkey % 4 AS book, l_shipdate AS seen, 1.0 + l_discount * 20 AS odds,
          TIMESTAMP '1998-01-01' + (l_orderkey % 900) * INTERVAL 1 DAY AS kickoff FROM lineitem)
      SELECT l_orderkey, book, strftime(min(seen) FILTER (seen < kickoff), '%Y-%m-%d') AS opening_on, (min((seen, odds)) FILTER (seen < kickoff))[2] AS opening_odds,
        strftime(max(seen) FILTER (seen < kickoff AND seen <= TIMESTAMP '1998-06-01'), '%Y-%m-%d') AS decision_on,
        -(max((seen, -odds)) FILTER (seen < kickoff AND seen <= TIMESTAMP '1998-06-01'))[2] AS decision_odds,
        strftime(max(seen) FILTER (seen < kickoff), '%Y-%m-%d') AS closing_on, -(max((seen, -odds)) FILTER (seen < kickoff))[2] AS closing_odds_evaluation_only
      FROM o GROUP BY l_orderkey, book""",
)
def price_milestones(t: Tables) -> DataFrame:
    day = F.lit(86_400_000_000)
    start = F.unix_micros(F.lit("1998-01-01 00:00:00").cast("timestamp"))
    rows = t.lineitem.select(
        "l_orderkey", (F.col("l_suppkey") % 4).alias("book"), F.col("l_shipdate").alias("known_at"),
        (F.lit(1.0) + F.col("l_discount") * 20).alias("decimal_odds"),
        F.lit("1998-06-01 00:00:00").cast("timestamp").alias("cutoff"),
        F.timestamp_micros(start + (F.col("l_orderkey") % 900) * day).alias("kickoff"),
    )
    made = O.price_milestones(rows, ["l_orderkey", "book"], "known_at", "cutoff", "kickoff")

    def on(c: str):
        return F.date_format(f"{c}_at", "yyyy-MM-dd").alias(f"{c}_on")

    return made.select(
        "l_orderkey", "book", on("opening"), "opening_odds", on("decision"), "decision_odds", on("closing"),
        "closing_odds_evaluation_only",
    )


@query(
    "odds_as_of_cutoff",
    """WITH o AS (SELECT l_partkey % 50 AS key, l_shipdate AS at, l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber || '|' || CAST(round(l_extendedprice * 100) AS BIGINT) AS tie,
          l_extendedprice AS price FROM lineitem),
      r AS (SELECT o_custkey % 60 AS key, o_orderkey AS request_id, o_orderdate AS cutoff FROM orders),
      j AS (SELECT r.key, r.request_id, r.cutoff, max((o.at, o.tie, o.price)) AS best FROM r LEFT JOIN o ON r.key = o.key AND o.at <= r.cutoff GROUP BY ALL)
      SELECT key, request_id, strftime(best[1], '%Y-%m-%d') AS known_on, best[3] AS price, CAST(epoch(cutoff - best[1]) AS DOUBLE) AS staleness_seconds FROM j""",
)
def odds_as_of_cutoff(t: Tables) -> DataFrame:
    observations = t.lineitem.select(
        (F.col("l_partkey") % 50).alias("key"), F.col("l_shipdate").alias("seen_at"),
        F.concat_ws(
            "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.round(F.col("l_extendedprice") * 100).cast("long"),
        ).alias("tie"),
        F.col("l_extendedprice").alias("price"),
    )
    requests = t.orders.select(
        (F.col("o_custkey") % 60).alias("key"), F.col("o_orderkey").alias("request_id"), F.col("o_orderdate").alias("cutoff")
    )
    found = O.nearest_before(
        requests, observations, ["key"], "request_id", "cutoff", "seen_at", ["price"], "tie"
    )
    return found.select(
        "key", "request_id", F.date_format("known_at", "yyyy-MM-dd").alias("known_on"), "price", "staleness_seconds"
    )


@query(
    "distinct_price_observations",
    "SELECT DISTINCT l_orderkey, l_suppkey % 4 AS book, 1.0 + l_discount * 20 AS decimal_odds FROM lineitem",
)
def distinct_price_observations(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", (F.col("l_suppkey") % 4).alias("book"), (F.lit(1.0) + F.col("l_discount") * 20).alias("decimal_odds")
    )
    return O.distinct_prices(rows, ["l_orderkey", "book"], "decimal_odds")


@query(
    "canonical_fixture_per_event",
    """SELECT event_key, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT o_custkey || '-' || year(o_orderdate) AS event_key, o_orderpriority, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def canonical_fixture_per_event(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.concat_ws("-", "o_custkey", F.year("o_orderdate")).alias("event_key"), "o_orderpriority", "o_orderkey", "o_totalprice"
    )
    return O.one_fixture_per_event(rows, ["event_key"], ["o_orderpriority", "o_orderkey"])


_CUTS = "(VALUES ('T-24h'), ('T-1h'), ('T-15m')) AS c(cutoff)"
_SEEN = "CASE l_linenumber % 4 WHEN 0 THEN 'T-24h' WHEN 1 THEN 'T-1h' WHEN 2 THEN 'T-15m' END"


def _seen(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("fixture"), (F.col("l_suppkey") % 4).alias("book"),
        F.expr(_SEEN).alias("cutoff"), F.col("l_linenumber").alias("n"),
    ).filter("cutoff is not null")


@query(
    "availability_by_cutoff",
    f"""WITH e AS (SELECT o_orderkey AS fixture, cutoff FROM orders, {_CUTS}),
      a AS (SELECT l_orderkey AS fixture, {_SEEN} AS cutoff, bool_or(l_linenumber <= 4) AS flag FROM lineitem GROUP BY ALL)
      SELECT e.cutoff, count(*) AS expected, count(*) FILTER (a.flag) AS available, count(*) FILTER (a.flag)::DOUBLE / count(*) AS availability
      FROM e LEFT JOIN a ON e.fixture = a.fixture AND e.cutoff = a.cutoff GROUP BY ALL""",
)
def availability_by_cutoff(t: Tables) -> DataFrame:
    cutoffs = F.explode(F.array(*[F.lit(c) for c in ("T-24h", "T-1h", "T-15m")])).alias("cutoff")
    expected = t.orders.select(F.col("o_orderkey").alias("fixture"), cutoffs)
    available = _seen(t).groupBy("fixture", "cutoff").agg(F.max(F.col("n") <= 4).alias("flag"))
    return O.availability_by_cutoff(expected, available, "fixture", "cutoff", "flag")


@query(
    "bookmaker_continuity",
    f"""WITH s AS (SELECT DISTINCT l_orderkey AS fixture, l_suppkey % 4 AS book, {_SEEN} AS cutoff FROM lineitem),
      b AS (SELECT fixture, book, count(*) AS n FROM s WHERE cutoff IS NOT NULL GROUP BY ALL)
      SELECT fixture, count(*) AS books_any, count(*) FILTER (n = 3) AS books_all FROM b GROUP BY fixture""",
)
def bookmaker_continuity(t: Tables) -> DataFrame:
    return O.bookmaker_continuity(_seen(t), "fixture", "book", "cutoff", 3)


@query(
    "repeated_retrievals",
    """SELECT l_orderkey, l_suppkey, count(*) AS retrievals, min(sha256(CAST(l_linenumber % 2 AS VARCHAR))) <> max(sha256(CAST(l_linenumber % 2 AS VARCHAR))) AS changed
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_retrievals(t: Tables) -> DataFrame:
    captures = t.lineitem.select(
        "l_orderkey", "l_suppkey", F.sha2((F.col("l_linenumber") % 2).cast("string"), 256).alias("payload_sha256")
    )
    return O.repeated_retrievals(captures, ["l_orderkey", "l_suppkey"])
