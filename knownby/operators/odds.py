"""Odds observations: canonical rows, margins, no-vig prices, consensus and selection.

A market offer is one bookmaker's market instance in one snapshot. Its outcomes are folded
into one row of counts and prices, so no window or self-join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import implied_probability
from knownby.functions.timeops import lag_seconds
from knownby.operators.scans import carried_through, depth_blocks

OFFER = ("snapshot_id", "provider_event_id", "bookmaker", "market_family", "market_instance")
OBSERVATION_KEY = (*OFFER, "outcome_key")
OUTCOMES = {
    "FOOTBALL_1X2": ("HOME", "DRAW", "AWAY"),
    "FOOTBALL_TOTAL_GOALS_MAIN": ("OVER", "UNDER"),
}


def canonical_observations(outcomes: DataFrame) -> DataFrame:
    """Outcome rows -> canonical observations.

    HOME/AWAY come from team names, never from array order. A totals line stays inside
    market_instance. The provider's next timestamp is not among the input columns.
    """
    name = F.col("outcome_name")
    family = F.when(F.col("market_key") == "h2h", "FOOTBALL_1X2").when(
        F.col("market_key") == "totals", "FOOTBALL_TOTAL_GOALS_MAIN"
    )
    outcome = (
        F.when(F.col("market_key") == "h2h",
               F.when(name == F.col("home_team"), "HOME")
               .when(name == F.col("away_team"), "AWAY")
               .when(name == "Draw", "DRAW"))
        .when(F.col("market_key") == "totals", F.when(name == "Over", "OVER").when(name == "Under", "UNDER"))
    )
    line = F.when(F.col("market_key") == "totals", F.col("point"))
    instance = F.when(line.isNotNull(), F.concat(family, F.lit("|"), line.cast("string"))).otherwise(family)
    times = [c for c in outcomes.columns if c.endswith("_last_update") or c.endswith("_at")]
    return (
        outcomes.select(
            "snapshot_id", "provider_event_id", "bookmaker", family.alias("market_family"),
            instance.alias("market_instance"), line.alias("line"), outcome.alias("outcome_key"),
            name.alias("provider_outcome_name"), F.col("price").alias("decimal_odds"), *times,
        )
        .filter("market_family is not null and outcome_key is not null")
        .filter("market_family <> 'FOOTBALL_TOTAL_GOALS_MAIN' or line is not null")
    )


def repeated_observations(observations: DataFrame) -> DataFrame:
    """Keys that more than one observation claims."""
    return (
        observations.groupBy(*OBSERVATION_KEY).agg(F.count(F.lit(1)).alias("observations"))
        .filter("observations > 1")
    )


def market_offers(observations: DataFrame, times: Sequence[str] = ()) -> DataFrame:
    """One row per offer: implied probabilities by outcome, completeness, overround.

    ``times`` are carried as the oldest value among the offer's outcomes.

    status: COMPLETE; INVALID_ODDS (some odds not above 1); REPEATED_OUTCOME; INCOMPLETE.
    Margins exist only for COMPLETE offers.
    """
    q = implied_probability(F.col("decimal_odds"))
    keys = ("HOME", "DRAW", "AWAY", "OVER", "UNDER")
    folded = observations.groupBy(*OFFER).agg(
        F.count(F.lit(1)).alias("outcomes"),
        F.count(F.when(q.isNull(), 1)).alias("invalid"),
        *[F.count(F.when(F.col("outcome_key") == k, 1)).alias(f"n_{k.lower()}") for k in keys],
        *[F.max(F.when(F.col("outcome_key") == k, q)).alias(f"q_{k.lower()}") for k in keys],
        *[F.min(c).alias(c) for c in times],
    )

    def all_of(family: str, test) -> Column:
        out = F.col("market_family") == family
        for k in OUTCOMES[family]:
            out = out & test(F.col(f"n_{k.lower()}"))
        return out

    whole = all_of("FOOTBALL_1X2", lambda n: n == 1) | all_of("FOOTBALL_TOTAL_GOALS_MAIN", lambda n: n == 1)
    seen = all_of("FOOTBALL_1X2", lambda n: n >= 1) | all_of("FOOTBALL_TOTAL_GOALS_MAIN", lambda n: n >= 1)
    status = (
        F.when(F.col("invalid") > 0, "INVALID_ODDS")
        .when(whole, "COMPLETE")
        .when(seen, "REPEATED_OUTCOME")
        .otherwise("INCOMPLETE")
    )
    total = sum((F.coalesce(F.col(f"q_{k.lower()}"), F.lit(0.0)) for k in keys), F.lit(0.0))
    return folded.withColumn("status", status).withColumn(
        "booked", F.when(F.col("status") == "COMPLETE", total)
    ).withColumn("overround", F.col("booked") - 1.0)


def no_vig(offers: DataFrame, times: Sequence[str] = ()) -> DataFrame:
    """Proportional no-vig probability per outcome of every COMPLETE offer; sums to 1."""
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("outcome_key"), F.col(f"q_{k.lower()}").alias("implied"))
            for k in ("HOME", "DRAW", "AWAY", "OVER", "UNDER")
        ]
    )
    return (
        offers.filter("status = 'COMPLETE'")
        .select(*OFFER, *times, "booked", F.inline(F.filter(pairs, lambda p: p["implied"].isNotNull())))
        .select(*OFFER, *times, "outcome_key", "implied", (F.col("implied") / F.col("booked")).alias("p_no_vig"))
    )


def consensus_inputs(
    normalized: DataFrame, observed_at: str, snapshot_at: str, stale_after_seconds: int, combine,
    by: Sequence[str] = ("snapshot_id", "provider_event_id", "market_family", "market_instance", "outcome_key"),
) -> DataFrame:
    """What a consensus rests on, each book normalised first; stale books are left out and
    counted. ``combine`` (e.g. F.avg) is the caller's choice."""
    age = lag_seconds(F.col(snapshot_at), F.col(observed_at))
    fresh = F.coalesce(age <= stale_after_seconds, F.lit(False))
    p = F.when(fresh, F.col("p_no_vig"))
    return normalized.groupBy(*by).agg(
        F.countDistinct(F.when(fresh, F.col("bookmaker"))).alias("book_count"),
        F.countDistinct(F.when(~fresh, F.col("bookmaker"))).alias("stale_books"),
        F.array_join(F.array_sort(F.collect_set(F.when(fresh, F.col("bookmaker")))), ",").alias("bookmakers"),
        F.min(F.when(fresh, F.col(observed_at))).alias("first_observed_at"),
        F.max(F.when(fresh, F.col(observed_at))).alias("last_observed_at"),
        F.stddev_pop(p).alias("dispersion"),
        combine(p).alias("p_consensus"),
    )


def price_milestones(
    observations: DataFrame, key: Sequence[str], known_at: str, cutoff: str, kickoff: str, price: str = "decimal_odds"
) -> DataFrame:
    """Opening, decision-cutoff and closing price: three separate observations per key.

    Ties on the instant take the lower price, so the result does not depend on order. The
    closing price is for evaluation only and carries that in its name.
    """
    at, p = F.col(known_at), F.col(price)
    first, last = F.struct(at, p), F.struct(at, -p)
    in_time = at <= F.col(cutoff)
    before_start = at < F.col(kickoff)
    found = observations.groupBy(*key).agg(
        F.min(F.when(before_start, first)).alias("o"),
        F.max(F.when(in_time & before_start, last)).alias("d"),
        F.max(F.when(before_start, last)).alias("c"),
    )
    return found.select(
        *key,
        F.col(f"o.{known_at}").alias("opening_at"), F.col(f"o.{price}").alias("opening_odds"),
        F.col(f"d.{known_at}").alias("decision_at"), (-F.col("d.col2")).alias("decision_odds"),
        F.col(f"c.{known_at}").alias("closing_at"), (-F.col("c.col2")).alias("closing_odds_evaluation_only"),
    )


def nearest_before(
    requests: DataFrame, observations: DataFrame, key: Sequence[str], request_id: str,
    cutoff: str, known_at: str, payload: Sequence[str], tie_break: str, block_rows: int = 65_536,
) -> DataFrame:
    """As-of join: for each request the latest observation of its key with known_at not
    after the cutoff, plus its age. Never looks forward.

    Both sides are stacked on one time line and the last observation is carried forward in
    blocks of about ``block_rows`` rows, so neither a hot key nor a long history sits in one task or makes pairs.
    """
    carried = F.struct(F.col(known_at).alias("known_at"), *[F.col(c) for c in payload])
    stacked = (
        observations.select(
            *key, F.col(known_at).alias("_at"), F.lit(0).alias("_side"),
            F.col(tie_break).alias("_tie"), carried.alias("_seen"),
        )
        .unionByName(
            requests.select(
                *key, F.col(cutoff).alias("_at"), F.lit(1).alias("_side"),
                F.struct(F.col(request_id), F.col(cutoff)).alias("_request"),
            ),
            allowMissingColumns=True,
        )
        .filter("_at is not null")
    )
    stacked = depth_blocks(stacked, key, "_at", block_rows, "_block")
    scanned = carried_through(stacked, key, "_block", ["_at", "_side", "_tie", "_request"], {"_last": ("_seen", "last")})
    return scanned.filter("_side = 1").select(
        *key,
        F.col(f"_request.{request_id}").alias(request_id),
        F.col(f"_request.{cutoff}").alias(cutoff),
        F.col("_last.known_at").alias("known_at"),
        *[F.col(f"_last.{c}").alias(c) for c in payload],
        lag_seconds(F.col(f"_request.{cutoff}"), F.col("_last.known_at")).alias("staleness_seconds"),
    )


def one_fixture_per_event(fixtures: DataFrame, key: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """One canonical fixture per competition, season and event; the lowest by ``prefer``."""
    rest = [c for c in fixtures.columns if c not in (*key, *prefer)]
    chosen = fixtures.groupBy(*key).agg(F.min(F.struct(*prefer, *rest)).alias("r"))
    return chosen.select(*key, *[F.col(f"r.{c}").alias(c) for c in (*prefer, *rest)])


def distinct_prices(observations: DataFrame, key: Sequence[str], price: str) -> DataFrame:
    """Drop repeats of the same price at the same key only; a price change stays."""
    return observations.select(*key, price).distinct()


def availability_by_cutoff(expected: DataFrame, available: DataFrame, fixture: str, cutoff: str, flag: str) -> DataFrame:
    """Share of expected fixtures with the market, per cutoff; uncovered fixtures count."""
    joined = expected.join(available.select(fixture, cutoff, flag), [fixture, cutoff], "left")
    return joined.groupBy(cutoff).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count(F.when(F.col(flag), 1)).alias("available"),
    ).withColumn("availability", F.col("available") / F.col("expected"))


def bookmaker_continuity(observations: DataFrame, fixture: str, bookmaker: str, cutoff: str, cutoffs: int) -> DataFrame:
    """Per fixture: bookmakers seen at all cutoffs, and bookmakers seen at any."""
    seen = observations.select(fixture, bookmaker, cutoff).distinct().groupBy(fixture, bookmaker).agg(
        F.count(F.lit(1)).alias("n")
    )
    return seen.groupBy(fixture).agg(
        F.count(F.lit(1)).alias("books_any"), F.count(F.when(F.col("n") == cutoffs, 1)).alias("books_all")
    )


def repeated_retrievals(captures: DataFrame, request: Sequence[str]) -> DataFrame:
    """Requests retrieved more than once and whether the answer changed."""
    return captures.groupBy(*request).agg(
        F.count(F.lit(1)).alias("retrievals"),
        F.min("payload_sha256").alias("lo"), F.max("payload_sha256").alias("hi"),
    ).filter("retrievals > 1").select(*request, "retrievals", (F.col("lo") != F.col("hi")).alias("changed"))
