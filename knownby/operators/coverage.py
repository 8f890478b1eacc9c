"""Market coverage of provider snapshots, from one row per offered outcome.

Outcome rows: snapshot_id, provider_event_id, home_team, away_team, bookmaker_no, bookmaker,
market_no, market_key, outcome_name, price, point. A bookmaker without markets has null
market_key; an event without bookmakers has null bookmaker and bookmaker_no. Entries with the
same bookmaker key stay apart by their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import ratio
from knownby.functions.timeops import lag_seconds

EVENT = ("snapshot_id", "provider_event_id")


def _any(condition: Column) -> Column:
    return F.coalesce(F.max(condition), F.lit(False))


def market_states(outcomes: DataFrame, event: Sequence[str] = EVENT) -> DataFrame:
    """Per market offer: which of the needed outcomes it names."""
    return _market_states(outcomes, event)


def _market_states(outcomes: DataFrame, event: Sequence[str], *more: Column) -> DataFrame:
    name = F.col("outcome_name")
    return outcomes.groupBy(*event, "bookmaker_no", "market_no", "market_key").agg(
        _any(name == F.col("home_team")).alias("has_home"),
        _any(name == F.col("away_team")).alias("has_away"),
        _any(name == "Draw").alias("has_draw"),
        *more,
    )


def event_market_summary(outcomes: DataFrame, event: Sequence[str] = EVENT) -> DataFrame:
    """Per event: bookmakers, their h2h / complete h2h / totals offers and totals points."""
    # Points are collected on the way, list by list, so that the outcomes are read once.
    h2h = F.col("market_key") == "h2h"
    whole = h2h & F.col("has_home") & F.col("has_away") & F.col("has_draw")
    all_points = F.array_distinct(F.flatten(F.collect_list("points")))
    books = _market_states(outcomes, event, F.collect_set(_totals_point()).alias("points")).groupBy(*event, "bookmaker_no").agg(
        _any(h2h).alias("h2h"),
        _any(whole).alias("complete"),
        _any(F.col("market_key") == "totals").alias("totals"),
        all_points.alias("points"),
    )
    there = F.col("bookmaker_no").isNotNull()
    counts = books.groupBy(*event).agg(
        F.count(F.when(there, 1)).alias("bookmaker_count"),
        F.count(F.when(F.col("h2h"), 1)).alias("h2h_bookmaker_count"),
        F.count(F.when(F.col("complete"), 1)).alias("complete_h2h_bookmaker_count"),
        F.count(F.when(F.col("totals"), 1)).alias("totals_bookmaker_count"),
        F.sort_array(all_points).alias("totals_distinct_points"),
    )
    return counts.select(
        *event,
        "bookmaker_count",
        "h2h_bookmaker_count",
        "complete_h2h_bookmaker_count",
        "totals_bookmaker_count",
        "totals_distinct_points",
        (F.col("h2h_bookmaker_count") > 0).alias("h2h_present"),
        (F.col("complete_h2h_bookmaker_count") > 0).alias("h2h_complete_present"),
        (F.col("totals_bookmaker_count") > 0).alias("totals_present"),
    )


def _totals_point() -> Column:
    """The point of an Over/Under outcome in a totals market, else null; one zero."""
    counts = (F.col("market_key") == "totals") & F.col("outcome_name").isin("Over", "Under")
    return F.when(counts, F.when(F.col("point") == 0, F.abs("point")).otherwise(F.col("point")))


def totals_points(outcomes: DataFrame, event: Sequence[str] = EVENT) -> DataFrame:
    """Distinct points per event of Over/Under outcomes in totals markets."""
    return outcomes.filter(
        (F.col("market_key") == "totals")
        & F.col("outcome_name").isin("Over", "Under")
        & F.col("point").isNotNull()
    ).select(*event, "point").distinct()


def resolved_summaries(pairs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Resolved pair -> its event summary (left: pairs whose event is gone stay, empty)."""
    return pairs.join(summaries.withColumn("found", F.lit(True)), list(EVENT), "left").withColumn(
        "missing_event", F.col("found").isNull()
    ).drop("found")


def coverage(resolved: DataFrame, expected: DataFrame) -> DataFrame:
    """Per snapshot: ratios over the expected count, which never shrinks.

    ``resolved``: output of resolved_summaries. ``expected``: snapshot_id,
    expected_fixture_count.
    """
    counted = resolved.groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("resolved_fixture_count"),
        F.count(F.when(F.col("missing_event"), 1)).alias("missing_resolved_count"),
        F.count(F.when(F.col("h2h_present"), 1)).alias("h2h_present_count"),
        F.count(F.when(F.col("h2h_complete_present"), 1)).alias("complete_h2h_count"),
        F.count(F.when(F.col("totals_present"), 1)).alias("totals_present_count"),
        *distribution("bookmaker_count"),
    )
    n = F.col("expected_fixture_count")
    counts = (
        "resolved_fixture_count", "missing_resolved_count", "h2h_present_count",
        "complete_h2h_count", "totals_present_count",
    )
    return (
        expected.join(counted, "snapshot_id", "left")
        .na.fill(0, list(counts))
        .select(
            "snapshot_id",
            "expected_fixture_count",
            *counts,
            (n - F.col("resolved_fixture_count")).alias("unresolved_fixture_count"),
            ratio(F.col("resolved_fixture_count"), n).alias("fixture_resolution_coverage"),
            ratio(F.col("h2h_present_count"), n).alias("h2h_coverage"),
            ratio(F.col("complete_h2h_count"), n).alias("complete_h2h_coverage"),
            ratio(F.col("totals_present_count"), n).alias("totals_coverage"),
            "bookmaker_count_min", "bookmaker_count_median", "bookmaker_count_max",
        )
    )


def distribution(column: str) -> list[Column]:
    """Minimum, exact median and maximum; nulls when there is no value."""
    return [
        F.min(column).alias(f"{column}_min"),
        F.median(column).alias(f"{column}_median"),
        F.max(column).alias(f"{column}_max"),
    ]


def snapshot_timing(requested: Column, provider: Column) -> list[Column]:
    return [
        lag_seconds(requested, provider).alias("snapshot_lag_seconds"),
        (provider <= requested).alias("snapshot_not_after_request"),
    ]
