"""Exact reconciliation of provider events to expected fixtures. Nothing is fuzzy.

Events meet fixtures on (kickoff, home identity, away identity). Events are counted per
such triple before the join, so copies of one event or one crowded kickoff never
multiply into pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.domains import RESOLUTION_BASIS
from knownby.operators.skew import hot_keys, join_summary, mark_members

TRIPLE = ("kickoff", "home_key", "away_key")


def attach_identity(events: DataFrame, aliases: DataFrame) -> DataFrame:
    """Provider labels -> identity keys by exact alias; an unknown label stays null.

    ``aliases`` (provider_label, identity_key) holds one row per label. It is not hinted:
    Spark broadcasts it while it is small and shuffles otherwise.
    """
    home = aliases.select(F.col("provider_label").alias("provider_home_team"), F.col("identity_key").alias("home_key"))
    away = aliases.select(F.col("provider_label").alias("provider_away_team"), F.col("identity_key").alias("away_key"))
    return events.join(home, "provider_home_team", "left").join(away, "provider_away_team", "left")


@dataclass(frozen=True)
class Reconciliation:
    """``fixtures``: fixture_index, kickoff, home_key, away_key, kickoff_group_id (+ extras).

    ``events``: provider_event_id, kickoff, provider_home_team, provider_away_team.
    ``kickoff`` is text for literal equality or an instant; both sides use the same type.
    """

    fixtures: DataFrame
    events: DataFrame
    aliases: DataFrame

    @cached_property
    def usable_fixtures(self) -> DataFrame:
        return self.fixtures.filter(F.col("kickoff").isNotNull())

    @cached_property
    def fixture_kickoffs(self) -> DataFrame:
        return self.usable_fixtures.select("kickoff").distinct()

    @cached_property
    def identified(self) -> DataFrame:
        return attach_identity(self.events, self.aliases)

    @cached_property
    def candidates(self) -> DataFrame:
        return self.identified.filter(
            F.col("home_key").isNotNull() & F.col("away_key").isNotNull()
        ).groupBy(*TRIPLE).agg(
            F.count(F.lit(1)).alias("candidate_count"),
            F.min("provider_event_id").alias("candidate_id"),
        )

    @cached_property
    def fixture_results(self) -> DataFrame:
        joined = join_summary(
            self.usable_fixtures, self.candidates, TRIPLE,
            hot_keys(self.usable_fixtures, TRIPLE), TRIPLE, ["fixture_index"], how="left",
        )
        count = F.coalesce(F.col("candidate_count"), F.lit(0))
        status = (
            F.when(count == 1, "RESOLVED_EXACT_ALIAS")
            .when(count > 1, "AMBIGUOUS_ALIAS_MATCH")
            .otherwise("UNRESOLVED")
        )
        return joined.select(
            *self.fixtures.columns,
            status.alias("status"),
            count.cast("long").alias("candidate_count"),
            F.when(count == 1, F.col("candidate_id")).alias("provider_event_id"),
        )

    @cached_property
    def resolved_pairs(self) -> DataFrame:
        return self.fixture_results.filter(F.col("status") == "RESOLVED_EXACT_ALIAS").select(
            "fixture_index", "provider_event_id", "kickoff", F.lit(RESOLUTION_BASIS).alias("resolution_basis")
        )

    @cached_property
    def ambiguous_candidates(self) -> DataFrame:
        """The events behind AMBIGUOUS_ALIAS_MATCH, one row per event."""
        crowded = self.candidates.filter("candidate_count > 1").join(
            self.usable_fixtures.select(*TRIPLE).distinct(), list(TRIPLE), "left_semi"
        )
        return self.identified.join(crowded.select(*TRIPLE), list(TRIPLE), "left_semi")

    @cached_property
    def outside_events(self) -> DataFrame:
        """Events whose kickoff no fixture has."""
        at_fixture = mark_members(
            self.events, self.fixture_kickoffs, ["kickoff"], ["provider_event_id"], "at_fixture"
        )
        return at_fixture.filter(~F.col("at_fixture")).drop("at_fixture")

    @cached_property
    def unmatched_events(self) -> DataFrame:
        """Distinct (kickoff, event id) at a fixture kickoff that resolved nothing."""
        resolved = self.resolved_pairs.select("kickoff", "provider_event_id").distinct()
        distinct = self.events.select("kickoff", "provider_event_id").distinct()
        at_fixture = mark_members(
            distinct, self.fixture_kickoffs, ["kickoff"], ["provider_event_id"], "at_fixture"
        )
        return (
            at_fixture.filter("at_fixture")
            .drop("at_fixture")
            .join(resolved, ["kickoff", "provider_event_id"], "left_anti")
        )

    @cached_property
    def groups(self) -> DataFrame:
        """Per fixture kickoff: expected and observed counts with the group status."""
        expected = self.usable_fixtures.groupBy("kickoff", "kickoff_group_id").agg(
            F.count(F.lit(1)).alias("n")
        ).groupBy("kickoff").agg(
            F.sum("n").alias("expected_fixture_count"),
            F.count("kickoff_group_id").alias("group_id_count"),
            F.min("kickoff_group_id").alias("first_group_id"),
        )
        observed = self.events.groupBy("kickoff").agg(F.count(F.lit(1)).alias("n_events"))
        seen = F.coalesce(F.col("n_events"), F.lit(0))
        return expected.join(observed, "kickoff", "left").select(
            "kickoff",
            "expected_fixture_count",
            seen.alias("provider_event_count"),
            F.when(seen == 0, "NO_PROVIDER_EVENTS")
            .when(seen != F.col("expected_fixture_count"), "COUNT_MISMATCH")
            .otherwise("KICKOFF_CANDIDATES")
            .alias("group_status"),
            "group_id_count",
            "first_group_id",
        )

    @cached_property
    def group_ids(self) -> DataFrame:
        return self.usable_fixtures.select("kickoff", "kickoff_group_id").distinct()

    @cached_property
    def shared_events(self) -> DataFrame:
        """Extra check: one provider event that resolved more than one fixture."""
        return self.resolved_pairs.groupBy("kickoff", "provider_event_id").agg(
            F.count(F.lit(1)).alias("fixture_count")
        ).filter("fixture_count > 1")

    @cached_property
    def totals(self) -> DataFrame:
        """One row. The expected count covers all fixtures, also those without kickoff."""
        by_status = self.fixture_results.agg(
            F.count(F.when(F.col("status") == "RESOLVED_EXACT_ALIAS", 1)).alias("resolved_fixture_count"),
            F.count(F.when(F.col("status") != "RESOLVED_EXACT_ALIAS", 1)).alias("unresolved_fixture_count"),
        )
        return by_status.select(
            self.fixtures.agg(F.count(F.lit(1))).scalar().alias("expected_fixture_count"),
            self.events.agg(F.count(F.lit(1))).scalar().alias("provider_event_count_total"),
            "resolved_fixture_count",
            "unresolved_fixture_count",
            self.aliases.agg(F.count(F.lit(1))).scalar().alias("alias_map_entries"),
        )
