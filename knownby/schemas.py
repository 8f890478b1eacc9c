"""Explicit struct types of the nested records; nothing is ever inferred."""

from __future__ import annotations

SOURCE_REF = "struct<source_id string, tier string, source_version string>"
TEMPORAL = (
    "struct<event_time timestamp, published_at timestamp, received_at timestamp, "
    "valid_from timestamp, valid_to timestamp, expires_at timestamp, "
    "known_at timestamp, known_at_basis string>"
)
DATA_STATE = "struct<quality string, freshness string, verification string, conflict string>"
PROVENANCE = (
    f"struct<source {SOURCE_REF}, external_id string, temporal {TEMPORAL}, "
    f"data_state {DATA_STATE}, critical boolean>"
)
RAW_SNAPSHOT = (
    "struct<source_id string, request_identity string, payload_sha256 string, "
    "received_at timestamp, ingestion_version string>"
)
OBSERVATION = (
    "logical_key string, revision_id string, payload_sha256 string, "
    f"provenance {PROVENANCE}, raw_snapshot {RAW_SNAPSHOT}"
)

OUTCOME = "struct<name string, price double, point double>"
MARKET = f"struct<key string, last_update string, outcomes array<{OUTCOME}>>"
BOOKMAKER = f"struct<key string, last_update string, markets array<{MARKET}>>"
EVENT = (
    "struct<id string, commence_time string, home_team string, away_team string, "
    f"bookmakers array<{BOOKMAKER}>>"
)
SNAPSHOT = (
    "timestamp string, previous_timestamp string, next_timestamp string, "
    f"data array<{EVENT}>"
)

FIXTURE = (
    "struct<fixture_index int, matchweek string, official_home_name string, "
    "official_away_name string, kickoff_utc string, kickoff_group_id string, "
    "canonical_event_id string, provider_event_ids map<string,string>, "
    "source_identity_home_key string, source_identity_away_key string>"
)
FIXTURE_DOCUMENT = (
    "fixture_count int, matchweeks array<string>, source_identity_team_keys array<string>, "
    f"source_label_aliases map<string,string>, fixtures array<{FIXTURE}>"
)
KICKOFF_GROUP = (
    "struct<group_id string, matchweek string, kickoff_utc string, cutoffs map<string,string>>"
)
PLANNED_QUERY = (
    "struct<group_id string, matchweek string, cutoff string, requested_snapshot_at_utc string>"
)
PLAN_DOCUMENT = (
    "kickoff_group_count int, cutoffs_per_group array<string>, planned_query_count int, "
    f"kickoff_groups array<{KICKOFF_GROUP}>, query_plan array<{PLANNED_QUERY}>"
)

