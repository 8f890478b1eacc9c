"""Closed value domains. Matching is always exact: no trimming, no case folding.

Fixed values: they must equal the published vocabularies for results to agree.
"""

from __future__ import annotations

QUALITY_STATES = ("VALID", "PARTIAL", "UNAVAILABLE", "ERROR")
FRESHNESS_STATES = ("LIVE", "RECENT", "DELAYED", "STALE", "SUPERSEDED")
VERIFICATION_STATES = ("NOT_REQUIRED", "UNVERIFIED", "VERIFIED", "CROSS_CONFIRMED")
CONFLICT_STATES = ("NONE", "OPEN", "RESOLVED")
KNOWN_AT_BASES = ("SYSTEM_RECEIPT", "VERIFIED_SOURCE_AVAILABILITY")
SOURCE_TIERS = (
    "OFFICIAL",
    "LICENSED_PRO",
    "TRUSTED_SPECIALIST",
    "TRUSTED_JOURNALIST",
    "AGGREGATOR",
    "SOCIAL_UNVERIFIED",
)
LEGACY_SOURCE_TIERS = {
    "LICENSED DATA": "LICENSED_PRO",
    "LICENSED PROFESSIONAL": "LICENSED_PRO",
    "SOCIAL": "SOCIAL_UNVERIFIED",
    "SOCIAL/UNVERIFIED": "SOCIAL_UNVERIFIED",
}

# Position is precedence: the rightmost state wins when states are combined.
DECISION_STATES = ("QUALIFIED", "NO_BET", "WAIT", "REVIEW", "BLOCKED")

# Position is canonical order; reason i is stored as bit i of a reason mask.
REJECTION_REASONS = (
    "MISSING_KNOWN_AT",
    "KNOWN_AFTER_CUTOFF",
    "NOT_YET_VALID_AT_CUTOFF",
    "EXPIRED_AT_CUTOFF",
    "SOURCE_VERSION_UNRESOLVED",
)
DISPOSITIONS = (
    "SELECTED",
    "DUPLICATE_OBSERVATION",
    "ELIGIBLE_NOT_LATEST",
    "REJECTED",
    "UNRESOLVED",
)
SELECTION_STATUSES = ("SELECTED", "NO_ELIGIBLE_VERSION", "UNRESOLVED")

SPORTS = ("BASKETBALL", "FOOTBALL", "MMA", "HANDBALL", "VOLLEYBALL", "TENNIS")
ENTITY_KINDS = ("COMPETITION", "SEASON", "EVENT", "TEAM", "PARTICIPANT")
CATALOG_PHASES = ("PHASE_1", "PHASE_2")
# (sport, market family, phase, base risk class)
MARKET_CATALOG = (
    ("FOOTBALL", "FOOTBALL_1X2", "PHASE_1", "MR2"),
    ("FOOTBALL", "FOOTBALL_TOTAL_GOALS_MAIN", "PHASE_1", "MR2"),
    ("FOOTBALL", "FOOTBALL_ASIAN_HANDICAP", "PHASE_2", "MR2"),
    ("FOOTBALL", "FOOTBALL_BTTS", "PHASE_2", "MR2"),
    ("FOOTBALL", "FOOTBALL_TEAM_TOTALS", "PHASE_2", "MR2"),
)
MARKET_FAMILIES = tuple(row[1] for row in MARKET_CATALOG)
MARKET_RISK_CLASSES = ("MR1", "MR2", "MR3", "MR4", "MR5", "MR6")
MARKET_RISK_MODES = ("CONSERVATIVE", "BALANCED", "AGGRESSIVE", "SPECULATIVE")
DEPENDENCY_CLASSES = (
    "independent",
    "weak",
    "moderate",
    "strong",
    "redundant",
    "contradictory",
)
CLAIM_TYPES = ("FACT", "EXPERT_ASSESSMENT", "OPINION", "RUMOR", "CONFLICT")
EFFECT_CHANNELS = (
    "VALIDATED_MODEL_FEATURES",
    "STRUCTURED_CONTEXT",
    "UNCERTAINTY",
    "REVIEW_STATE",
    "RESTRICTIONS",
    "GATES",
    "NO_BET_REASONS",
)
PREDICTABILITY_CLASSES = ("SP1", "SP2", "SP3", "SP4", "SP5")
EVIDENCE_STATUSES = ("INSUFFICIENT", "PROVISIONAL", "VALIDATED", "DEGRADED")
ARTIFACT_KINDS = ("DATASET", "SNAPSHOT", "CONFIGURATION", "MODEL", "CALIBRATOR")
DATA_ARTIFACT_KINDS = ("DATASET", "SNAPSHOT")
MODEL_ARTIFACT_KINDS = ("MODEL", "CALIBRATOR")

GROUP_STATUSES = ("NO_PROVIDER_EVENTS", "COUNT_MISMATCH", "KICKOFF_CANDIDATES")
FIXTURE_STATUSES = ("RESOLVED_EXACT_ALIAS", "AMBIGUOUS_ALIAS_MATCH", "UNRESOLVED")
RESOLUTION_BASIS = "EXACT_PROVIDER_LABEL_ALIAS_AND_KICKOFF"
LINE_FORMATS = ("HOME_V_AWAY_SCORE", "HOME_SCORE_AWAY")
CUTOFF_OFFSET_SECONDS = {"T-24h": 86400, "T-1h": 3600, "T-15m": 900}

SENSITIVE_QUERY_KEYS = (
    "api_key",
    "apikey",
    "api-key",
    "api_token",
    "key",
    "token",
    "access_token",
    "access-token",
    "x-api-key",
    "x-apisports-key",
    "auth",
    "authorization",
)
KEPT_RESPONSE_HEADERS = (
    "content-type",
    "date",
    "etag",
    "last-modified",
    "x-ratelimit-limit",
    "x-ratelimit-remaining",
    "x-ratelimit-reset",
)
REDACTED = "***REDACTED***"
