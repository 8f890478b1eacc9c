"""Small domain columns: normalisation, ranks, ratios, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownby.domains import DECISION_STATES, LEGACY_SOURCE_TIERS, SOURCE_TIERS


def source_version(source_id: Column, revision_id: Column) -> Column:
    """(source_id, revision_id), or null when the source names no revision."""
    return F.when(
        revision_id.isNotNull(),
        F.struct(source_id.alias("source_id"), revision_id.alias("revision_id")),
    )


def normalize_source_tier(label: Column) -> Column:
    """Canonical tier of a canonical or approved legacy label, else null."""
    out = F.when(label.isin(*SOURCE_TIERS), label)
    for legacy, canonical in LEGACY_SOURCE_TIERS.items():
        out = out.when(label == legacy, F.lit(canonical))
    return out


def state_rank(state: Column) -> Column:
    """0 (QUALIFIED) .. 4 (BLOCKED); null outside the domain."""
    out = F.when(state == DECISION_STATES[0], F.lit(0))
    for rank, name in enumerate(DECISION_STATES[1:], start=1):
        out = out.when(state == name, F.lit(rank))
    return out


def risk_ordinal(risk_class: Column) -> Column:
    """MR1..MR6 -> 1..6. Order only."""
    return F.when(risk_class.rlike("^MR[1-6]$"), risk_class.substr(3, 1).try_cast("int"))


def edge(probability: Column, market: Column) -> Column:
    return probability - market


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def is_blank(text: Column) -> Column:
    """Nothing but Unicode white space."""
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def is_non_finite(number: Column) -> Column:
    return F.isnan(number) | (F.abs(number) == float("inf"))


def implied_probability(odds: Column) -> Column:
    """1 / decimal odds; null unless the odds exceed 1."""
    return F.when(odds > 1.0, F.lit(1.0) / odds)


def probability_band(p: Column) -> Column:
    return (
        F.when(p >= 0.85, "P90")
        .when(p >= 0.75, "P80")
        .when(p >= 0.65, "P70")
        .when(p >= 0.60, "P60")
        .when(p >= 0.50, "P50")
        .when(p >= 0.40, "P40")
        .when(p >= 0.25, "P25")
        .when(p.isNotNull(), "Reject")
    )


def return_band(odds: Column) -> Column:
    return (
        F.when(odds < 2, "R1")
        .when(odds < 3, "R2")
        .when(odds < 5, "R3")
        .when(odds < 10, "R4")
        .when(odds < 20, "R5")
        .when(odds.isNotNull(), "R6")
    )


def leg_band(legs: Column) -> Column:
    return (
        F.when(legs < 2, None)
        .when(legs <= 5, "L1")
        .when(legs <= 7, "L2")
        .when(legs <= 10, "L3")
        .when(legs <= 15, "L4")
        .when(legs <= 20, "L5")
        .when(legs.isNotNull(), "L6")
    )


def decay_weight(age: Column, xi: float) -> Column:
    """exp(-xi * age); the unit of ``age`` belongs to the caller, ``xi`` has no default."""
    if xi < 0:
        raise ValueError("xi must be >= 0")
    return F.exp(-F.lit(float(xi)) * age)
