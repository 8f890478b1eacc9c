"""Point-in-time eligibility of single observations at a decision cutoff."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.domains import REJECTION_REASONS
from knownby.functions.canonical import row_digest

# Reason i of REJECTION_REASONS is bit i.
MISSING, LATE, NOT_YET_VALID, EXPIRED, UNIDENTIFIED = (1 << i for i in range(5))

KERNEL_COLUMNS = (
    "logical_key",
    "record_digest",
    "source_id",
    "revision_id",
    "payload_sha256",
    "known_at",
    "known_at_basis",
    "valid_from",
    "valid_to",
    "expires_at",
    "raw_payload_sha256",
)


def observation_view(observations: DataFrame) -> DataFrame:
    """Nested observation records -> the flat columns the kernel needs, plus the digest."""
    temporal = "provenance.temporal."
    return observations.select(
        "logical_key",
        row_digest(observations.schema).alias("record_digest"),
        F.col("provenance.source.source_id").alias("source_id"),
        "revision_id",
        "payload_sha256",
        *[
            F.col(temporal + c).alias(c)
            for c in ("known_at", "known_at_basis", "valid_from", "valid_to", "expires_at")
        ],
        F.col("raw_snapshot.payload_sha256").alias("raw_payload_sha256"),
    )


def known_at_violation(known_at: Column, cutoff: Column) -> Column:
    """Critical rule: a known_at is needed and must not be after the cutoff."""
    return F.when(known_at.isNull(), "KNOWN_AT_MISSING").when(
        known_at > cutoff, "KNOWN_AT_AFTER_CUTOFF"
    )


def reason_mask(cutoff: Column) -> Column:
    """All reasons against an observation as one integer; 0 means eligible."""
    known_at, revision = F.col("known_at"), F.col("revision_id")
    return (
        F.when(known_at.isNull(), MISSING).when(known_at > cutoff, LATE).otherwise(0)
        + F.when(F.col("valid_from") > cutoff, NOT_YET_VALID).otherwise(0)
        + F.when((F.col("valid_to") < cutoff) | (F.col("expires_at") <= cutoff), EXPIRED).otherwise(0)
        + F.when(revision.isNull(), UNIDENTIFIED).otherwise(0)
    )


def is_visible(mask: Column) -> Column:
    return mask.bitwiseAND(MISSING | LATE) == 0


def reason_names(mask: Column) -> Column:
    """Mask -> array of reason names in canonical order."""
    return F.array_compact(
        F.array(
            *[
                F.when(mask.bitwiseAND(1 << i) != 0, F.lit(name))
                for i, name in enumerate(REJECTION_REASONS)
            ]
        )
    )


def cutoff_columns(cutoffs: Sequence[tuple[str, datetime]]) -> list[tuple[Column, Column]]:
    """Id and instant of every cutoff, as literals; refuses ids that repeat and instants without a zone."""
    ids = [c for c, _ in cutoffs]
    if not ids or len(set(ids)) != len(ids):
        raise ValueError("cutoffs need unique, non-empty ids")
    for _, when in cutoffs:
        if when.tzinfo is None:
            raise ValueError("NAIVE_DATETIME: a cutoff must be timezone-aware")
    return [(F.lit(c), F.timestamp_micros(F.lit(round(when.timestamp() * 1_000_000)))) for c, when in cutoffs]


def at_cutoffs(rows: DataFrame, cutoffs: Sequence[tuple[str, datetime]]) -> DataFrame:
    """One row per (observation, cutoff); the cutoffs are a short literal list."""
    pairs = [
        (cutoff_id.alias("cutoff_id"), when.alias("decision_cutoff_at")) for cutoff_id, when in cutoff_columns(cutoffs)
    ]
    if len(pairs) == 1:
        return rows.select(*pairs[0], *rows.columns)
    return rows.select(F.inline(F.array(*[F.struct(*p) for p in pairs])), *rows.columns)


def evaluate_eligibility(rows: DataFrame, cutoffs: Sequence[tuple[str, datetime]]) -> DataFrame:
    """Could this exact observation legitimately have been used at this cutoff?"""
    marked = at_cutoffs(rows, cutoffs).withColumn(
        "reason_mask", reason_mask(F.col("decision_cutoff_at"))
    )
    return marked.select(
        "cutoff_id",
        "decision_cutoff_at",
        "logical_key",
        "record_digest",
        (F.col("reason_mask") == 0).alias("eligible"),
        reason_names(F.col("reason_mask")).alias("reasons"),
        "known_at",
        "known_at_basis",
    )
