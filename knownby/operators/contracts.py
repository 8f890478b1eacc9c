"""Rule tables of the record types. ``at`` is the column path of the record ("" or "x.")."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from knownby import domains as D
from knownby.functions.scalars import is_blank, state_rank
from knownby.operators.rules import (
    Rule,
    array_rule,
    digest,
    finite,
    identifier,
    in_domain,
    not_blank,
    probability,
    required,
    unique_items,
)


def _present(record: str, rules: list[Rule]) -> list[Rule]:
    """Rules of an optional nested record: they count only where the record is there."""
    there = F.col(record).isNotNull()
    return [Rule(r.code, r.field, there & r.violated) for r in rules]


def source_ref(at: str = "") -> list[Rule]:
    return [
        *required(at + "source_id", at + "tier"),
        *not_blank(at + "source_id", at + "source_version"),
        *in_domain(at + "tier", D.SOURCE_TIERS),
    ]


def source_tier_label(field: str) -> list[Rule]:
    known = F.col(field).isin(*D.SOURCE_TIERS, *D.LEGACY_SOURCE_TIERS)
    return [Rule("UNKNOWN_SOURCE_TIER", field, ~known)]


def temporal(at: str = "") -> list[Rule]:
    known, basis = F.col(at + "known_at"), F.col(at + "known_at_basis")
    received = F.col(at + "received_at")
    return [
        *in_domain(at + "known_at_basis", D.KNOWN_AT_BASES),
        Rule("KNOWN_AT_BASIS_MISMATCH", at + "known_at_basis", known.isNull() != basis.isNull()),
        Rule(
            "KNOWN_AT_RECEIPT_MISMATCH",
            at + "known_at",
            (basis == "SYSTEM_RECEIPT") & ~(known.isNotNull() & known.eqNullSafe(received)),
        ),
        Rule("INVALID_VALIDITY_WINDOW", at + "valid_from", F.col(at + "valid_from") > F.col(at + "valid_to")),
    ]


def critical_use(at: str = "", cutoff: str = "decision_cutoff_at") -> list[Rule]:
    known = F.col(at + "known_at")
    return [
        Rule("KNOWN_AT_MISSING", at + "known_at", known.isNull()),
        Rule("KNOWN_AT_AFTER_CUTOFF", at + "known_at", known > F.col(cutoff)),
    ]


def data_state(at: str = "") -> list[Rule]:
    axes = {
        "quality": D.QUALITY_STATES,
        "freshness": D.FRESHNESS_STATES,
        "verification": D.VERIFICATION_STATES,
        "conflict": D.CONFLICT_STATES,
    }
    out = required(*[at + axis for axis in axes])
    for axis, values in axes.items():
        out += in_domain(at + axis, values)
    return out


def provenance(at: str = "") -> list[Rule]:
    return [
        *source_ref(at + "source."),
        *not_blank(at + "external_id"),
        *temporal(at + "temporal."),
        *data_state(at + "data_state."),
        *required(at + "critical"),
        Rule("RECEIVED_AT_MISSING", at + "temporal.received_at", F.col(at + "temporal.received_at").isNull()),
        Rule(
            "KNOWN_AT_MISSING",
            at + "temporal.known_at",
            F.col(at + "critical") & F.col(at + "temporal.known_at").isNull(),
        ),
    ]


def raw_snapshot(at: str = "") -> list[Rule]:
    names = [at + n for n in ("source_id", "request_identity", "ingestion_version")]
    return [
        *required(*names, at + "payload_sha256", at + "received_at"),
        *not_blank(*names),
        *digest(at + "payload_sha256"),
    ]


def observation() -> list[Rule]:
    raw = F.col("raw_snapshot")
    return [
        *required("logical_key", "payload_sha256", "provenance"),
        *not_blank("logical_key", "revision_id"),
        *digest("payload_sha256"),
        *provenance("provenance."),
        *_present("raw_snapshot", raw_snapshot("raw_snapshot.")),
        Rule(
            "RAW_SNAPSHOT_SOURCE_MISMATCH",
            "raw_snapshot.source_id",
            F.col("raw_snapshot.source_id") != F.col("provenance.source.source_id"),
        ),
        Rule(
            "RAW_SNAPSHOT_RECEIVED_AT_MISMATCH",
            "raw_snapshot.received_at",
            raw.isNotNull()
            & ~F.col("raw_snapshot.received_at").eqNullSafe(F.col("provenance.temporal.received_at")),
        ),
    ]


def entity_id(at: str = "") -> list[Rule]:
    return [
        *required(at + "sport", at + "kind", at + "value"),
        *in_domain(at + "sport", D.SPORTS),
        *in_domain(at + "kind", D.ENTITY_KINDS),
        *not_blank(at + "value"),
    ]


def entity_ref(at: str = "") -> list[Rule]:
    refs = at + "provider_refs"
    canonical_kind = F.col(at + "canonical_id.kind")
    return [
        *entity_id(at + "canonical_id."),
        *required(refs),
        array_rule("EMPTY_VALUE", refs, lambda r: is_blank(r["provider_id"]) | is_blank(r["external_id"])),
        array_rule("UNKNOWN_ENUM_VALUE", refs, lambda r: ~r["kind"].isin(*D.ENTITY_KINDS)),
        array_rule("ENTITY_KIND_MISMATCH", refs, lambda r: r["kind"] != canonical_kind),
        *unique_items(
            refs, F.transform(F.col(refs), lambda r: F.struct(r["provider_id"], r["external_id"]))
        ),
    ]


def _catalog(family: Column, position: int) -> Column:
    out = F.lit(None).cast("string")
    for entry in D.MARKET_CATALOG:
        out = F.when(family == entry[1], F.lit(entry[position])).otherwise(out)
    return out


def market_descriptor(at: str = "") -> list[Rule]:
    family = F.col(at + "market_family")
    return [
        *required(at + "sport", at + "market_family", at + "market_type", at + "market_instance", at + "mr_base"),
        *in_domain(at + "sport", D.SPORTS),
        *in_domain(at + "market_family", D.MARKET_FAMILIES),
        *in_domain(at + "mr_base", D.MARKET_RISK_CLASSES),
        *not_blank(at + "market_type", at + "market_instance"),
        Rule("MARKET_SPORT_MISMATCH", at + "sport", _catalog(family, 0) != F.col(at + "sport")),
        Rule("MR_BASE_MISMATCH", at + "mr_base", _catalog(family, 3) != F.col(at + "mr_base")),
    ]


def probability_estimate(at: str = "") -> list[Rule]:
    numbers = [at + n for n in ("p_raw", "p_calibrated", "p_safe")]
    return [
        *required(at + "selection_id", *numbers),
        *not_blank(at + "selection_id"),
        *probability(*numbers),
        Rule("P_SAFE_EXCEEDS_CALIBRATED", at + "p_safe", F.col(at + "p_safe") > F.col(at + "p_calibrated")),
    ]


def edge_assessment(at: str = "", estimate: str = "") -> list[Rule]:
    """Stored edges equal the formula exactly: no tolerance."""
    market = F.col(at + "p_market_no_vig")
    out = [*probability_estimate(estimate), *probability(at + "p_market_no_vig")]
    for stored, source in (("edge_calibrated", "p_calibrated"), ("edge_safe", "p_safe")):
        out += finite(at + stored)
        out.append(
            Rule("EDGE_FORMULA_MISMATCH", at + stored, F.col(at + stored) != F.col(estimate + source) - market)
        )
    return out


def state_and_edge(state: str = "state", edge_safe: str = "edge_safe") -> list[Rule]:
    return [
        *in_domain(state, D.DECISION_STATES),
        Rule(
            "NEGATIVE_EDGE_SAFE_CANNOT_QUALIFY",
            edge_safe,
            (F.col(state) == "QUALIFIED") & (F.col(edge_safe) < 0),
        ),
    ]


def gate_result(at: str = "") -> list[Rule]:
    codes, evidence = at + "reason_codes", at + "evidence"
    return [
        *required(at + "gate_id", at + "outcome", codes, evidence, at + "evaluated_at"),
        *identifier(at + "gate_id"),
        *in_domain(at + "outcome", D.DECISION_STATES),
        array_rule("INVALID_IDENTIFIER", codes, lambda c: ~c.rlike(r"\A[A-Z][A-Z0-9_]*\z")),
        *unique_items(codes),
        array_rule("EMPTY_VALUE", evidence, lambda e: is_blank(e["key"]) | is_blank(e["reference"])),
        *unique_items(evidence, F.transform(F.col(evidence), lambda e: e["key"])),
        Rule(
            "REASON_CODE_REQUIRED",
            codes,
            (state_rank(F.col(at + "outcome")) > 0) & (F.size(codes) == 0),
        ),
    ]


def claim(at: str = "") -> list[Rule]:
    subjects, channels = at + "subjects", at + "effect_channels"
    return [
        *required(at + "claim_id", at + "claim_type", subjects, at + "statement", at + "provenance", channels),
        *not_blank(at + "claim_id", at + "statement"),
        *in_domain(at + "claim_type", D.CLAIM_TYPES),
        array_rule("EMPTY_VALUE", subjects, lambda s: is_blank(s["value"])),
        array_rule(
            "UNKNOWN_ENUM_VALUE", subjects,
            lambda s: ~s["sport"].isin(*D.SPORTS) | ~s["kind"].isin(*D.ENTITY_KINDS),
        ),
        array_rule("UNKNOWN_ENUM_VALUE", channels, lambda c: ~c.isin(*D.EFFECT_CHANNELS)),
        *unique_items(subjects),
        *unique_items(channels),
        *provenance(at + "provenance."),
    ]


def dependency(at: str = "") -> list[Rule]:
    names = [at + n for n in ("selection_a", "selection_b", "basis")]
    return [
        *required(*names, at + "dependency_class"),
        *not_blank(*names),
        *in_domain(at + "dependency_class", D.DEPENDENCY_CLASSES),
        Rule("SELF_DEPENDENCY", at + "selection_b", F.col(names[0]) == F.col(names[1])),
    ]


def code_version(at: str = "") -> list[Rule]:
    return [
        *required(at + "commit"),
        Rule("INVALID_COMMIT_REF", at + "commit", ~F.col(at + "commit").rlike(r"\A[0-9a-f]{40}\z")),
    ]


def artifact_ref(at: str = "", allowed: tuple[str, ...] = D.ARTIFACT_KINDS) -> list[Rule]:
    kind = F.col(at + "kind")
    return [
        *required(at + "kind", at + "identifier", at + "version"),
        *in_domain(at + "kind", D.ARTIFACT_KINDS),
        *not_blank(at + "identifier", at + "version"),
        Rule(
            "ARTIFACT_KIND_MISMATCH", at + "kind", kind.isin(*D.ARTIFACT_KINDS) & ~kind.isin(*allowed)
        ),
    ]


def reproducibility(at: str = "") -> list[Rule]:
    models = at + "model_refs"
    return [
        *required(at + "run_id", models),
        *not_blank(at + "run_id"),
        *code_version(at + "code_version."),
        *artifact_ref(at + "data_ref.", D.DATA_ARTIFACT_KINDS),
        *artifact_ref(at + "config_ref.", ("CONFIGURATION",)),
        array_rule("EMPTY_VALUE", models, lambda m: is_blank(m["identifier"]) | is_blank(m["version"])),
        array_rule("ARTIFACT_KIND_MISMATCH", models, lambda m: ~m["kind"].isin(*D.MODEL_ARTIFACT_KINDS)),
        *unique_items(models),
    ]


def assessment(at: str = "") -> list[Rule]:
    competition, samples = F.col(at + "competition"), at + "sample_sizes"
    texts = [at + n for n in ("stability", "data_quality", "drift", "baseline_scope", "model_scope")]
    skill = [at + n for n in ("oos_brier", "oos_log_loss", "oos_skill")]
    period = at + "evaluation_period."
    return [
        *required(at + "assessment_version", at + "sport", at + "market_family", at + "evidence_status",
                  samples, period + "start", period + "end", at + "known_at", *texts),
        *in_domain(at + "sport", D.SPORTS),
        *in_domain(at + "predictability_prior", D.PREDICTABILITY_CLASSES),
        *in_domain(at + "predictability_empirical", D.PREDICTABILITY_CLASSES),
        *in_domain(at + "evidence_status", D.EVIDENCE_STATUSES),
        Rule("INVALID_ASSESSMENT_VERSION", at + "assessment_version", F.col(at + "assessment_version") < 1),
        *identifier(at + "market_family"),
        *_present(at + "competition", entity_id(at + "competition.")),
        Rule(
            "INVALID_COMPETITION",
            at + "competition",
            competition.isNotNull()
            & ((competition["kind"] != "COMPETITION") | (competition["sport"] != F.col(at + "sport"))),
        ),
        Rule(
            "EMPIRICAL_CLASS_REQUIRED",
            at + "predictability_empirical",
            (F.col(at + "evidence_status") == "VALIDATED") & F.col(at + "predictability_empirical").isNull(),
        ),
        *finite(*skill),
        Rule("INVALID_METRIC", at + "oos_brier", F.col(at + "oos_brier") < 0),
        Rule("INVALID_METRIC", at + "oos_log_loss", F.col(at + "oos_log_loss") < 0),
        *probability(at + "oos_ece"),
        array_rule("EMPTY_VALUE", samples, lambda s: is_blank(s["label"])),
        array_rule("NEGATIVE_SAMPLE_SIZE", samples, lambda s: s["count"] < 0),
        *unique_items(samples, F.transform(F.col(samples), lambda s: s["label"])),
        *not_blank(*texts),
        Rule("INVALID_EVALUATION_PERIOD", period + "start", F.col(period + "start") > F.col(period + "end")),
        *artifact_ref(at + "dataset_version_or_snapshot.", D.DATA_ARTIFACT_KINDS),
        *code_version(at + "code_version."),
        Rule("KNOWN_AT_BEFORE_EVALUATION_END", at + "known_at", F.col(at + "known_at") < F.col(period + "end")),
    ]


