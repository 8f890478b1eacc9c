"""Landed raw responses: identity, kind, header allow-list, metadata gate, source manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.domains import KEPT_RESPONSE_HEADERS
from knownby.functions.urls import redact_url
from knownby.operators.rules import Rule


def read_raw_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def payload_columns(content: Column) -> list[Column]:
    """Digest, size and JSON-or-text flag of response bytes."""
    text = content.cast("string")
    return [
        F.sha2(content, 256).alias("payload_sha256"),
        F.octet_length(content).cast("long").alias("payload_bytes"),
        F.when(F.try_parse_json(text).isNotNull(), "JSON").otherwise("TEXT").alias("payload_kind"),
    ]


def kept_headers(headers: Column) -> Column:
    return F.map_filter(headers, lambda name, _: F.lower(name).isin(*KEPT_RESPONSE_HEADERS))


def land(responses: DataFrame, extra_sensitive: tuple[str, ...] = ()) -> DataFrame:
    """responses(provider, probe_name, requested_at, received_at, request_url, http_status,
    headers, content) -> landing rows. ``received_at`` is retrieval time; no known_at."""
    return responses.select(
        F.lit(True).alias("research_only"),
        "provider",
        "probe_name",
        "requested_at",
        "received_at",
        redact_url(F.col("request_url"), extra_sensitive).alias("request_url_redacted"),
        "http_status",
        kept_headers(F.col("headers")).alias("selected_response_headers"),
        *payload_columns(F.col("content")),
        F.lit(False).alias("canonical_known_at_assigned"),
    )


def metadata_rules() -> list[Rule]:
    needed = (
        "provider", "probe_name", "requested_at", "received_at", "request_url_redacted",
        "payload_sha256", "payload_bytes", "payload_file",
    )
    return [
        Rule("NOT_RESEARCH_ONLY", "research_only", ~F.coalesce("research_only", F.lit(False))),
        Rule(
            "KNOWN_AT_ASSIGNED", "canonical_known_at_assigned",
            F.coalesce("canonical_known_at_assigned", F.lit(True)),
        ),
        *[Rule("MISSING_FIELD", name, F.col(name).isNull()) for name in needed],
    ]


def blob_sha1(content: Column) -> Column:
    """Object id of a file's bytes in a git object store."""
    head = F.concat(F.lit("blob "), F.octet_length(content).cast("string"))
    return F.sha1(F.concat(F.encode(head, "utf-8"), F.unhex(F.lit("00")), content))


def compare_to_manifest(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """found(path, sha) against manifest(path, sha): OK, CHANGED, MISSING or EXTRA."""
    left = found.select("path", F.col("sha").alias("found_sha"))
    right = manifest.select("path", F.col("sha").alias("recorded_sha"))
    status = (
        F.when(F.col("found_sha").isNull(), "MISSING")
        .when(F.col("recorded_sha").isNull(), "EXTRA")
        .when(F.col("found_sha") != F.col("recorded_sha"), "CHANGED")
        .otherwise("OK")
    )
    return left.join(right, "path", "full").withColumn("status", status)
