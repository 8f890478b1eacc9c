"""JSON documents with explicit schemas, and the tables inside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby import schemas


def read_documents(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One row per JSON document file."""
    return spark.read.schema(ddl).option("multiLine", True).json(path)


def read_payload_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, payload): raw document text, for readers that judge the payload themselves."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("payload")
    )


def fixtures_of(documents: DataFrame) -> DataFrame:
    f = documents.select(F.explode("fixtures").alias("f")).select("f.*")
    return f.select(
        "fixture_index", "matchweek", "official_home_name", "official_away_name",
        F.col("kickoff_utc").alias("kickoff"), "kickoff_group_id", "canonical_event_id",
        "provider_event_ids",
        F.col("source_identity_home_key").alias("home_key"),
        F.col("source_identity_away_key").alias("away_key"),
    )


def plan_groups_of(documents: DataFrame) -> DataFrame:
    g = documents.select(F.explode("kickoff_groups").alias("g")).select("g.*")
    return g.withColumnRenamed("kickoff_utc", "kickoff")


def plan_queries_of(documents: DataFrame) -> DataFrame:
    q = documents.select(F.explode("query_plan").alias("q")).select("q.*")
    return q.withColumnRenamed("requested_snapshot_at_utc", "requested_at")


def read_fixture_document(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, schemas.FIXTURE_DOCUMENT)


def read_plan_document(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, schemas.PLAN_DOCUMENT)


def alias_entries(payloads: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Alias documents (label -> key) -> entries with a violation code where unusable.

    Columns: the ``keep`` columns, provider_label, identity_key, code.
    """
    doc = F.try_parse_json(F.col(payload))
    entries = payloads.select(
        *keep,
        F.schema_of_variant(doc).startswith("OBJECT").alias("is_object"),
        doc.alias("doc"),
    ).select(*keep, "is_object", F.explode_outer(
        F.when(F.col("is_object"), F.map_entries(F.col("doc").try_cast("map<string,variant>")))
    ).alias("e"))
    value = F.col("e.value")
    text = F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))
    return entries.filter(F.col("e").isNotNull() | ~F.coalesce("is_object", F.lit(False))).select(
        *keep,
        F.col("e.key").alias("provider_label"),
        text.alias("identity_key"),
        F.when(~F.coalesce("is_object", F.lit(False)), "NOT_AN_OBJECT")
        .when(text.isNull(), "NOT_A_STRING")
        .when((F.col("e.key") == "") | (text == ""), "EMPTY_VALUE")
        .alias("code"),
    )
