"""Provider payloads (JSON text) -> envelopes, events and outcome rows.

Provider payloads are read tolerantly: what is not an object, or lacks a needed text
field, is skipped; the envelope itself is judged and reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.functions.timeops import utc_z_instant


def _kind(variant: Column) -> Column:
    """STRING, BIGINT, DECIMAL, ... of a scalar; null when absent or unreadable. Objects and arrays are told by casts,
    which look at one level only: their schema would be that of all that they hold."""
    return F.split_part(F.schema_of_variant(variant), F.lit("("), F.lit(1))


def _listed(variant: Column) -> Column:
    return variant.try_cast("array<variant>")


def _is_object(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "struct<>").isNotNull()


def _part(variant: Column, name: str) -> Column:
    return F.try_variant_get(variant, f"$.{name}", "variant")


def text_field(variant: Column, name: str) -> Column:
    """The field if it is a JSON string, else null: numbers are not turned into text."""
    return F.when(_kind(_part(variant, name)) == "STRING", F.try_variant_get(variant, f"$.{name}", "string"))


def number_field(variant: Column, name: str) -> Column:
    numeric = _kind(_part(variant, name)).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    return F.when(numeric, F.try_variant_get(variant, f"$.{name}", "double"))


def items(variant: Column) -> Column:
    """Object items of a JSON array; null for anything that is not an array."""
    return F.filter(_listed(variant), _is_object)


def _once(**columns: Column) -> Column:
    """The columns, generated: filters on them are not moved below, where they would be computed again."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def envelopes(payloads: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """Historical wrapper: provider time, event items and a code where it is unusable."""
    doc = payloads.select(*keep, _once(doc=F.try_parse_json(F.col(payload))))
    stamp = text_field(F.col("doc"), "timestamp")
    read = doc.select(*keep, _once(
        is_object=_is_object(F.col("doc")),
        provider_snapshot_text=stamp,
        provider_snapshot_at=utc_z_instant(stamp),
        events=items(_part(F.col("doc"), "data")),
    ))
    code = (
        F.when(~F.col("is_object"), "NOT_AN_OBJECT")
        .when(F.col("provider_snapshot_text").isNull(), "MISSING_TIMESTAMP")
        .when(F.col("events").isNull(), "MISSING_DATA")
        .when(F.col("provider_snapshot_at").isNull(), "TIMESTAMP_NOT_UTC_Z")
    )
    return read.select(*keep, "provider_snapshot_text", "provider_snapshot_at", "events", code.alias("code"))


def provider_events(payloads: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """Events of a wrapper or a bare list that carry all four needed texts."""
    doc = payloads.select(*keep, F.try_parse_json(F.col(payload)).alias("doc"))
    listed = F.coalesce(items(_part(F.col("doc"), "data")), items(F.col("doc")))
    event = F.col("event")
    out = doc.select(*keep, F.explode(listed).alias("event")).select(
        *keep,
        text_field(event, "id").alias("provider_event_id"),
        text_field(event, "commence_time").alias("kickoff"),
        text_field(event, "home_team").alias("provider_home_team"),
        text_field(event, "away_team").alias("provider_away_team"),
    )
    for name in ("provider_event_id", "kickoff", "provider_home_team", "provider_away_team"):
        out = out.filter(F.col(name) != "")
    return out


def outcome_rows(payload_envelopes: DataFrame, keep: list[str]) -> DataFrame:
    """Envelope -> one row per event x bookmaker x market x outcome.

    Outer at every level, so an event without bookmakers still counts as seen. When an
    event id repeats in one payload the last one is used, as in a keyed lookup. Bookmakers
    are told apart by their position: two entries may share a key. The envelope's
    next_timestamp is never read here.
    """
    above = [
        *keep, "provider_snapshot_at", "provider_event_id", "commence_time", "home_team", "away_team", "bookmaker_no",
    ]
    event, book, market, outcome = (F.col(c) for c in ("event", "book", "market", "outcome"))
    placed = F.sort_array(
        F.transform(
            F.col("events"), lambda e, i: F.struct(text_field(e, "id").alias("id"), i.alias("at"))
        )
    )
    last_of_id = F.transform(
        F.filter(
            F.col("placed"),
            lambda p, j: (p["id"] != "")
            & ~F.coalesce(F.get(F.col("placed"), j + 1)["id"] == p["id"], F.lit(False)),
        ),
        lambda p: F.get(F.col("events"), p["at"]),
    )
    return (
        payload_envelopes.filter("code is null")
        .withColumn("placed", placed)
        .select(*keep, "provider_snapshot_at", last_of_id.alias("own_events"))
        .select(*keep, "provider_snapshot_at", F.explode_outer("own_events").alias("event"))
        .filter("event is not null")
        # What a level says is read before the next one is exploded, so no document rides along.
        .select(
            *keep,
            "provider_snapshot_at",
            text_field(event, "id").alias("provider_event_id"),
            text_field(event, "commence_time").alias("commence_time"),
            text_field(event, "home_team").alias("home_team"),
            text_field(event, "away_team").alias("away_team"),
            items(_part(event, "bookmakers")).alias("books"),
        )
        .select(*above[:-1], F.posexplode_outer("books").alias("bookmaker_no", "book"))
        .select(
            *above,
            F.when(book.isNotNull(), F.coalesce(text_field(book, "key"), F.lit(""))).alias("bookmaker"),
            text_field(book, "last_update").alias("bookmaker_last_update"),
            items(_part(book, "markets")).alias("markets"),
        )
        .select(
            *above, "bookmaker", "bookmaker_last_update", F.posexplode_outer("markets").alias("market_no", "market")
        )
        .select(
            *above,
            "bookmaker",
            "bookmaker_last_update",
            "market_no",
            text_field(market, "key").alias("market_key"),
            text_field(market, "last_update").alias("market_last_update"),
            items(_part(market, "outcomes")).alias("outcomes"),
        )
        .select(
            *above, "bookmaker", "bookmaker_last_update", "market_no", "market_key", "market_last_update",
            F.explode_outer("outcomes").alias("outcome"),
        )
        .select(
            *above,
            "bookmaker",
            "bookmaker_last_update",
            "market_no",
            "market_key",
            "market_last_update",
            text_field(outcome, "name").alias("outcome_name"),
            number_field(outcome, "price").alias("price"),
            number_field(outcome, "point").alias("point"),
        )
    )
