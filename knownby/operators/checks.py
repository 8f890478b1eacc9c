"""Table-level consistency checks. Each returns violation rows (code, subject, detail)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownby.domains import CUTOFF_OFFSET_SECONDS
from knownby.functions.urls import form_encode
from knownby.operators.scans import carried_before, number_block
from knownby.operators.skew import hot_keys, join_summary


def violations(df: DataFrame, code: str, subject: Column, detail: Column | None = None) -> DataFrame:
    detail = F.lit(None).cast("string") if detail is None else detail.cast("string")
    return df.select(F.lit(code).alias("code"), subject.cast("string").alias("subject"), detail.alias("detail"))


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicates(df: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """Keys on more than one row, with the row count."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return violations(repeated, code, F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), F.col("n"))


def set_difference(declared: DataFrame, observed: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """Exact set equality: values on one side only, told apart by ``detail``."""
    left, right = declared.select(*keys).distinct(), observed.select(*keys).distinct()
    subject = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return all_of(
        violations(left.exceptAll(right), code, subject, F.lit("declared only")),
        violations(right.exceptAll(left), code, subject, F.lit("observed only")),
    )


def unknown_reference(df: DataFrame, column: str, declared: DataFrame, target: str, code: str) -> DataFrame:
    """Distinct values of ``column`` that no ``declared.target`` has."""
    known = declared.select(F.col(target).alias(column)).distinct()
    lost = df.select(column).filter(F.col(column).isNotNull()).distinct().join(known, column, "left_anti")
    return violations(lost, code, F.col(column))


def contiguous_index(df: DataFrame, column: str, size: int) -> DataFrame:
    """The column covers exactly 1..size once. Gaps come as ranges between neighbours.

    Present values are counted per value; a missing run is found from the sorted distinct
    values inside value blocks, so no list of all expected values is built.
    """
    present = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    value = F.col(column)
    block_size = 65_536
    in_range = present.filter(value.between(1, size)).withColumn("block", F.floor((value - 1) / block_size))
    inner = Window.partitionBy("block").orderBy(column)
    steps = in_range.select(
        value.alias("value"), F.lag(column).over(inner).alias("prior"), "block"
    )
    inside = steps.filter(F.col("value") - F.col("prior") > 1).select(
        (F.col("prior") + 1).alias("lo"), (F.col("value") - 1).alias("hi")
    )
    # One row per non-empty block; those rows are scanned in blocks again.
    edges = in_range.groupBy("block").agg(F.min(value).alias("first"), F.max(value).alias("last"))
    ends = edges.select("first", "last").unionByName(
        df.sparkSession.createDataFrame([(0, 0), (size + 1, size + 1)], "first long, last long")
    )
    blocks = ends.withColumn("_block", number_block(F.col("first"), block_size * 1_024))
    across = carried_before(blocks, [], "_block", "first", {"prior": ("last", "last")}).filter(
        F.col("first") - F.col("prior") > 1
    ).select((F.col("prior") + 1).alias("lo"), (F.col("first") - 1).alias("hi"))
    gaps = inside.unionByName(across)
    return all_of(
        violations(present.filter("n > 1"), "DUPLICATE_INDEX", value, F.col("n")),
        violations(present.filter(~value.between(1, size)), "INDEX_OUT_OF_RANGE", value),
        violations(gaps, "MISSING_INDEX", F.col("lo"), F.col("hi")),
    )


def group_cardinality(
    df: DataFrame, keys: Sequence[str], expected: int, code: str, domain: DataFrame | None = None
) -> DataFrame:
    """Groups whose row count differs; with ``domain`` absent groups count as 0."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if domain is not None:
        counted = domain.select(*keys).distinct().join(counted, list(keys), "left").na.fill(0, ["n"])
    return violations(
        counted.filter(F.col("n") != expected), code,
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), F.col("n"),
    )


def team_appearances(fixtures: DataFrame, week: str, home: str, away: str, expected: int = 1) -> DataFrame:
    """Each team exactly ``expected`` times per week, home and away counted together."""
    sides = fixtures.select(week, F.explode(F.array(home, away)).alias("team"))
    return group_cardinality(sides, [week, "team"], expected, "TEAM_WEEK_COUNT")


# Snapshot plan: groups(group_id, kickoff, cutoffs map<name, instant>) and queries.


def plan_cutoff_violations(
    groups: DataFrame, offsets: Mapping[str, int] = CUTOFF_OFFSET_SECONDS
) -> DataFrame:
    """Every group carries every cutoff, each exactly its offset before the kickoff."""
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("cutoff"), F.lit(seconds).alias("seconds"))
        for name, seconds in offsets.items()
    ]))
    each = groups.select("group_id", "kickoff", "cutoffs", wanted.alias("w")).select(
        "group_id", "kickoff", F.col("w.cutoff").alias("cutoff"), F.col("w.seconds").alias("seconds"),
        F.try_element_at("cutoffs", F.col("w.cutoff")).alias("at"),
    )
    subject = F.concat_ws("|", "group_id", "cutoff")
    delta = F.unix_micros("kickoff") - F.unix_micros("at")
    return all_of(
        duplicates(groups, ["group_id"], "DUPLICATE_GROUP"),
        violations(each.filter(F.col("at").isNull()), "MISSING_CUTOFF", subject),
        violations(
            each.filter(delta != F.col("seconds").cast("long") * 1_000_000), "CUTOFF_DELTA_MISMATCH",
            subject, (delta / 1_000_000).cast("long"),
        ),
    )


def plan_query_violations(queries: DataFrame, groups: DataFrame, offsets: Sequence[str]) -> DataFrame:
    """Query rows against declared groups: references, duplicates and exact times."""
    declared = groups.select("group_id", F.explode("cutoffs").alias("cutoff", "requested_at")).filter(
        F.col("cutoff").isin(*offsets)
    )
    return all_of(
        unknown_reference(queries, "group_id", groups, "group_id", "UNKNOWN_GROUP"),
        violations(
            queries.filter(~F.col("cutoff").isin(*offsets)), "UNEXPECTED_CUTOFF",
            F.concat_ws("|", "group_id", "cutoff"),
        ),
        duplicates(queries, ["group_id", "cutoff"], "DUPLICATE_QUERY"),
        set_difference(declared, queries, ["group_id", "cutoff", "requested_at"], "QUERY_SET_MISMATCH"),
    )


def _document_violations(documents: DataFrame, name: str, rules: Mapping[str, Column]) -> DataFrame:
    """A rule that is false or null is broken."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(kept, F.lit(False)), F.lit(code)) for code, kept in rules.items()])
    )
    return documents.select(
        F.explode(broken).alias("code"), F.col(name).cast("string").alias("subject"),
        F.lit(None).cast("string").alias("detail"),
    )


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def declared_plan_violations(documents: DataFrame, name: str, groups: int, cutoffs: Sequence[str]) -> DataFrame:
    """What a plan document declares about itself: counts, and the cutoff set in order."""
    wanted = groups * len(cutoffs)
    return _document_violations(documents, name, {
        "GROUP_COUNT_DECLARED": F.col("kickoff_group_count") == groups,
        "CUTOFFS_DECLARED": F.col("cutoffs_per_group") == _texts(cutoffs),
        "QUERY_COUNT_DECLARED": F.col("planned_query_count") == wanted,
        "GROUP_COUNT": F.size("kickoff_groups") == groups,
        "QUERY_COUNT": F.size("query_plan") == wanted,
    })


def declared_fixture_violations(
    documents: DataFrame, name: str, fixtures: int, weeks: Sequence[str], teams: int, aliases: Mapping[str, str]
) -> DataFrame:
    """What a fixture document declares: counts, weeks in order, team keys and alias map."""
    entries = F.array_sort(F.map_entries("source_label_aliases"))
    expected = F.array_sort(F.map_entries(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])))
    keys = F.col("source_identity_team_keys")
    return _document_violations(documents, name, {
        "FIXTURE_COUNT_DECLARED": F.col("fixture_count") == fixtures,
        "FIXTURE_COUNT": F.size("fixtures") == fixtures,
        "WEEKS_DECLARED": F.col("matchweeks") == _texts(weeks),
        "TEAM_KEY_COUNT": F.size(keys) == teams,
        "TEAM_KEYS_REPEATED": F.size(F.array_distinct(keys)) == F.size(keys),
        "ALIAS_MAP": entries == expected,
    })


def fixture_violations(fixtures: DataFrame, groups: DataFrame, weeks: Sequence[str]) -> DataFrame:
    """Row rules, references and duplicates of expected fixtures."""
    subject = F.col("fixture_index")
    needed = (
        "matchweek", "official_home_name", "official_away_name", "home_key", "away_key",
        "kickoff", "kickoff_group_id",
    )
    typed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    known = groups.groupBy("group_id").agg(F.min("kickoff").alias("group_kickoff"))
    group = ["kickoff_group_id"]
    referred = join_summary(
        fixtures.filter(F.col("kickoff_group_id").isNotNull()),
        known.withColumnRenamed("group_id", "kickoff_group_id"),
        group, hot_keys(fixtures, group), group, ["fixture_index"], how="left",
    )
    return all_of(
        violations(fixtures.filter(typed), "INVALID_IDENTITY_FIELDS", subject),
        violations(fixtures.filter(~F.col("matchweek").isin(*weeks)), "UNEXPECTED_MATCHWEEK", subject),
        violations(
            fixtures.filter(F.col("official_home_name") == F.col("official_away_name")), "SELF_MATCH", subject
        ),
        violations(
            referred.filter(F.col("group_kickoff").isNull()), "UNKNOWN_GROUP", subject,
        ),
        violations(
            referred.filter(F.col("group_kickoff") != F.col("kickoff")), "GROUP_KICKOFF_MISMATCH", subject
        ),
        violations(
            fixtures.filter(F.col("canonical_event_id").isNotNull()), "CANONICAL_ID_ASSIGNED", subject
        ),
        violations(
            fixtures.filter(F.coalesce(F.size("provider_event_ids"), F.lit(-1)) != 0),
            "PROVIDER_IDS_NOT_EMPTY", subject,
        ),
        duplicates(
            fixtures, ["official_home_name", "official_away_name", "kickoff"], "DUPLICATE_FIXTURE"
        ),
        duplicates(fixtures, ["kickoff", "home_key", "away_key"], "DUPLICATE_FIXTURE_IDENTITY"),
    )


def request_grid(
    fixtures: DataFrame, base_url: str, parameters: Mapping[str, str],
    offsets: Mapping[str, int] = CUTOFF_OFFSET_SECONDS,
) -> DataFrame:
    """One request per kickoff group and cutoff; fixtures of a group share it. Sends nothing."""
    fixed = "&".join(f"{k}={v}" for k, v in parameters.items())
    offset = F.explode(F.array(*[
        F.struct(F.lit(name).alias("cutoff"), F.lit(seconds).alias("seconds"))
        for name, seconds in offsets.items()
    ]))
    groups = fixtures.select(F.col("kickoff_group_id").alias("group_id"), "kickoff").distinct()
    grid = groups.select("group_id", "kickoff", offset.alias("o")).select(
        "group_id",
        F.col("o.cutoff").alias("cutoff"),
        F.timestamp_micros(
            F.unix_micros("kickoff") - F.col("o.seconds").cast("long") * 1_000_000
        ).alias("requested_at"),
    )
    stamp = F.date_format("requested_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    slug = F.replace(F.replace(F.lower("cutoff"), F.lit("-"), F.lit("")), F.lit("h"), F.lit("h-"))
    name = F.regexp_replace(F.concat_ws("-", F.lit("stage-a"), F.lower("group_id"), slug), r"^-+|-+$", "")
    return grid.select(
        "group_id", "cutoff", "requested_at", name.alias("probe_name"),
        F.concat(F.lit(f"{base_url}?{fixed}&date="), form_encode(stamp)).alias("url"),
    )


def request_slice(requests: DataFrame, order: Sequence[str], offset: int, limit: int | None) -> DataFrame:
    """Requests ``offset``.. in order; ``limit`` None means all of them, whatever the offset."""
    if offset < 0:
        raise ValueError("offset must be >= 0")
    if limit is not None and limit < 1:
        raise ValueError("limit must be >= 1")
    return requests if limit is None else requests.orderBy(*order).offset(offset).limit(limit)


def estimated_credits(requests: DataFrame, credits_per_request: int) -> DataFrame:
    if credits_per_request < 1:
        raise ValueError("credits_per_request must be >= 1")
    return requests.agg(
        F.count(F.lit(1)).alias("request_count"),
        (F.count(F.lit(1)) * credits_per_request).alias("credits"),
    )


def successor_violations(
    assessments: DataFrame, scope: Sequence[str] = ("sport", "market_family", "competition")
) -> DataFrame:
    """Version chain per scope: versions strictly increase, known_at never goes back.

    Compared by version order through block-wise carried values, see ``scans``.
    """
    # A struct of nullable fields is a key of its own for every null: no text can be mistaken for one.
    named = assessments.select(F.struct(*scope).alias("_scope"), "assessment_version", "known_at")
    versions = named.groupBy("_scope", "assessment_version").agg(
        F.count(F.lit(1)).alias("n"), F.min("known_at").alias("lo"), F.max("known_at").alias("hi")
    )
    parts = [F.coalesce(F.col("_scope")[c].cast("string"), F.lit("-")) for c in scope]
    subject = F.concat_ws("|", *parts, F.col("assessment_version").cast("string"))
    prior = carried_before(
        versions.withColumn("_block", number_block(F.col("assessment_version"))),
        ["_scope"], "_block", "assessment_version", {"prior_hi": ("hi", "last")},
    )
    return all_of(
        violations(versions.filter("n > 1"), "ASSESSMENT_VERSION_NOT_INCREASING", subject, F.col("n")),
        violations(
            prior.filter(F.col("lo") < F.col("prior_hi")), "ASSESSMENT_KNOWN_AT_REGRESSION", subject
        ),
    )


def declared_successor_violations(
    assessments: DataFrame, identity: str, previous: str,
    scope: Sequence[str] = ("sport", "market_family", "competition"),
) -> DataFrame:
    """Successors that name their predecessor: same scope, a higher version, known no earlier.

    ``previous`` holds the ``identity`` of the predecessor. Of several broken rules the first counts, in the order
    scope, version, instant. A predecessor that is nowhere is REFERENCE_UNKNOWN.
    """
    fields = F.struct(*scope)
    later = assessments.filter(F.col(previous).isNotNull()).select(
        identity, previous, fields.alias("_scope"), F.col("assessment_version").alias("_v"), F.col("known_at").alias("_k")
    )
    earlier = assessments.select(
        F.col(identity).alias(previous), fields.alias("_old_scope"), F.col("assessment_version").alias("_old_v"), F.col("known_at").alias("_old_k")
    )
    code = (
        F.when(F.col("_old_scope").isNull(), "REFERENCE_UNKNOWN")
        .when(~F.col("_scope").eqNullSafe(F.col("_old_scope")), "ASSESSMENT_SCOPE_MISMATCH")
        .when(F.col("_v") <= F.col("_old_v"), "ASSESSMENT_VERSION_NOT_INCREASING")
        .when(F.col("_k") < F.col("_old_k"), "ASSESSMENT_KNOWN_AT_REGRESSION")
    )
    found = later.join(earlier, previous, "left").select(code.alias("code"), F.col(identity), F.col(previous))
    return found.filter("code is not null").select(
        "code", F.col(identity).cast("string").alias("subject"), F.col(previous).cast("string").alias("detail")
    )
