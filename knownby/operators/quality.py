"""Data-quality profile, results cross-check, confirmation counting, assessment lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.operators.scans import carried_before, carried_through, depth_blocks


def profile(rows: DataFrame, group: Sequence[str], conditions: dict[str, Column], nullable: Sequence[str]) -> DataFrame:
    """One pass: row count, rows meeting each named condition, null rate per column."""
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()],
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_missing_rate") for c in nullable],
    )


def duplicate_rate(rows: DataFrame, key: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key, by group; ``key`` includes the group."""
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*group).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("extra_rows")
    )


def revision_rate(observations: DataFrame, group: Sequence[str], key: str, payload: str) -> DataFrame:
    """Per group: keys, and keys whose payload was seen with more than one content."""
    per_key = observations.groupBy(*group, key).agg(
        F.min(payload).alias("lo"), F.max(payload).alias("hi")
    )
    return per_key.groupBy(*group).agg(
        F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("lo") != F.col("hi"), 1)).alias("revised_keys")
    )


def value_runs(rows: DataFrame, key: Sequence[str], at: str, tie: Sequence[str], value: str, block_rows: int = 65_536) -> DataFrame:
    """Per key: rows, runs of equal values in the order (``at``, ``tie``), the longest run, and changes of value.

    A null value is one of its own. The value before a row and the number of its run come from blocked scans,
    and runs are counted before keys, so no task holds a key.
    """
    order = [at, *tie]
    seen = F.struct(F.col(value).alias("v"))
    blocked = depth_blocks(rows.select(*key, *order, seen.alias("_now")), key, at, block_rows, "_block")
    before = carried_before(blocked, key, "_block", order, {"_before": ("_now", "last")})
    begins = F.when(F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(F.col("_now.v")), 1).otherwise(0)
    numbered = carried_through(before.withColumn("_begins", begins), key, "_block", order, {"_run": ("_begins", "sum")})
    runs = numbered.groupBy(*key, "_run").agg(F.count(F.lit(1)).alias("_n"))
    return runs.groupBy(*key).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("runs"), F.max("_n").alias("longest_run"),
        (F.count(F.lit(1)) - 1).alias("changes"),
    )


CROSS_CHECK = ("matchweek", "local_date", "local_time", "home_key", "away_key")


def cross_check(fixtures: DataFrame, results: DataFrame, on: str, dimensions: Sequence[str] = CROSS_CHECK) -> DataFrame:
    """Fixtures against results by a shared id: mismatches per dimension, rows on one side
    only, and result labels that no alias translated (null keys)."""
    left = fixtures.select(on, *[F.col(d).alias(f"f_{d}") for d in dimensions], F.lit(True).alias("in_f"))
    right = results.select(on, *[F.col(d).alias(f"r_{d}") for d in dimensions], F.lit(True).alias("in_r"))
    both = left.join(right, on, "full")
    paired = F.col("in_f") & F.col("in_r")
    differs = {d: paired & ~F.col(f"f_{d}").eqNullSafe(F.col(f"r_{d}")) for d in dimensions}
    any_differs = F.lit(False)
    for c in differs.values():
        any_differs = any_differs | F.coalesce(c, F.lit(False))
    return both.agg(
        F.count(F.when(F.col("in_f"), 1)).alias("fixtures"),
        *[F.count(F.when(c, 1)).alias(f"{d}_mismatches") for d, c in differs.items()],
        F.count(F.when(F.col("in_r").isNull(), 1)).alias("without_result"),
        F.count(F.when(F.col("in_f").isNull(), 1)).alias("without_fixture"),
        F.count(
            F.when(F.col("in_r") & (F.col("r_home_key").isNull() | F.col("r_away_key").isNull()), 1)
        ).alias("unaliased"),
        F.count(F.when(any_differs, 1)).alias("mismatched_fixtures"),
    )


def confirmations(claims: DataFrame, claim: str, independence_group: str) -> DataFrame:
    """Independent confirmations per claim: copies of one lineage count once.

    Counted in two combinable steps, so a claim repeated by a third of all rows stays cheap.
    """
    lineages = claims.groupBy(claim, independence_group).agg(F.count(F.lit(1)).alias("n"))
    return lineages.groupBy(claim).agg(
        F.sum("n").alias("reports"), F.count(independence_group).alias("independent_confirmations")
    )


def assessment_as_of(assessments: DataFrame, scope: Sequence[str], cutoff: Column, columns: Sequence[str]) -> DataFrame:
    """Per scope the highest version known at the cutoff (versions and known_at rise together)."""
    known = assessments.filter(F.col("known_at") <= cutoff)
    best = known.groupBy(*scope).agg(
        F.max(F.struct("assessment_version", *[c for c in columns if c != "assessment_version"])).alias("b")
    )
    return best.select(*scope, "b.*")
