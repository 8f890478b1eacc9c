"""Distribution change between a reference and a current window. Measures, no thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.functions.scalars import ratio
from knownby.operators.scans import carried_through


def edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """0 below the first edge .. len(edges) from the last edge on."""
    out = F.when(value.isNotNull(), F.lit(0))
    for i, edge in enumerate(edges, start=1):
        out = F.when(value >= edge, F.lit(i)).otherwise(out)
    return out


def category_shares(rows: DataFrame, current: Column, category: str, group: Sequence[str]) -> DataFrame:
    """Counts and shares of every category in both windows; absent categories count 0."""
    counted = rows.groupBy(*group, category).agg(
        F.count(F.when(~current, 1)).alias("reference"), F.count(F.when(current, 1)).alias("current")
    )
    totals = counted.groupBy(*group).agg(
        F.sum("reference").alias("reference_total"), F.sum("current").alias("current_total")
    )
    return counted.join(totals, list(group)).select(
        *group, category, "reference", "current",
        ratio(F.col("reference"), F.col("reference_total")).alias("reference_share"),
        ratio(F.col("current"), F.col("current_total")).alias("current_share"),
    )


def population_stability(shares: DataFrame, group: Sequence[str], floor: float) -> DataFrame:
    """PSI and total variation over categories or bins; ``floor`` bounds empty shares."""
    e = F.greatest(F.col("reference_share"), F.lit(floor))
    a = F.greatest(F.col("current_share"), F.lit(floor))
    return shares.groupBy(*group).agg(
        F.sum((a - e) * F.log(a / e)).alias("psi"),
        (F.sum(F.abs(F.col("current_share") - F.col("reference_share"))) / 2.0).alias("total_variation"),
    )


def kolmogorov_smirnov(rows: DataFrame, current: Column, value: str, group: Sequence[str], block: Column) -> DataFrame:
    """Largest distance of the two distribution functions.

    Values are counted first; the running counts are scanned in value blocks, so one group
    may have any number of values. ``block`` is a non-decreasing function of the value.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(
        F.count(F.when(~current, 1)).alias("reference"), F.count(F.when(current, 1)).alias("current")
    ).withColumn("_block", block)
    running = carried_through(
        counted, group, "_block", value, {"r": ("reference", "sum"), "c": ("current", "sum")}
    )
    totals = counted.groupBy(*group).agg(F.sum("reference").alias("rt"), F.sum("current").alias("ct"))
    gap = F.abs(ratio(F.col("r"), F.col("rt")) - ratio(F.col("c"), F.col("ct")))
    # One row per group meets that group's values; Spark splits the join where a group is large.
    joined = running.join(totals, list(group))
    return joined.groupBy(*group).agg(F.max(gap).alias("ks"))


def missingness_change(rows: DataFrame, current: Column, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Null rate of every column in both windows and its change, one pass."""
    parts = []
    for c in columns:
        absent = F.col(c).isNull().cast("double")
        parts += [
            F.avg(F.when(~current, absent)).alias(f"{c}_reference"),
            F.avg(F.when(current, absent)).alias(f"{c}_current"),
        ]
    wide = rows.groupBy(*group).agg(*parts)
    each = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"{c}_reference").alias("reference_rate"),
                F.col(f"{c}_current").alias("current_rate"),
                (F.col(f"{c}_current") - F.col(f"{c}_reference")).alias("change"),
            )
            for c in columns
        ]
    )
    return wide.select(*group, F.inline(each))
