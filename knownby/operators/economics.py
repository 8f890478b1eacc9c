"""Paper economics of settled selections at a fixed unit, and segment reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from knownby.functions.scalars import ratio
from knownby.operators.scans import carried_through


def settle(selections: DataFrame, odds: str, won: str, unit: float) -> DataFrame:
    """Profit of a fixed stake at the decision-time odds; an unsettled row stays null."""
    profit = F.when(F.col(won), F.lit(unit) * (F.col(odds) - 1.0)).when(~F.col(won), F.lit(-unit))
    return selections.withColumn("stake", F.when(F.col(won).isNotNull(), F.lit(unit))).withColumn("profit", profit)


def closing_value(decision_odds: Column, closing_odds: Column) -> Column:
    """CLV: relative price advantage over the closing odds. Evaluation only."""
    return F.try_divide(decision_odds, closing_odds) - F.lit(1.0)


def returns(settled: DataFrame, group: Sequence[str], bank: float) -> DataFrame:
    """Turnover, profit, yield (profit per stake) and ROI (profit per bank)."""
    return settled.groupBy(*group).agg(
        F.count("profit").alias("settled"),
        F.sum("stake").alias("turnover"),
        F.sum("profit").alias("profit"),
        ratio(F.sum("profit"), F.sum("stake")).alias("yield"),
        (F.sum("profit") / F.lit(bank)).alias("roi"),
        F.avg("clv").alias("mean_clv"),
    )


def drawdown(settled: DataFrame, group: Sequence[str], block: str, order: Sequence[str]) -> DataFrame:
    """Deepest fall of the running profit below its highest point so far (start included).

    Inside a block the running profit, its peak and its deepest fall are relative to the
    block's start; the block rows are then combined in order. The rows are read once.
    """
    inside = Window.partitionBy(*group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = settled.filter("profit is not null").select(
        *group, block, *order, F.sum("profit").over(inside).alias("_p")
    )
    peaks = run.select("*", F.greatest(F.max("_p").over(inside), F.lit(0.0)).alias("_peak"))
    at = F.struct(*order)
    blocks = peaks.groupBy(*group, block).agg(
        F.max_by("_p", at).alias("total"),
        F.max("_p").alias("top"),
        F.min("_p").alias("low"),
        F.max(F.col("_peak") - F.col("_p")).alias("own_fall"),
    )
    # Start of each block on the group's running profit, and the peak reached before it.
    started = carried_through(
        blocks.withColumn("_super", F.lit(0)), group, "_super", block, {"_end": ("total", "sum")}
    ).withColumn("_start", F.col("_end") - F.col("total"))
    topped = started.withColumn("_abs_top", F.col("_start") + F.col("top"))
    ahead = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    peaked = topped.select(
        "*", F.greatest(F.coalesce(F.max("_abs_top").over(ahead), F.lit(0.0)), F.lit(0.0)).alias("_before")
    )
    fall = F.greatest(F.col("own_fall"), F.col("_before") - (F.col("_start") + F.col("low")))
    return peaked.groupBy(*group).agg(
        F.sum("total").alias("profit"), F.greatest(F.max(fall), F.lit(0.0)).alias("max_drawdown")
    )


def segment_report(settled: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """One row per value of every single dimension, and the grand total.

    Equals GROUPING SETS over the single dimensions: the total has no dimension, and a null value is
    a segment of its dimension. Each row is expanded into its
    (dimension, value) pairs inside the map task and summed there.
    """
    pairs = F.array(
        F.struct(F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("string").alias("segment")),
        *[
            F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment"))
            for d in dimensions
        ],
    )
    return settled.select("stake", "profit", F.inline(pairs)).groupBy("dimension", "segment").agg(
        F.count("profit").alias("settled"), F.sum("stake").alias("turnover"), F.sum("profit").alias("profit"),
        ratio(F.sum("profit"), F.sum("stake")).alias("yield"),
    )


def segment_cube(settled: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """All combinations of the requested dimensions."""
    return settled.cube(*dimensions).agg(
        F.grouping_id().alias("level"), F.count("profit").alias("settled"), F.sum("profit").alias("profit")
    )
