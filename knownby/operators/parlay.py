"""Summary of given multi-leg selections; nothing is searched or optimised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.domains import MARKET_RISK_CLASSES
from knownby.functions.scalars import leg_band, probability_band, return_band, risk_ordinal


def parlay_summary(legs: DataFrame, dependencies: DataFrame) -> DataFrame:
    """legs(parlay_id, selection_id, sport, mr, odds, p_safe), dependencies(parlay_id,
    selection_a, selection_b, dependency_class): one assertion per unordered pair.

    A combined probability exists only when every one of the n(n-1)/2 pairs is asserted
    independent; pairs are counted, never laid out. A contradictory pair rejects.
    """
    mr = risk_ordinal(F.col("mr"))
    base = legs.groupBy("parlay_id").agg(
        F.count(F.lit(1)).alias("legs"),
        F.max(mr).alias("_max_mr"),
        *[F.count(F.when(F.col("mr") == m, 1)).alias(f"count_{m.lower()}") for m in MARKET_RISK_CLASSES],
        F.count(F.when(mr >= 4, 1)).alias("count_mr4_plus"),
        F.min("sport").alias("_s0"), F.max("sport").alias("_s1"),
        F.product("odds").alias("combined_odds"),
        F.product("p_safe").alias("_p"),
    )
    low, high = F.least("selection_a", "selection_b"), F.greatest("selection_a", "selection_b")
    pairs = dependencies.groupBy("parlay_id", low.alias("a"), high.alias("b")).agg(
        F.max((F.col("dependency_class") != "independent").cast("int")).alias("dependent"),
        F.max((F.col("dependency_class") == "contradictory").cast("int")).alias("contradictory"),
    ).filter("a <> b").groupBy("parlay_id").agg(
        F.count(F.lit(1)).alias("asserted_pairs"),
        F.sum("dependent").alias("dependent_pairs"),
        F.sum("contradictory").alias("contradictory_pairs"),
    )
    n = F.col("legs")
    all_independent = (F.col("asserted_pairs") == n * (n - 1) / 2) & (F.col("dependent_pairs") == 0)
    odds, p = F.col("combined_odds"), F.col("_p")
    return (
        base.join(pairs, "parlay_id", "left")
        .na.fill(0, ["asserted_pairs", "dependent_pairs", "contradictory_pairs"])
        .select(
            "parlay_id", "legs", leg_band(n).alias("leg_band"),
            F.concat(F.lit("MR"), F.col("_max_mr").cast("string")).alias("max_mr"),
            *[f"count_{m.lower()}" for m in MARKET_RISK_CLASSES], "count_mr4_plus",
            F.when(F.col("_s0") == F.col("_s1"), "MONO_SPORT").otherwise("MULTI_SPORT").alias("sport_mix"),
            "combined_odds", return_band(odds).alias("return_band"),
            F.when(all_independent, p).alias("combined_p_safe"),
            probability_band(F.when(all_independent, p)).alias("probability_band"),
            F.when(F.col("contradictory_pairs") > 0, "REJECTED_CONTRADICTORY")
            .when(all_independent, "INDEPENDENT")
            .otherwise("JOINT_MODEL_REQUIRED")
            .alias("dependency_status"),
        )
    )
