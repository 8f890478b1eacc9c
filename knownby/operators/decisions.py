"""Decision states per group, the market catalog, and state resolution at a cutoff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.domains import DECISION_STATES, MARKET_CATALOG
from knownby.functions.scalars import ratio, state_rank


def combine_states(decisions: DataFrame, group: Sequence[str], state: str = "state") -> DataFrame:
    """The state with the highest precedence per group. Groups without a state do not
    appear; a state outside the domain makes the group's result null (see its rule)."""
    rank = state_rank(F.col(state))
    top = decisions.groupBy(*group).agg(
        F.max(rank).alias("_top"), F.count(F.when(rank.isNull(), 1)).alias("_unknown")
    )
    name = F.get(F.array(*[F.lit(s) for s in DECISION_STATES]), F.col("_top"))
    return top.select(*group, F.when(F.col("_unknown") == 0, name).alias(state))


def combine_declared(
    declared: DataFrame, decisions: DataFrame, group: Sequence[str], state: str = "state"
) -> DataFrame:
    """One row per declared group: its combined state, or the code NO_STATES if nothing was decided for it.

    Groups meet null-safely: a null in a group column is a value of its own. A group without any row
    shows up here, where ``combine_states`` cannot know of it.
    """
    keys = F.struct(*group)
    known = combine_states(decisions.filter(F.col(state).isNotNull()), group, state)
    known = known.select(keys.alias("_g"), F.col(state), F.lit(True).alias("_decided"))
    wanted = declared.select(*group).distinct().withColumn("_g", keys)
    joined = wanted.join(known, wanted["_g"].eqNullSafe(known["_g"]), "left")
    return joined.select(*group, state, F.when(F.col("_decided").isNull(), "NO_STATES").alias("code"))


def market_catalog(spark: SparkSession) -> DataFrame:
    """The frozen catalog: five rows."""
    return spark.createDataFrame(list(MARKET_CATALOG), "sport string, market_family string, phase string, mr_base string")


def state_at_cutoff(state: Column, technical: Column) -> Column:
    """Final state at the cutoff: a technical, integrity or licensing impossibility blocks;
    a WAIT or REVIEW that is still open ends as NO_BET."""
    return F.when(technical, "BLOCKED").when(state.isin("WAIT", "REVIEW"), "NO_BET").otherwise(state)


def state_rates(decisions: DataFrame, segment: Sequence[str], state: str = "state") -> DataFrame:
    """Share of every decision state per segment."""
    total = F.count(F.lit(1))
    return decisions.groupBy(*segment).agg(
        total.alias("decisions"),
        *[
            ratio(F.count(F.when(F.col(state) == s, 1)), total).alias(f"{s.lower()}_rate")
            for s in DECISION_STATES
        ],
    )
