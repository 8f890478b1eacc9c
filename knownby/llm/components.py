"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.tables import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour or itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a < b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    own = least.select(F.col("least").alias("a"), "b")
    return edges.join(least, "b").select(F.col("least").alias("a"), F.col("a").alias("b")).union(own).where(
        "a < b"
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node it can reach.

    Alternating large and small stars; a logarithmic number of rounds, each written to
    shared storage. Loops and repeated edges do no harm; no edges give no rows.
    """
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    state = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state or not found[0]:
            break
        state = tuple(found)
        after = stored(_small_star(_large_star(now)))
        discard(now)
        now = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
