"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and share 1.5 times all
words; a target stops at twice its source's words and the excess is shared anew by weight, which is
water-filling: target = min(2 size, level * weight) with one level for all.

Quotas: the mix is cut into blocks of equally many words. Sources get whole blocks by the
highest quotients target / (2 n + 1); a source's documents are dealt to shards by a seeded hash, and
its blocks go to its shards by the highest quotients words / (2 n + 1). No seat is given one by one:
rounding with the average divisor is the apportionment of nearly as many seats, and the few missing or
surplus ones follow from the quotients next to it, in one window over shards, never over documents.

Selection: a shard lays its documents out in a seeded order and takes as many blocks as its
quota says, from a seeded block on and round again; a document's words are taken as often as the blocks
run over them, so never more than twice. Everything depends on doc_id, size and seed, so reruns agree.

Defined cases: a null text has no words; documents and sources without words take nothing; a null source is
a source; repeated rows are laid out one after another, in one shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knownby.llm.tables import stored, text_or_empty

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
SHARD_WORDS = 1_000_000
#: A block has so many words, or fewer where the smallest source asks for finer ones.
BLOCK_WORDS, BLOCKS_PER_SOURCE = 256, 1000
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def apportion(rows: DataFrame, group: list[str], weight: str, seats: str, name: str, tie: list[str]) -> DataFrame:
    """Adds ``name``: whole seats by Sainte-Lague among the rows of a group.

    ``weight``: not negative; ``seats``: of the whole group, equal in all its rows. Ties go by ``tie``.
    """
    whole = Window.partitionBy(*group)
    divisor = F.sum(weight).over(whole) / F.col(seats)
    start = F.when((F.col(seats) > 0) & (F.col(weight) > 0), F.floor(F.col(weight) / divisor + 0.5)).otherwise(0)
    begun = rows.withColumn("_start", start.cast("bigint")).withColumn(
        "_missing", F.col(seats) - F.sum("_start").over(whole)
    )
    # Of n rows with weights, the divisor for seats + n / 2 gives out enough and that for seats - n / 2 not too many, so no row
    # is further from its seats than its part of n / 2 (and a seat or two by rounding): in all a few steps per row.
    n, total = F.sum((F.col(weight) > 0).cast("int")).over(whole), F.greatest(F.sum(weight).over(whole), F.lit(1e-300))
    begun = begun.withColumn("_reach", F.least(F.abs("_missing"), F.ceil(F.col(weight) * n / (2 * total)) + 2))
    step = F.explode(F.sequence(F.lit(0), F.col("_reach") - 1))
    steps = begun.where("_missing != 0").select(*group, *tie, "_start", "_missing", F.col(weight).alias("_weight"), step.alias("_step"))
    more = F.col("_missing") > 0
    seat = F.when(more, F.col("_start") + F.col("_step")).otherwise(F.col("_start") - 1 - F.col("_step"))
    steps = steps.withColumn("_quotient", F.col("_weight") / (2 * seat + 1)).where((seat >= 0) & (F.col("_weight") > 0))
    # Missing seats go to the highest quotients, surplus ones come back from the lowest.
    best = Window.partitionBy(*group).orderBy(F.when(more, -F.col("_quotient")).otherwise(F.col("_quotient")), *tie, "_step")
    moved = (
        steps.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.abs("_missing"))
        .groupBy(*group, *tie).agg(F.sum(F.signum("_missing")).cast("bigint").alias("_moved"))
    )
    return begun.join(moved, [*group, *tie], "left").withColumn(
        name, F.col("_start") + F.coalesce("_moved", F.lit(0))
    ).drop("_start", "_missing", "_reach", "_moved")


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds weight and target to (key, source_size): one row per source, however many documents."""
    alone = Window.partitionBy()
    by_key = Window.orderBy("key")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_key) - 1) % len(WEIGHTS) + 1)
    full = sources.withColumn("weight", weight).withColumn("most", (MOST_TIMES * F.col("source_size")).cast("double"))
    # In this order sources fill up first; the level is that of the first one which does not.
    order = Window.orderBy(F.col("most") / F.col("weight"), "key")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    spare = SHARE * F.sum("source_size").over(alone) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    full = full.withColumn("_level", spare / F.sum("weight").over(later))
    fits = F.col("most") / F.col("weight") >= F.col("_level")
    level = F.min(F.when(fits, F.struct((F.col("most") / F.col("weight")).alias("at"), F.col("key").alias("k"), "_level"))).over(alone)
    return full.withColumn("target", F.least("most", level["_level"] * F.col("weight"))).drop("_level", "most")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of ``docs`` (doc_id, source, text)."""
    sized = stored(docs.select(
        "doc_id", "source", word_count(text_or_empty()).alias("size"),
        # One order for all: by code point, null last.
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("key"),
    ))
    alone = Window.partitionBy()
    sources = source_targets(sized.groupBy("key").agg(F.sum("size").alias("source_size")))
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(alone)
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(smallest / BLOCKS_PER_SOURCE)))
    sources = sources.withColumn("block", F.coalesce(block, F.lit(1)).cast("bigint")).withColumn(
        "_seats", F.round(F.sum("target").over(alone) / F.col("block")).cast("bigint")
    ).withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)))
    sources = stored(apportion(sources.withColumn("_all", F.lit(0)), ["_all"], "target", "_seats", "quota", ["key"]))
    dealt = sized.join(sources.select("key", "shards"), "key").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.col("shards"))
    ).drop("shards")
    shards = dealt.groupBy("key", "shard").agg(F.sum("size").alias("words")).join(
        sources.select("key", "source_size", "target", "block", "quota"), "key"
    )
    shards = apportion(shards, ["key"], "words", "quota", "blocks", ["shard"])
    most = F.floor(MOST_TIMES * F.col("words") / F.col("block"))
    start = F.pmod(F.xxhash64("key", "shard", F.lit(SEED)), F.greatest(F.lit(1), F.ceil(F.col("words") / F.col("block"))))
    shards = shards.withColumn("take", F.least("blocks", most) * F.col("block")).withColumn("start", start * F.col("block"))
    order = Window.partitionBy("key", "shard").orderBy(F.xxhash64("doc_id", F.lit(SEED + 1)), "doc_id", "size")
    laid = dealt.join(shards, ["key", "shard"]).withColumn(
        "end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    words, rest, low = F.greatest(F.lit(1), "words"), F.expr("take % greatest(1, words)"), F.col("end") - F.col("size")

    def overlap(shift: Column) -> Column:
        begin = F.col("start") + shift
        return F.greatest(F.lit(0), F.least(F.col("end"), begin + rest) - F.greatest(low, begin))

    rounds = F.floor(F.col("take") / words) * F.col("size")
    taken = rounds + overlap(F.lit(0)) + overlap(-F.col("words"))
    return laid.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: 0, 1 or 2 times, to the nearest whole text.

    Rows that share a doc_id, or have none, come equally often.
    """
    copies = mix(docs).where("taken > 0").groupBy(F.col("doc_id").alias("_id")).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_copies")
    )
    return docs.join(copies.where("_copies > 0"), F.col("doc_id").eqNullSafe(F.col("_id"))).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).drop("_id", "_copy", "_copies")
