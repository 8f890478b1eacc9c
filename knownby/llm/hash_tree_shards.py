"""Sharding by a hierarchical weighted hash tree; DataFrame functions only.

The tree has regions, racks and shards. From the root down, every child of a node draws
-ln(u) / weight, where u in (0, 1) is a hash of the document's key and the child, and the smallest draw wins;
the weight of a region or rack is the sum of its shards'. A draw depends on nothing but key, child and
weight, so that a change of weights moves documents only within the subtrees whose weights change: a
node that gets heavier takes documents from its siblings, and siblings exchange none.

Law ``key``: doc_id and the number of shards decide. One more shard opens a region of its own, so no old
subtree changes its weight, and the documents that move all move into the new shard. (Were it put into
an old rack, that rack's whole region would draw documents into all its shards.) Equal texts under
different ids are therefore not kept together.

Slots number the rows of a shard without gaps. They come from counts per block of a shard: a window
never holds more than a block, and the block offsets are at most shards x ``BLOCKS`` rows.

Defined cases: a null text has no bytes; a row without doc_id is keyed by its text; repeated rows share a
shard and get different slots; a doc_id that owns very many rows fills one block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knownby.llm.tables import stored, text_or_empty

SHARDS_PER_RACK, RACKS_PER_REGION = 4, 3
ROW_BYTES = 8
BLOCKS = 1024


@dataclass(frozen=True)
class ShardTree:
    """``regions``: per region its racks, per rack the (number, weight) of its shards."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def founded(cls, shards: int) -> ShardTree:
        """Full racks and regions of equal shards, the last ones with what is left."""
        numbers = [(s, 1.0) for s in range(shards)]
        racks = [tuple(numbers[k : k + SHARDS_PER_RACK]) for k in range(0, shards, SHARDS_PER_RACK)]
        return cls(tuple(tuple(racks[k : k + RACKS_PER_REGION]) for k in range(0, len(racks), RACKS_PER_REGION)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def with_shard(self, weight: float = 1.0) -> ShardTree:
        """One more shard, in a region of its own."""
        return ShardTree((*self.regions, (((self.shards, weight),),)))

    def shard_of(self, key: Column) -> Column:
        """Descends region, rack and shard. ``key``: 64-bit hash of the document."""
        weight = {
            (g, k): math.fsum(w for _, w in rack) for g, region in enumerate(self.regions) for k, rack in enumerate(region)
        }
        region = _winner(key, [
            (f"region {g}", math.fsum(weight[g, k] for k in range(len(r))), g) for g, r in enumerate(self.regions)
        ])

        def below(g: int) -> Column:
            racks = self.regions[g]
            rack = _winner(key, [(f"rack {g}.{k}", weight[g, k], k) for k in range(len(racks))])
            shards = [_winner(key, [(f"shard {s}", w, s) for s, w in r]) for r in racks]
            return _choose(rack, shards)

        return _choose(region, [below(g) for g in range(len(self.regions))])


def _winner(key: Column, children: list[tuple[str, float, int]]) -> Column:
    """The number of the child with the smallest draw; ties go to the smaller number."""
    if len(children) == 1:
        return F.lit(children[0][2])

    def draw(name: str, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / float(1 << 53)
        return -F.log(u) / weight

    return F.array_min(F.array(*[
        F.struct(draw(name, weight).alias("draw"), F.lit(number).alias("number")) for name, weight, number in children
    ]))["number"]


def _choose(number: Column, options: list[Column]) -> Column:
    """options[number], with ``number`` computed once."""
    cases = lambda n: reduce(lambda c, k: c.when(n == k, options[k]), range(1, len(options)), F.when(n == 0, options[0]))
    return F.transform(F.array(number), cases)[0] if len(options) > 1 else options[0]


def with_slots(rows: DataFrame, key: str = "key", shard: str = "shard") -> DataFrame:
    """Adds ``slot``, numbering the rows of every shard from 0 in the order of their keys."""
    block = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(BLOCKS))
    rows = rows.withColumn("_block", block)
    counts = rows.groupBy(shard, "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    own = Window.partitionBy(shard, "_block").orderBy(key)
    return (
        rows.withColumn("_place", F.row_number().over(own)).join(F.broadcast(offsets), [shard, "_block"])
        .withColumn("slot", (F.col("_offset") + F.col("_place") - 1).cast("bigint"))
        .drop("_block", "_place", "_offset")
    )


def document_key() -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(text_or_empty(), F.lit("no id")))


def assign(docs: DataFrame, tree: ShardTree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs`` (doc_id, text)."""
    text = text_or_empty()
    sized = docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), document_key().alias("key"),
    )
    placed = stored(sized.withColumns({
        "shard": tree.shard_of(F.col("key")), "grown_shard": tree.with_shard().shard_of(F.col("key")),
    }))
    return with_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def shard_documents(docs: DataFrame, tree: ShardTree) -> DataFrame:
    """``docs`` with the shard of every row and its slot there; columns of these two names are replaced."""
    placed = docs.drop("slot").withColumn("_key", document_key())
    return with_slots(placed.withColumn("shard", tree.shard_of(F.col("_key"))), "_key").drop("_key")
