"""Joining a per-key summary back onto its rows when some keys own most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is split once it owns more than 1/HOT_PARTS of all rows. At most HOT_PARTS keys
# can do so, whatever the data: that is the proven size of the broadcast side below.
HOT_PARTS = 2000
_BUCKETS = 1 << 16


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_parts: int = HOT_PARTS) -> DataFrame:
    """At most ``hot_parts`` keys, with the number of pieces each has to be cut into.

    Reads only the key columns; the counts are combined inside the map tasks.
    """
    return hot_of_sizes(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), keys, hot_parts)


def hot_of_sizes(sizes: DataFrame, keys: Sequence[str], hot_parts: int = HOT_PARTS) -> DataFrame:
    """``hot_keys`` where the rows per key (``_rows``) are known already."""
    share = F.col("_rows") * F.lit(hot_parts)
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    return sizes.filter(share > total).select(*keys, F.ceil(share / total).cast("int").alias("_pieces"))


def hot_values(rows: DataFrame, key: str, hot_parts: int = HOT_PARTS) -> tuple[list, bool]:
    """The keys of more than 1 / ``hot_parts`` of all rows, and whether any row has another key; counted at once.

    Rows are counted per bucket of hashes first (``_BUCKETS`` numbers); only keys in a bucket that is above the
    bound are counted one by one. Null keys do not count.
    """
    keyed = rows.select(key).filter(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS))
    sizes = {r["_b"]: r["count"] for r in keyed.groupBy(bucket.alias("_b")).count().collect()}
    total = sum(sizes.values())
    full = [b for b, n in sizes.items() if n * hot_parts > total]
    if not full:
        return [], True
    counted = keyed.filter(bucket.isin(full)).groupBy(key).count()
    hot = {r[key]: r["count"] for r in counted.filter(F.col("count") * hot_parts > total).collect()}
    return list(hot), sum(hot.values()) < total


def join_summary(
    rows: DataFrame,
    summary: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    hot_on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``summary`` (one row per key) onto ``rows`` without any key staying whole.

    The rows of a hot key scatter over its pieces by a hash of ``spread_by``; its summary
    row is repeated once per piece (at most 2 * HOT_PARTS repeats in total).
    """
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    few = F.broadcast(hot)
    salted_rows = rows.join(few, list(hot_on), "left").withColumn(
        "_salt",
        F.when(pieces > 1, F.pmod(F.xxhash64(*spread_by), pieces).cast("int")).otherwise(F.lit(0)),
    )
    salted_summary = summary.join(few, list(hot_on), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    return (
        salted_rows.drop("_pieces")
        .join(salted_summary.drop("_pieces"), [*keys, "_salt"], how)
        .drop("_salt")
    )


def mark_members(
    rows: DataFrame, members: DataFrame, keys: Sequence[str], spread_by: Sequence[str], flag: str
) -> DataFrame:
    """Add ``flag``: whether the row's key is among ``members`` (distinct keys).

    The semi- or anti-join of a table whose keys may be hot: filter on the flag.
    """
    marked = join_summary(
        rows, members.withColumn(flag, F.lit(True)), keys, hot_keys(rows, keys), keys, spread_by, how="left"
    )
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
