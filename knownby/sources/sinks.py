"""Report writers: detail tables as Parquet or JSON lines, one summary table beside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_report(tables: Mapping[str, DataFrame], folder: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Every table in its own sub-folder; nothing is gathered on the driver."""
    if fmt not in ("json", "parquet"):
        raise ValueError("report format is json or parquet")
    for name, table in tables.items():
        writer = table.write.mode(mode)
        if fmt == "json":
            writer = writer.option("ignoreNullFields", "false")
        writer.format(fmt).save(f"{folder}/{name}")


def write_ordered(table: DataFrame, order: Sequence[str], path: str, fmt: str = "json", rows_per_file: int = 1_000_000, mode: str = "errorifexists") -> None:
    """The table in canonical order: part files in order of their names, rows in order inside each.

    Rows are dealt to ranges of ``order`` (bounds from Spark's sample), so no task sorts the whole; the file names
    carry the number of their range. ``order`` must be total for the order to be one; nulls come first.
    """
    parts = max(1, -(-table.count() // rows_per_file))
    ranged = table.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    writer = ranged.write.mode(mode)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)


def read_ordered(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Rows of ``write_ordered`` with their place from 1 in the order of files and lines (``ordinal``)."""
    read = spark.read.schema(schema).format(fmt).load(path)
    names = F.col("_metadata.file_name")
    rows = read.select(names.alias("_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_row"), "*")
    sizes = rows.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n"))
    # One row per input split of the table.
    ahead = Window.partitionBy(F.lit(0)).orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", "_split", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_file", "_split").orderBy("_row")
    return rows.withColumn("_place", F.row_number().over(inside)).join(offsets, ["_file", "_split"]).select(
        (F.col("_before") + F.col("_place")).alias("ordinal"), *read.columns
    )
