"""Text files as numbered lines, without ever holding a file in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The reader already ends lines at \n, \r and \r\n; these end a line as well.
_MORE_LINE_ENDS = "[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number from 1, text). Files are split like any text input.

    Rows of one input split keep their order in increasing ids, splits are ordered by their
    byte offset: a line's number is the lines of earlier splits plus its place in its own.
    """
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    pieces = read.select(
        "file", "split", "row", F.posexplode(F.split("value", _MORE_LINE_ENDS, -1)).alias("piece", "text")
    )
    sizes = pieces.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", "split", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    in_split = Window.partitionBy("file", "split").orderBy("row", "piece")
    return (
        pieces.withColumn("place", F.row_number().over(in_split))
        .join(offsets, ["file", "split"])
        .select("file", (F.col("offset") + F.col("place")).alias("line_number"), "text")
    )
