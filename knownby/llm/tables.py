"""Reading the given tables, and keeping intermediate tables on shared storage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knownby.session import pin_session

# One Arrow batch holds whole texts; these bounds hold for long ones too.
BATCH_ROWS, BATCH_BYTES = "2000", "16m"


def prepare(spark: SparkSession) -> None:
    """Session settings; and local Python workers find this package wherever they are started."""
    pin_session(spark)
    places = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *places]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; whatever else it has is never read."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; without one, a folder for local runs only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="knownby-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/knownby-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote and nothing will read again."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column), F.lit(""))
