"""Session settings and table loading shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Instants only: wall-clock columns become UTC instants once, at the boundary.
SESSION_TIME_ZONE = "UTC"
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": SESSION_TIME_ZONE,
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables that lie by a part of the join keys are joined where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Narrow rows compress well: by these a task reads 16 MB of shuffled bytes, not 64, at any size of the tables.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


def build_session(app_name: str = "knownby", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> None:
    """What the plans rely on, for a session that somebody else has built.

    Operators compare instants, so wall times must be read as UTC. Rule tables generate
    wide expressions; the JVM never compiles methods above 8000 bytes, and with the limit
    set Spark splits such code into smaller methods instead.
    """
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    reach_workers(spark)


def reach_workers(spark: SparkSession) -> None:
    """Python workers find this package wherever they are started."""
    root = str(Path(__file__).resolve().parents[1])
    places = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in places:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *places]))


def with_instants(df: DataFrame) -> DataFrame:
    """Cast every wall-clock (timestamp_ntz) column to a UTC instant."""
    wall = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if c in wall else F.col(c) for c in df.columns]
    )


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    raw = spark.read.parquet(os.path.join(directory, f"{name}.parquet"))
    return with_instants(raw)

