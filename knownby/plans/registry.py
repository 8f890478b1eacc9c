"""Registry of queries; each is a DataFrame plan with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from knownby.session import load_table, pin_session


@dataclass(frozen=True)
class Tables:
    """The given tables of one folder, loaded on first use by name."""

    spark: SparkSession
    directory: str

    def __getattr__(self, name: str) -> DataFrame:
        return load_table(self.spark, self.directory, name)


Plan = Callable[[Tables], DataFrame]
PLANS: dict[str, Plan] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name!r} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            CHECKS[name] = sql
        return plan

    return register


def runner(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        pin_session(spark)
        return plan(Tables(spark, directory))

    return run
