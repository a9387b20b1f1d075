"""Registry of queries: a Spark plan and, where SQL can say it, an equivalent statement."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paperloom.memory import bounded_batches
from paperloom.session import ship_package

_PLANS: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self._directory = spark, directory.rstrip("/")
        ship_package(spark)
        bounded_batches(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._directory}/{name}.parquet")


def query(sql: str | None = None):
    """Register `plan(tables)` under its function name."""
    def register(plan):
        @wraps(plan)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(Tables(spark, sf_dir))

        name = plan.__name__
        _PLANS[name] = run
        if sql is not None:
            _SQL[name] = sql
        return plan

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_PLANS)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
