"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, table reader) under a name, with its SQL."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run

    return register


def dealt(rows: DataFrame) -> DataFrame:
    """rows in four parts for each core: a small file of rows with much to do for each would be one task."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)
