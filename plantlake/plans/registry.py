"""Registered queries: a name, a function of the plant tables, and the SQL it must agree with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantlake.plans.fixtures import Plant, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BODIES: dict[str, Callable[[Plant], DataFrame]] = {}


def query(name: str, sql: str | None = None, *tables: str):
    """Register a function of a `Plant`; `sql` may read the derived `tables` by name."""

    def register(fn: Callable[[Plant], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Plant(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        BODIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql, *tables)
        return fn

    return register
