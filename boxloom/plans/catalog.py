"""Registry of the runnable queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boxloom.plans.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of ``Inputs`` under a name, with its SQL equivalent if there is one."""

    def add(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
