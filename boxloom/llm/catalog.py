"""Registry of the queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")
