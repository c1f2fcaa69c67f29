"""Registry of named queries: each is a Spark plan over the driver's tables plus, where SQL can
express it, the equivalent DuckDB SQL used as an oracle."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # Python workers import the package's functions
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return deco


def load_all() -> None:
    from . import (  # noqa: F401
        file_queries,
        governed_queries,
        item_queries,
        memory_queries,
        search_queries,
    )
