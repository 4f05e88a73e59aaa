"""Registry of named queries over the driver tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL (or ``None`` when the operator is not expressible in
SQL, e.g. iterative model fitting).  Column names are identical on both
sides; doubles are rounded on both sides because summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from tessera.plans import (analysis, briefs, customer360, evaluation, governed,  # noqa: F401
                               iterative, loads, modeling, questions, relational, retrieval, streams)
    return dict(REGISTRY)
