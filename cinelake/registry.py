"""Registered queries, one per SURVEY section 2 key, and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver tables
at ``sf_dir`` (through the test bed), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cinelake import oracle
from cinelake.plans import catalog

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def _models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return catalog.all_models(catalog.testbed_bronze(spark, sf_dir))


# ---- silver and gold models (C10-C15, D1-D7) ----------------------------------------
def _model_query(name: str) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _models(spark, sf_dir)[name]
    q.__name__ = name
    return q


for _name in catalog.MODEL_LAYERS:
    register(_name, oracle.model_sql(_name))(_model_query(_name))


def queries() -> dict[str, QueryFn]:
    from cinelake import queries_extra  # noqa: F401  (registers the remaining keys)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
