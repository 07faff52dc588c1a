"""All registered queries and their SQL twins.

A query module registers each of its queries with :func:`query`; the inputs it names are given to it as DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoledger.plans.views import duck, view

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, *inputs: str, sql: str | None = None) -> Callable:
    """Register a function of DataFrames, one for each of ``inputs``, as a query; ``sql`` is its twin for DuckDB."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[view(spark, sf_dir, i) for i in inputs])

        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = run
        if sql:
            _SQL[name] = duck(sql)
        return f

    return register


def _load() -> None:
    from geoledger.plans import annotations, boxes, files, functions, hooks, layers, raster, runs, sampling, scoring, series  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
