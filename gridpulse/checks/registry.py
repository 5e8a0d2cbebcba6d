"""Registration of queries and of the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from gridpulse.checks.views import with_views
from gridpulse.sources.adapters import Plant

_MODULES = ("scalars", "rollups", "merges", "alarms", "reports", "jobs")
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a `Plant` under `name`; `sql` may use the model views."""

    def register(build: Callable[[Plant], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Plant(spark, sf_dir))

        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = with_views(sql)
        return build

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(f"gridpulse.checks.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
