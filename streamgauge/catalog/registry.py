"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamgauge.catalog.adapters import oracle, table, view

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


class Input:
    """Tables of one scale, as attributes: generic ones by ``t``, domain ones by ``v``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def v(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(key: str, sql: str | None = None, *adapters: str):
    """Register ``f(input) -> DataFrame`` under ``key``, with its SQL twin if there is one."""

    def register(build: Callable[[Input], DataFrame]):
        if key in _queries:
            raise ValueError(f"registered twice: {key}")
        _queries[key] = lambda spark, sf_dir: build(Input(spark, sf_dir))
        if sql is not None:
            _oracles[key] = oracle(sql, *adapters)
        return build

    return register


def _load() -> None:
    from streamgauge.catalog import elementary, loading, products  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
