"""The catalogue of registered queries: a Spark job and, where SQL can express it, its check."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


_SCANS: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """The given Parquet tables of one scale, by attribute; each is opened once per application."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _SCANS:
            _SCANS[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return _SCANS[key]


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(tables)`` under ``name`` with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


@cache
def load_all() -> None:
    from devigil.plans import (  # noqa: F401
        check_ingest,
        check_marts,
        check_models,
        check_names,
        check_pages,
        check_series,
        check_text,
    )
