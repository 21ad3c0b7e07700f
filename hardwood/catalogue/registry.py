"""Registration of queries and reading of their input tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(tables)``; ``ids`` are the operators the query exercises."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        REGISTRY[name] = Query(name, run, sql, tuple(ids.split()))
        return fn

    return add


class Tables:
    """``tables.events`` reads ``events.parquet`` of a data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.folder = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
