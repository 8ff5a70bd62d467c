"""Registered queries: a Spark function over the tables of a folder, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftmart.session import configure
from weftmart.sources.files import table


class Tables:
    """The tables of a data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(configure(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimals as doubles, so that engines print them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})
