"""Registry of queries and their SQL, and the table reader they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import configure
from shelfmark.sources.readers import read_table


class Tables:
    """The Parquet tables of one directory as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._read = configure(spark), folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._read[name]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the tables under a name, with the SQL that gives the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
