"""Registry of the queries, each with its SQL oracle where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyweave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        self.__dict__[name] = df  # footers are read once per query
        return df

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``."""

    def wrap(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return wrap
