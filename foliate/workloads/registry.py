"""The query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliate.session import spread
from foliate.sources import store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that defines its result."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows take much work each: the given ones come as one row group, so they are dealt out."""
    return spread(table(spark, sf_dir, name), int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt_table(spark: SparkSession, sf_dir: str, name: str, key: str, buckets: int) -> DataFrame:
    """A table dealt out by the buckets that its rows will be kept in, while they are narrow."""
    return store.deal(table(spark, sf_dir, name), [key], buckets)
