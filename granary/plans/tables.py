"""Query registry and the helpers that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.session import scratch_path
from granary.sources.reader import read_table
from granary.sources.writer import write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, and its SQL where there is one."""

    def keep(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", **options)


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def rewritten(spark: SparkSession, df: DataFrame, label: str, read: dict | None = None, **options) -> DataFrame:
    """Write a frame as a new table and scan it."""
    path = scratch_path(spark, label)
    write_table(df, path, **options)
    return read_table(spark, path, **(read or {}))
