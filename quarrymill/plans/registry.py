"""The table of queries and of their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a function (spark, sf_dir) with its SQL, or without where SQL cannot say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(text: str) -> str:
    """A Python string as a DuckDB expression."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
