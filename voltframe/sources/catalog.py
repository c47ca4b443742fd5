"""Read the landed raw tables: one ``file_year``-partitioned folder per table."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession

from voltframe import registry


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A raw table with its registry schema; ``file_year`` is the partition column,
    so year predicates prune folders before any file is opened."""
    schema = registry.schema(table)
    return spark.read.schema(schema).parquet(table_path(root, table))


def read_tables(spark: SparkSession, root: str, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    names = list(tables) if tables is not None else registry.table_names()
    return {t: read_table(spark, root, t) for t in names}
