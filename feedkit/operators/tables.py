"""Catalog tables and parameterized SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def clone_table(spark: SparkSession, source: str, target: str, with_data: bool = False) -> None:
    """Create a table from another, with or without its rows.  Runs at once."""
    if with_data:
        spark.table(source).write.saveAsTable(target)
    else:
        spark.sql(f"CREATE TABLE {target} LIKE {source}")


def run_sql(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """A SQL text with named parameters (``:name``, ``IDENTIFIER(:name)``), bound, not pasted in."""
    return spark.sql(sql, args=args or {})
