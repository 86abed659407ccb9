"""Rows of a database query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Isolation levels by number, as jobs name them.
ISOLATION = {1: "READ UNCOMMITTED", 2: "READ COMMITTED", 3: "REPEATABLE READ", 4: "SERIALIZABLE"}

# Fixed value: rows per fetch when a job names none.
FETCH_SIZE = 100


def read_options(url: str, query: str, fetchsize: int = FETCH_SIZE, isolation: int = 0,
                 partition_column: str | None = None, lower: str | int | None = None,
                 upper: str | int | None = None, partitions: int | None = None, **options: str) -> dict:
    """Options of the JDBC source.  With a partition column the query is read in ranges of
    it by several tasks; the bounds only place the cuts, no row is left out."""
    out = {"url": url, "fetchsize": str(int(fetchsize)), **options}
    if isolation:
        out["sessionInitStatement"] = f"SET SESSION TRANSACTION ISOLATION LEVEL {ISOLATION[isolation]}"
    if partition_column is None:
        out["query"] = query
        return out
    if lower is None or upper is None or not partitions:
        raise ValueError("a partition column needs lower and upper bounds and a number of partitions")
    out.update(
        dbtable=f"({query}) q", partitionColumn=partition_column, lowerBound=str(lower),
        upperBound=str(upper), numPartitions=str(int(partitions)),
    )
    return out


def scan_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A query's rows.  Zero dates become NULL by the driver's own URL setting
    (``zeroDateTimeBehavior=convertToNull`` for MySQL)."""
    return spark.read.format("jdbc").options(**read_options(url, query, **options)).load()
