"""Order, rank, limit and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.plans.storage import materialize

Order = Sequence[tuple[str | int, str]]


def order_columns(df: DataFrame, spec: Order) -> list[Column]:
    """Sort columns of ``[(name or 1-based ordinal, "asc" or "desc"), ...]``."""
    out = []
    for column, direction in spec:
        name = df.columns[column - 1] if isinstance(column, int) else column
        out.append({"asc": F.asc, "desc": F.desc}[direction](name))
    return out


def order_multi(df: DataFrame, spec: Order) -> DataFrame:
    return df.orderBy(*order_columns(df, spec))


def with_rank(df: DataFrame, spec: Order, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Rows in order with their number from 1, over the whole table.

    Runs once: rows go into ordered ranges, which are checkpointed so that their numbering
    cannot change; only one count per range is gathered.  The order should be total.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = order_columns(df, spec)
    ranged = materialize(
        df.repartitionByRange(n, *by).sortWithinPartitions(*by)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    # One row per range, so its size is bounded by the number of partitions.
    return ranged.join(F.broadcast(shifts), "_range").select(
        *df.columns, (F.col("_before") + F.col("_at") + 1).alias(name)
    )


# Rows of a result that may meet in one task.
MANY = 1 << 17


def top_n(df: DataFrame, spec: Order, n: int) -> DataFrame:
    """First ``n`` rows of an order.

    Each task keeps only ``n`` rows, and these meet in one task.  More than ``MANY`` are ranked in ranges instead, which runs
    once and leaves them spread out; the order should then be total.
    """
    if n <= MANY:
        return df.orderBy(*order_columns(df, spec)).limit(n)
    return with_rank(df, spec, "_top").where(F.col("_top") <= n).drop("_top")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION`` by position: duplicates of either side go away too."""
    return a.union(b).distinct()


def append_rows(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Staged rows after the target's, columns paired by position."""
    return target.union(staged)
