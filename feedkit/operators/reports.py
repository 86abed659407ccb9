"""Table reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text


def skew_report(df: DataFrame, group: Sequence[str], size: str) -> DataFrame:
    """How unevenly each group's units are filled; worst first within the first column."""
    s = F.col(size)
    report = df.groupBy(*group).agg(
        F.try_divide(F.stddev_pop(s), F.avg(s)).alias("bias"),
        F.try_divide(F.min(s), F.max(s)).alias("min_max_ratio"),
        (F.sum(s) / 1024 / 1024).alias("size_mb"),
        F.max(s).alias("max_unit"),
    )
    return report.orderBy(F.asc(group[0]), F.desc("bias"))


def size_report(df: DataFrame, key: str, size: str) -> DataFrame:
    """Size per key, and one row for the total, told from that of a NULL key by ``is_total``."""
    sums = df.rollup(key).agg(F.sum(size).alias("size"), (F.grouping(key) == 1).alias("is_total"))
    return sums.orderBy("is_total", F.asc_nulls_last(key))


def usage_report(df: DataFrame, key: str, current: str, maximum: str, peak: str) -> DataFrame:
    """Space per key with its usage in percent, and how many keys there are."""
    sums = df.groupBy(key).agg(
        F.sum(current).alias("sum_current"), F.sum(maximum).alias("sum_max"), F.sum(peak).alias("sum_peak")
    )
    used = sums.withColumn("usage", text.percent_of(F.col("sum_current"), F.col("sum_max")))
    groups = sums.agg(F.count("*").alias("groups"))
    return used.withColumn("groups", groups.scalar())


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def ordered_list_agg(df: DataFrame, group: Sequence[str], position: str, value: str, separator: str = ",",
                     piece: int = 4096) -> DataFrame:
    """One list text per group, ordered by a whole-number position that is unique in its group.

    Pieces of ``piece`` positions are joined to text first, so a large group is sorted and
    joined by many tasks; only its finished pieces meet.
    """
    def joined(order: str, item: str, name: str):
        items = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(item).cast("string").alias("v"))))
        return F.array_join(F.transform(items, lambda x: x["v"]), separator).alias(name)

    pieces = (
        df.where(F.col(value).isNotNull()).withColumn("_piece", F.expr(f"`{position}` div {int(piece)}"))
        .groupBy(*group, "_piece").agg(joined(position, value, "_text"))
    )
    return pieces.groupBy(*group).agg(joined("_piece", "_text", "items"))


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: place, type, rows, NULLs, distinct values, smallest and largest as text.

    Distinct values are counted exactly, for which every cell is shuffled; ``read_sketches(column_sketches(df))`` estimates them
    in one pass.
    Every named column has a row, of an empty table too.  Maps have no order and so no smallest and largest.
    """
    names = list(columns or df.columns)
    fields = {f.name: f for f in df.schema.fields}
    aggregates = []
    for c in names:
        for name, pick in (("min", F.min), ("max", F.max)):
            bound = F.lit(None) if _holds_map(fields[c].dataType) else pick(c)
            aggregates.append(bound.cast("string").alias(f"{name}_{c}"))
    bounds = df.agg(*aggregates).select(F.explode(F.array(*[
        F.struct(
            F.lit(names.index(c) + 1).alias("ordinal"), F.lit(c).alias("column"),
            F.lit(fields[c].dataType.simpleString()).alias("type"),
            F.col(f"min_{c}").alias("low"), F.col(f"max_{c}").alias("high"),
        ) for c in names
    ])).alias("b")).select("b.*")
    values = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "column", "v")
    counts = (
        values.groupBy("column", "v").agg(F.count("*").alias("n"))
        .groupBy("column").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("v").alias("distinct_values"),
        )
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "nulls", "distinct_values")]
    return bounds.join(counts, "column", "left").select("ordinal", "column", "type", *zero, "low", "high")


# Buckets of a distinct-value sketch (2 ** LG_K) with its relative error, and the size of a quantile sketch with its error in rank.
# Both errors are what the sketches' authors state: one standard deviation, and a bound that holds for 99 of 100 quantiles.
LG_K, DISTINCT_ERROR = 12, 1.04 / 64
QUANTILE_K, RANK_ERROR = 200, 0.0133
QUANTILES = (0.25, 0.5, 0.75)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.FloatType, T.DoubleType, T.DecimalType)


def _number(c: str, kind: T.DataType) -> Column:
    """A column as the double whose quantiles are kept: days for dates, seconds for timestamps, NULL for what is no number."""
    if isinstance(kind, (*_WHOLE, *_BROKEN)):
        return F.col(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # a moment without a zone is counted as if it were one of UTC
        moment = F.to_utc_timestamp(c, F.current_timezone()) if isinstance(kind, T.TimestampNTZType) else F.col(c)
        return F.unix_micros(moment.cast("timestamp")) / 1_000_000
    return F.lit(None).cast("double")


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: place, type, rows, NULLs, smallest and largest as text, and two sketches that merge with those of other parts.

    ``distinct_sketch`` tells how many distinct values there are, with a relative error of ``DISTINCT_ERROR``; ``quantile_sketch``
    (numbers, dates, moments) gives quantiles whose rank is off by ``RANK_ERROR`` at most in 99 of 100 cases.  The table is read
    once, and a task hands on one row.  NaN has no rank; maps have neither bounds nor distinct values.
    """
    names = list(columns or df.columns)
    fields = {f.name: f for f in df.schema.fields}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        kind = fields[c].dataType
        # hashed, since the sketch itself takes few types and leaves out empty texts
        value = F.lit(None).cast("long") if _holds_map(kind) else F.when(F.col(c).isNotNull(), F.xxhash64(c))
        ordered = F.lit(None) if _holds_map(kind) else F.col(c)
        number = _number(c, kind)
        aggregates += [
            F.count(c).alias(f"count_{i}"), F.min(ordered).cast("string").alias(f"low_{i}"), F.max(ordered).cast("string").alias(f"high_{i}"),
            F.hll_sketch_agg(value, F.lit(LG_K)).alias(f"hll_{i}"),
            F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(QUANTILE_K)).alias(f"kll_{i}"),
        ]
    one = df.agg(*aggregates)
    rows = [F.struct(
        F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column"), F.lit(fields[c].dataType.simpleString()).alias("type"),
        F.col("rows"), (F.col("rows") - F.col(f"count_{i}")).alias("nulls"), F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"),
        F.col(f"hll_{i}").alias("distinct_sketch"), F.col(f"kll_{i}").alias("quantile_sketch"),
    ) for i, c in enumerate(names)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def merge_sketches(parts: DataFrame, schema: T.StructType) -> DataFrame:
    """The sketches of a whole table from those of its parts (``column_sketches``, one after another); ``schema`` is the table's.

    Statistics of a new batch thus join those of the table without reading the table.
    """
    def bound(pick, side):
        # texts are compared as what they stand for
        typed = [F.when(F.col("column") == f.name, pick(F.when(F.col("column") == f.name, F.col(side)).try_cast(f.dataType)).cast("string"))
                 for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
        return F.coalesce(*typed, pick(side)).alias(side) if typed else pick(side).alias(side)

    return parts.groupBy("ordinal", "column", "type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), bound(F.min, "low"), bound(F.max, "high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def read_sketches(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``column_stats`` with estimates: ``distinct_values`` and ``quantiles``, NULL where a column has no numbers."""
    n = F.kll_sketch_get_n_double("quantile_sketch")
    found = F.when(n > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*[F.lit(float(q)) for q in quantiles])))
    distinct = F.hll_sketch_estimate("distinct_sketch").alias("distinct_values")
    return sketches.select("ordinal", "column", "type", "rows", "nulls", distinct, "low", "high", found.alias("quantiles"))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def analyze_columns(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Collect statistics of a catalog table for the optimizer.  Runs at once."""
    quoted = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {quoted}")


def run_report(tagged: DataFrame, feed: str = "feed", kind: str = "kind") -> DataFrame:
    """One row per feed and one for the whole run (``is_total``): good rows, error rows,
    failed feeds and a status.  A failed feed fails the run but not the other feeds."""
    per_feed = tagged.groupBy(feed).agg(
        F.count_if(F.col(kind) == "good").alias("good"), F.count_if(F.col(kind) == "error").alias("error")
    )
    return per_feed.rollup(feed).agg(
        F.sum("good").alias("good"), F.sum("error").alias("error"),
        F.count_if(F.col("error") > 0).alias("failed"), (F.grouping(feed) == 1).alias("is_total"),
    ).withColumn("status", F.when(F.col("failed") > 0, "failed").otherwise("ok"))
