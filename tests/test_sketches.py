"""Column statistics by mergeable sketches."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from feedkit.operators import reports


def test_merged_sketches_are_within_their_errors(spark):
    n = 60000
    df = spark.range(n).select(
        ((F.col("id") * 7919) % 50000).alias("k"), (F.col("id") % 97).cast("string").alias("s"),
        F.when(F.col("id") % 10 > 0, F.sqrt("id")).alias("x"), F.date_add(F.lit(dt.date(1970, 1, 1)), (F.col("id") % 1000).cast("int")).alias("d"))
    parts = [reports.column_sketches(df.where(F.col("k") % 5 == r)) for r in range(5)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionAll(part)
    got = {r["column"]: r for r in reports.read_sketches(reports.merge_sketches(merged, df.schema), [0.1, 0.5, 0.9]).collect()}
    exact = {r["column"]: r for r in reports.column_stats(df).collect()}
    for c in df.columns:
        assert [got[c][f] for f in ("ordinal", "type", "rows", "nulls", "low", "high")] == [exact[c][f] for f in ("ordinal", "type", "rows", "nulls", "low", "high")]
        assert abs(got[c]["distinct_values"] - exact[c]["distinct_values"]) <= 4 * reports.DISTINCT_ERROR * exact[c]["distinct_values"]
    assert got["s"]["quantiles"] is None
    for c, number in (("k", F.col("k")), ("x", F.col("x")), ("d", F.unix_date("d"))):
        for q, value in zip((0.1, 0.5, 0.9), got[c]["quantiles"]):
            low, high, rows = df.agg(F.count_if(number < value), F.count_if(number <= value), F.count(number)).first()
            assert low / rows - 2 * reports.RANK_ERROR <= q <= high / rows + 2 * reports.RANK_ERROR, (c, q)


def test_sketches_of_odd_columns(spark):
    rows = [(None, float("nan"), None, "10", Decimal("9.50"), {"a": 1}, [1]), (3, 2.0, None, "9", Decimal("10.00"), None, None), (-4, None, None, "", None, {"b": 2}, [])]
    df = spark.createDataFrame(rows, "i int, x double, n string, s string, d decimal(8,2), m map<string,int>, a array<int>")
    for parts in ([df], [df.limit(0), df], [df.where("i > 0"), df.where("i IS NULL OR i < 0")]):
        made = reports.column_sketches(parts[0])
        for part in parts[1:]:
            made = made.unionAll(reports.column_sketches(part))
        got = {r["column"]: (r["nulls"], r["distinct_values"], r["low"], r["high"], r["quantiles"]) for r in reports.read_sketches(reports.merge_sketches(made, df.schema), [0.5]).collect()}
        assert got == {"i": (1, 2, "-4", "3", [-4.0]), "x": (1, 2, "2.0", "NaN", [2.0]), "n": (3, 0, None, None, None), "s": (0, 3, "", "9", None),
                       "d": (1, 2, "9.50", "10.00", [9.5]), "m": (1, 0, None, None, None), "a": (1, 2, "[]", "[1]", None)}
    empty = reports.read_sketches(reports.column_sketches(df.limit(0))).collect()
    assert len(empty) == 7 and all(r["rows"] == 0 and r["distinct_values"] == 0 and r["quantiles"] is None for r in empty)


def test_sketches_read_the_table_once(spark):
    plan = reports.column_sketches(spark.range(10).withColumn("s", F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "SinglePartition" in plan and "hashpartitioning" not in plan
