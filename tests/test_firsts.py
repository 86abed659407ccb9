"""First rows by aggregates: no sort, no table."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.operators import load
from feedkit.plans.load_job import LoadSpec, tag_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def unsorted(df):
    return "rangepartitioning" not in plan(df)


ROWS = "id long, file string, block long, line_no long, x double"


def some_rows(seed=1):
    r = random.Random(seed)
    lines = {(r.choice(["b", "a", "é", None]), r.choice([0, 7, 1 << 40]), r.randrange(40)) for _ in range(150)}
    return [(r.choice([None, *range(12)]), *line, r.choice([0.0, -0.0, 1.5, None])) for line in sorted(lines, key=str)]


def firsts(rows, order):
    """Rows with the flag, by looking at every row of a key."""
    low = {}
    for n, row in enumerate(rows):
        place = tuple((v is not None, v) for v in order(row)) + (n,)
        low[row[0]] = min(low.get(row[0], place), place)
    return [(*row, tuple((v is not None, v) for v in order(row)) + (n,) == low[row[0]]) for n, row in enumerate(rows)]


def test_first_lines(spark):
    rows = some_rows()
    df = spark.createDataFrame(rows, ROWS)
    marked = load.mark_first(df, ["id"], load.LINE_KEY)
    assert sorted(map(str, map(tuple, marked.collect()))) == sorted(map(str, firsts(rows, lambda r: r[1:4])))
    assert unsorted(marked) and "SortAggregate" not in plan(marked)
    assert load.mark_first(df.limit(0), ["id"], load.LINE_KEY).count() == 0


@pytest.mark.parametrize("odd", [("f", -1, 0), ("f", 1 << 43, 0), ("f", 0, -5), ("f", None, 0), ("f", 0, None), ("f", 0, 1 << 62)])
def test_lines_beyond_the_digits(spark, odd):
    rows = [(1, *odd, 0.0), (1, "f", 0, 3, 0.0), (2, "g", 0, 1, None), (2, "a", 5, 1, None)]
    got = load.mark_first(spark.createDataFrame(rows, ROWS), ["id"], load.LINE_KEY).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, firsts(rows, lambda r: r[1:4])))


def test_rows_that_the_order_does_not_tell_apart(spark):
    rows = some_rows(2) + some_rows(2)[:50] + [(3, "z", 0, 0, -0.0)] * 5000 + [(None, "z", 0, 0, None)] * 30
    df = spark.createDataFrame(rows, ROWS).repartition(8)
    marked = load.mark_first(df, ["id"], ["x"])
    assert unsorted(marked)
    got = [tuple(r) for r in marked.collect()]
    assert sorted(map(str, (g[:-1] for g in got))) == sorted(map(str, rows))
    least = {}
    for row in rows:
        least.setdefault(row[0], []).append((row[4] is not None, row[4] or 0.0))
    chosen = {g[0]: (g[4] is not None, g[4] or 0.0) for g in got if g[-1]}
    assert sum(g[-1] for g in got) == len(least) and chosen == {k: min(v) for k, v in least.items()}
    mapped = df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert load.mark_first(mapped, ["id"], ["x", "file"]).where("_first").count() == len(least)


def test_copies_with_several_order_columns(spark):
    df = spark.createDataFrame([("a", 1, "f", 2), ("a", 1, "e", 9), ("a", 1, None, 9), ("b", 2, "f", 1)], "k string, v int, file string, line_no int")
    found = load.duplicate_rows(df, ["file", "line_no"])
    assert sorted(map(tuple, found.collect()), key=str) == [("f", 1, "b", 2, 1), (None, 9, "a", 1, 3)]
    assert unsorted(found)


def test_loads_sort_no_lines(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    lines = spark.createDataFrame([("f", 0, k, f"{k % 7},{k % 3}") for k in range(100)], "file string, block long, line_no long, value string")
    tagged = tag_rows(lines, LoadSpec(schema, ["id"], ","))
    assert unsorted(tagged) and {r["kind"]: r["count"] for r in tagged.groupBy("kind").count().collect()} == {"good": 7, "uv": 14, "duplicate": 79}


@pytest.mark.parametrize("few", [load.FEW_FILES, 0])
def test_lines_of_one_file_stay_spread(spark, conf, monkeypatch, few):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(load, "FEW_FILES", few)
    places = [("f", 0, k) for k in range(400)] + [(None, 1, 3), ("", 2, 2), ("a", 0, 9), ("=", 0, 1)]
    lines = spark.createDataFrame(places, "file string, block long, line_no long").repartition(4)
    rows, n = load.in_place(lines)
    assert n == len(places) and rows.columns == [*lines.columns, "_id"]
    tasks = [r["count"] for r in rows.where("file = 'f'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 4 and max(tasks) < 300
    got = [tuple(r)[:3] for r in sorted(rows.collect(), key=lambda r: r["_id"])]
    assert got == sorted(places, key=lambda p: (p[0] is not None, p[0] or "", *p[1:]))


def test_groups_are_found_in_even_slices(spark, monkeypatch):
    monkeypatch.setattr(load, "SLICE_LINES", 10)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    lines = spark.createDataFrame([("f", 0, k, f"{k % 70},{k % 3}") for k in range(100)], "file string, block long, line_no long, value string")
    lines = lines.coalesce(1)
    rows, n = load.in_place(lines)
    tasks = [r["count"] for r in load.dealt(rows, n).groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 8 and max(tasks) < 30
    tagged = tag_rows(lines, LoadSpec(schema, ["id"], ","))
    assert "REPARTITION_BY_NUM" in plan(tagged)
    assert "REPARTITION_BY_NUM" in plan(load.mark_first(rows.drop("_id"), ["block"], load.LINE_KEY))
    assert {r["kind"]: r["count"] for r in tagged.groupBy("kind").count().collect()} == {"good": 70, "uv": 30}
    monkeypatch.setattr(load, "SLICES", 3)
    assert load.dealt(rows, n).rdd.getNumPartitions() == 3
