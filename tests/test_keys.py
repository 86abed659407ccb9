"""Key joins: meaning, NULLs, and hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from feedkit.operators import keys, load


def ids(df, column="v"):
    return sorted(r[column] for r in df.collect())


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(1, None, 10), (1, 2, 11), (None, None, 12), (3, 4, 13)], "a int, b int, v int")
    staged = spark.createDataFrame([(1, None), (1, 2), (1, 2), (None, None)], "a int, b int")
    assert ids(keys.delete_by_keys(target, staged, ["a", "b"])) == [10, 12, 13]
    assert ids(keys.rows_to_replace(target, staged, ["a", "b"])) == [11]
    assert ids(keys.semi(target, staged, ["a", "b"], nulls=True)) == [10, 11, 12]


def reconcile_model(left, right):
    out = []
    for i, item in enumerate(left):
        if i < len(right) and right[i] == item:
            out.append((i, item, "same"))
        else:
            out.append((i, item, "moved" if item in right else "only_left"))
    return sorted(out + [(i, item, "only_right") for i, item in enumerate(right) if item not in left])


@pytest.mark.parametrize("left,right", [
    (["a", "b", "c"], ["a", "c", "b", "d"]), (["a", "a", "b"], ["b", "a", "a", "a"]), ([], ["x"]), (["x"], []),
    (["a", "b"], ["a", "b"]), (["a", "b"], ["a", "b", "c"]), (["a", "b", "a"], ["a", "z", "z"]),
])
def test_reconcile(spark, left, right):
    frames = [spark.createDataFrame(list(enumerate(side)), "place int, item string") for side in (left, right)]
    result = keys.reconcile(*frames, ["item"], "place")
    assert sorted(tuple(r) for r in result.collect()) == reconcile_model(left, right)
    tests = keys.list_tests(result, *frames).first()
    assert tests["equal"] == (left == right)
    assert tests["prefix"] == (left == right[:len(left)])


def test_schema_pairing_of_uneven_lists_raises(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ordinal int, name string")
    b = spark.createDataFrame([(1, "int")], "ordinal int, type string")
    assert keys.schema_pairing(a.limit(1), b).collect()[0].asDict() == {"ordinal": 1, "name": "x", "target_type": "int"}
    with pytest.raises(Exception, match="different numbers of columns"):
        keys.schema_pairing(a, b).collect()


def test_missing_feeds_by_pattern(spark):
    patterns = ["MY_*.xlsx", "ID_?.csv", "*", "US_[ab].txt", "a.b*", "GB_[!x].txt", "\\d+.txt", "no*,MY_*", "no,never"]
    expected = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    present = spark.createDataFrame(
        [("MY_1.xls",), ("ID_12.csv",), ("US_c.txt",), ("axb1",), ("GB_y.txt",), ("12.txt",)], "name string"
    )
    got = sorted(r[0] for r in keys.missing_feeds_by_pattern(expected, present).collect())
    assert got == sorted(["MY_*.xlsx", "ID_?.csv", "US_[ab].txt", "a.b*", "\\d+.txt", "no,never"])


@pytest.fixture
def no_broadcast(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )


def hot(spark, rows, other):
    """A third of all rows share key 0."""
    k = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % other + 1)
    return spark.range(0, rows, 1, 8).select(k.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join,count", [(keys.delete_by_keys, 66666 - 333), (keys.rows_to_replace, 33334 + 333)])
def test_hot_key_is_split_at_run_time(spark, no_broadcast, join, count):
    target, staged = hot(spark, 100000, 10**9), hot(spark, 1000, 10**9)
    out = join(target, staged, ["k"])
    rows = out.collect()
    k = {r["k"] for r in staged.select("k").distinct().collect()}
    keep = join is keys.rows_to_replace
    assert len(rows) == target.where(F.col("k").isin(list(k)) if keep else ~F.col("k").isin(list(k))).count()
    assert re.search(r"isSkew(Join)?=true|skewed", final_plan(out))


def test_matching_side_keeps_few_rows_of_a_hot_key(spark, no_broadcast):
    kept = keys.present_keys(hot(spark, 100000, 7), ["k"]).groupBy("k").count().collect()
    assert max(r["count"] for r in kept) <= keys.SPREAD


def test_first_of_a_hot_key(spark, no_broadcast):
    rows = hot(spark, 60000, 1000)
    kept, uv = load.unique_violations(rows, ["k"], ["id"])
    assert kept.count() == 1001
    assert uv.count() == 60000 - 1001
    assert kept.where("k = 0").first()["id"] == 0
    # Rows meet their key's first by their own order, so no join partition holds a hot key.
    assert "hashpartitioning(k" not in re.sub(r"(?s)SortAggregate.*|HashAggregate.*", "", final_plan(kept))
