"""Plans that must keep their shape."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text
from feedkit.operators import feed, keys, load, order, repair
from feedkit.plans.once import compute_once
from feedkit.sources import lines as src


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    return spark.createDataFrame([("f", 0, "1\ta"), ("f", 1, "2\tb")], "file string, line_no long, value string")


def test_repair_shuffles_the_text_once(spark, tmp_path):
    (tmp_path / "f.txt").write_text("1\ta\n\tb\n2\ta\n\tb\n")
    scanned = src.scan_lines(spark, str(tmp_path))
    repaired = repair.repair_linefeeds(scanned, "\t", 3, chunk_lines=1, in_order=True)
    assert sorted(r["value"] for r in repaired.collect()) == ["1\ta\tb", "2\ta\tb"]
    final = plan(repaired).split("Initial Plan")[0]
    by = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"\+- Exchange hashpartitioning\((.*?), \d+\)", final)]
    # Lines by chunk, once for both outputs; parts by record.
    assert by.count("file, block, chunk") == 1 and by.count("file, record_block, record_line") == 1
    # All others hold notes or states: by stretch of a block, by stretch of a file, by file; the upward ones serve the way down.
    assert sorted(set(by) - {"file, block, chunk", "file, record_block, record_line"}) == ["file", "file, block, part", "file, part"]
    assert len(by) == 7 and final.count("ReusedExchange") == 3


def test_fields_are_split_once_under_a_filter(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    staged, et = load.stage_typed(lines(spark), "\t", schema)
    for df in (staged, et):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(value") == 1


def test_compute_once_keeps_null(spark):
    df = compute_once(spark.range(1), "x", F.lit(None).cast("string"))
    assert df.first()["x"] is None


def test_only_dirty_values_leave_the_jvm(spark):
    assert "contains" in plan(feed.remove_mbc(lines(spark), "value", {"a": 2})).split("ArrowEvalPython")[1]


def test_top_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(order.top_n(spark.range(100), [("id", "desc")], 5))


def test_no_nested_loops(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    a = spark.range(10).select("id", (F.col("id") % 3).alias("k"))
    frames = [
        keys.reconcile(a, a, ["k"], "id"), keys.delete_by_keys(a, a, ["k"]), keys.join_small(a, a, ["id"], "k"),
        load.mark_first(a, ["k"], ["id"]), src.number_lines(lines(spark).withColumn("block", F.lit(0))),
        keys.missing_feeds_by_pattern(
            a.select(F.col("k").cast("string").alias("pattern")), a.select(F.col("id").cast("string").alias("name"))
        ),
    ]
    for df in frames:
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_whole_characters_need_no_bytewise_pass(spark):
    df = lines(spark).select(text.replace_literals(F.col("value"), [("a", "b"), ("é", "e")]))
    assert "decode" not in plan(df)
