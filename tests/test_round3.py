"""Patterns with inner literals, lists by range, exact files, contents stored once."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from feedkit.functions import match
from feedkit.operators import keys, lobstore, order
from feedkit.plans.storage import scratch_path
from feedkit.sinks import delimited
from feedkit.sources import lines as src


def test_patterns_by_their_literals(spark):
    r = random.Random(4)
    names = sorted({"".join(r.choice("ab_.[") for _ in range(r.randrange(0, 9))) for _ in range(150)})
    globs = sorted({"".join(r.choice(["a", "b", "_", "*", "?", "[ab]", "[!a]", "[", ".", "*"]) for _ in range(r.randrange(1, 7))) for _ in range(250)})
    rows = spark.createDataFrame([(g,) for g in globs], "pattern string")
    got = {x["pattern"] for x in keys.missing_feeds_by_pattern(rows, spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {g for g in globs if not any(fnmatch.fnmatchcase(n, g) for n in names)}


@pytest.mark.parametrize("glob,part", [("*abc*d", "abc"), ("?[x-z]?", ""), ("*a[bc]de?f", "de"), ("*a[", "a["), ("**", ""), ("*ab?cd*", "ab"), ("[!]]x", "x")])
def test_longest_literal_part(spark, glob, part):
    assert spark.range(1).select(match.glob_literal_part(F.lit(glob))).first()[0] == part


def test_names_are_offered_by_lengths_that_occur(spark, monkeypatch):
    seen = {}
    whole = keys.semi

    def look(df, other, on, nulls=False):
        seen["n"] = df.groupBy("_n").count().agg(F.max("count")).first()[0]
        return whole(df, other, on, nulls)

    monkeypatch.setattr(keys, "semi", look)
    name = spark.createDataFrame([("x" * 200 + "abc.csv",)], "name string")
    globs = spark.createDataFrame([("xx*",), ("*.csv",), ("xxx[1]*",), ("*abc*",)], "pattern string")
    assert [r[0] for r in keys.missing_feeds_by_pattern(globs, name).collect()] == ["xxx[1]*"]
    # two beginnings, one end, the distinct parts of three letters, one share
    assert seen["n"] == 2 + 1 + 8 + 1


def statuses(df):
    return sorted(map(tuple, df.select("p", "k", "status").collect()), key=str)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_lists_by_range(spark, width):
    r = random.Random(width)
    left = [(p, r.randrange(30)) for p in range(60)]
    right = [(p, k if r.random() < 0.8 else r.randrange(30)) for p, k in left if p % 13] + [(-5, 3), (70, None)]
    frames = [spark.createDataFrame(x, "p long, k long") for x in (left, right)]
    for a, b in (frames, (frames[0], frames[0]), (frames[0], frames[1].limit(0)), (frames[0].limit(0), frames[1])):
        assert statuses(keys.reconcile_ranges(a, b, ["k"], "p", width)) == statuses(keys.reconcile(a, b, ["k"], "p"))


@pytest.mark.parametrize("rows,lines,header", [(0, 3, True), (0, 3, False), (1, 3, False), (12, 4, False), (13, 4, True), (2000, 1, False)])
def test_files_of_exactly_so_many_lines(spark, conf, rows, lines, header):
    conf(spark__sql__shuffle__partitions="2")
    path = scratch_path(spark, "split")
    df = spark.range(0, rows, 1, 5).select("id")
    delimited.write_delimited(df, path, "tab", header=header, lines_per_file=lines)
    held = {}
    for r in src.scan_lines(spark, path).orderBy("line_no").collect():
        held.setdefault(r["file"], []).append(r["value"])
    files = [held[f] for f in sorted(held)]
    assert [v for f in files for v in f] == ["id"] * header + [str(k) for k in range(rows)]
    assert all(len(f) == lines for f in files[:-1]) and (not files or 0 < len(files[-1]) <= lines)


def test_contents_are_stored_once(spark):
    rows = [(1, "big", "a"), (2, "big", None), (3, "", "big"), (4, None, "c")]
    df = spark.createDataFrame(rows, "id int, body string, more string")
    kept, store = lobstore.store_contents(df, ["body", "more"])
    assert {(r["content"], r["refs"]) for r in store.collect()} == {("big", 3), ("", 1), ("a", 1), ("c", 1)}
    assert sorted(map(tuple, lobstore.load_contents(kept, store, ["body", "more"]).collect())) == rows
    both = lobstore.merge_stores(store, store)
    assert {(r["content"], r["refs"]) for r in both.collect()} == {("big", 6), ("", 2), ("a", 2), ("c", 2)}
    left = lobstore.release(store, kept.where("id IN (1, 4)"), ["body", "more"])
    assert {(r["content"], r["refs"]) for r in left.collect()} == {("big", 2), ("", 1)}
    with pytest.raises(Exception, match="no content for"):
        lobstore.load_contents(kept, left, ["body", "more"]).collect()
    changed = store.withColumn("content", F.concat("content", F.lit("x")))
    with pytest.raises(Exception, match="no content for"):
        lobstore.load_contents(kept, changed, ["body", "more"]).collect()


def test_many_first_rows_do_not_meet_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(order, "MANY", 10)
    df = spark.range(0, 1000, 1, 4).select(((F.col("id") * 37) % 1000).alias("k"))
    top = order.top_n(df, [("k", "desc")], 300)
    assert [r["k"] for r in top.collect()] == list(range(999, 699, -1))
    assert "TakeOrdered" not in top._jdf.queryExecution().executedPlan().toString()
    assert order.top_n(df, [("k", "desc")], 10).count() == 10 and order.top_n(df, [("k", "asc")], 5000).count() == 1000
