"""Values that must stay whole, totals, charsets, publishing."""

import fnmatch

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import match, text
from feedkit.operators import bytecut, extract, feed, keys, load, publish, reports
from feedkit.plans.feed_job import FeedSpec, transform_chain
from feedkit.plans.load_job import LoadSpec, load_table
from feedkit.plans.storage import scratch_database, scratch_path
from feedkit.sources import lines as src
from feedkit.streaming import incremental


def feed_lines(spark, values, file="f.txt"):
    return spark.createDataFrame([(file, 0, i, v) for i, v in enumerate(values)], "file string, block long, line_no long, value string")


def staged(spark, field, values):
    _, et = load.stage_typed(feed_lines(spark, values), "|", T.StructType([field]))
    return {r["value"]: r["reason"] for r in et.collect()}


def test_long_numbers_load_and_lossy_ones_do_not(spark):
    good = ["-1.2345678901234567E-300", "1234567890123456.789"]
    assert staged(spark, T.StructField("x", T.DoubleType()), good) == {}
    kind = T.StructField("x", T.DecimalType(38, 10))
    assert staged(spark, kind, ["1234567890123456.7890123456", "1.50000000000000"]) == {}
    assert staged(spark, kind, ["0.12345678901"]) == {"0.12345678901": "x: not decimal(38,10)"}
    assert staged(spark, T.StructField("x", T.DateType()), ["1997-01-31", "1997", "1997-1", "1997-1-3"]).keys() == {"1997", "1997-1", "1997-1-3"}
    ntz = T.StructField("x", T.TimestampNTZType())
    assert staged(spark, ntz, ["1997-01-31 10:00:00", "1997-01-31T10:00:00.5", "1997-01-31 10:00:00+09:00", "10:00:00"]).keys() == {
        "1997-01-31 10:00:00+09:00", "10:00:00"}
    assert staged(spark, T.StructField("x", T.TimestampType()), ["1997-01-31 10:00:00+09:00"]) == {}


def test_binary_values_stay_whole(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),), (bytearray(range(40)),), (bytearray(16),), (None,), (bytearray(b""),)], "b binary")
    got = [r[0] for r in extract.clean_columns(df).collect()]
    assert got == ["616263", bytes(range(40)).hex(), "00000000-0000-0000-0000-000000000000", "", ""]


@pytest.mark.parametrize("charset, java", [("shift_jis", "SJIS"), ("utf-16-le", "UTF-16LE"), ("latin-1", "ISO-8859-1")])
def test_lines_of_a_charset(spark, conf, tmp_path, charset, java):
    conf(spark__sql__legacy__javaCharsets="true")
    word = "é" if charset == "latin-1" else "日本語"
    (tmp_path / "a.txt").write_bytes(f"1|{word}|x\n\n   \n2|b\n".encode(charset))
    lines = src.scan_lines(spark, str(tmp_path), java)
    assert [r["value"] for r in lines.orderBy("line_no").collect()] == [f"1|{word}|x", "", "   ", "2|b"]
    cut = feed.truncate_columns(lines.where("value like '1%'"), "|", {1: 2}).first()
    assert cut["value"] == f"1|{word[:2]}|x"


def test_surplus_fields(spark):
    lines = feed_lines(spark, ["a|b", "a|b|c|", "a"])
    rows = src.fields_of(lines, "|", ["x", "y"], surplus="more").collect()
    assert [tuple(r) for r in rows] == [("a", "b", None), ("a", "b", "c|"), ("a", None, None)]
    with pytest.raises(Exception, match="4 fields, not 2"):
        src.fields_of(lines, "|", ["x", "y"]).collect()


def test_cuts_are_those_of_a_repeated_search():
    def slow(raw, prefix, n):
        while (at := raw.find(prefix)) >= 0:
            raw = raw[:at] + raw[at + n:]
        return raw

    import random
    r = random.Random(1)
    for _ in range(20000):
        prefix = bytes(r.choice(b"ab") for _ in range(r.randint(1, 4)))
        raw, n = bytes(r.choice(b"ab") for _ in range(r.randint(0, 30))), r.randint(1, 6)
        assert bytecut.cut_all(raw, [(prefix, n)]) == slow(raw, prefix, n)
    assert bytecut.cut_all(b"xxxxxxxxAB" * 100_000, [(b"AB", 2)]) == b"xxxxxxxx" * 100_000


def test_totals_are_told_from_null_groups(spark):
    df = spark.createDataFrame([(None, 1, "good"), ("a", 2, "error")], "k string, n int, kind string")
    assert sorted((str(r["k"]), r["size"], r["is_total"]) for r in reports.size_report(df, "k", "n").collect()) == [
        ("None", 1, False), ("None", 3, True), ("a", 2, False)]
    assert sorted((str(r["k"]), r["is_total"], r["status"]) for r in reports.run_report(df, "k").collect()) == [
        ("None", False, "ok"), ("None", True, "failed"), ("a", False, "failed")]


def test_column_stats_of_every_column(spark):
    schema = "a array<int>, m map<string,int>, s string"
    got = {r["column"]: tuple(r)[3:] for r in reports.column_stats(spark.createDataFrame([([2], {"x": 1}, None), ([1], None, "z")], schema)).collect()}
    assert got == {"a": (2, 0, 2, "[1]", "[2]"), "m": (2, 1, 1, None, None), "s": (2, 1, 1, "z", "z")}
    empty = reports.column_stats(spark.createDataFrame([], schema)).collect()
    assert [tuple(r)[3:] for r in empty] == [(0, 0, 0, None, None)] * 3


def test_a_huge_share_is_no_error(spark):
    df = spark.createDataFrame([(200.0, 1.0), (1e300, 1e-3), (0.0, 0.0)], "a double, b double")
    assert [str(r[0]) for r in df.select(text.percent_of(F.col("a"), F.col("b"))).collect()] == ["20000.0", "None", "0.0"]


@pytest.mark.parametrize("pattern", ["a*", "*b", "[ab]c", "[!a]c", "a[", "[a", "[]x]c", "[!]]c", "[a&&b]", "[^a]c", "a.c", "[[]c", "a\\d", "", "?[0-9]*"])
def test_globs(spark, pattern):
    names = ["a", "ab", "ac", "bc", "cc", "a[", "[a", "]c", "[c", "&", "^c", "a.c", "axc", "a\\d", "", "x", "x12", "b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"] for r in df.where(F.rlike("n", match.glob_regex(F.lit(pattern)))).collect()}
    assert got == {n for n in names if fnmatch.fnmatchcase(n, pattern)}
    rows = keys.missing_feeds_by_pattern(df.limit(1).select(F.lit(pattern).alias("pattern")), df, name="n").collect()
    assert bool(rows) == (not got)


def test_references_of_keys_with_separators(spark):
    df = spark.createDataFrame([("a_b", "c", "one", "x"), ("a", "b_c", "two", None), (None, "\\N", "three", "z"), ("\\N", None, "four", "w")],
                               "k string, l string, body string, more string")
    rows, lobs = feed.externalize_by_key(df, ["k", "l"], ["body", "more"], "t")
    assert lobs.select("lob_id").distinct().count() == 8
    back = load.lob_load(df.limit(0), rows, lobs, ["body", "more"])
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="no content for"):
        load.lob_load(df.limit(0), rows, lobs.where("content <> 'two'"), ["body", "more"]).collect()


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("p", T.StringType())])


def test_a_load_of_one_stamp_twice_gives_the_same_table(spark):
    table = f"{scratch_database(spark)}.goods"
    spark.sql(f"CREATE TABLE {table} (id BIGINT COMMENT 'the key', name STRING, p STRING) USING parquet PARTITIONED BY (p) TBLPROPERTIES ('owner.team' = 'x')")
    first = feed_lines(spark, ["1,a,x", "2,b,x", "3,c,y", "4,d,z"])
    spec = LoadSpec(SCHEMA, ["id"], "comma")
    load_table(spark, table, first, spec, "1")
    files = {r["f"] for r in spark.table(table).where("p = 'z'").select(F.col("_metadata.file_path").alias("f")).collect()}
    second = feed_lines(spark, ["2,B,x", "3,C,x", "5,e,y", "bad,,", "5,f,y"])
    seen = []
    for _ in range(2):
        m = load_table(spark, table, second, spec, "2").first()
        seen.append((m["applied"], m["et"], m["uv"], sorted(map(tuple, spark.table(table).select("id", "name", "p").collect()))))
        assert spark.table(f"{table}_tmp_et_2").count() == 1 and spark.table(f"{table}_tmp_uv_2").count() == 1
    assert seen[0] == seen[1] == (3, 1, 1, [(1, "a", "x"), (2, "B", "x"), (3, "C", "x"), (4, "d", "z"), (5, "e", "y")])
    assert files == {r["f"] for r in spark.table(table).where("p = 'z'").select(F.col("_metadata.file_path").alias("f")).collect()}
    # emptying a partition rewrites the table, which keeps its layout
    load_table(spark, table, feed_lines(spark, ["4,d,x"]), spec, "3")
    assert publish.partition_columns(spark, table) == ["p"]
    assert spark.table(table).where("p = 'z'").count() == 0
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert properties["owner.team"] == "x"


def test_a_load_finds_its_key(spark):
    table = f"{scratch_database(spark)}.goods"
    spark.createDataFrame([(1, "a", "x")], SCHEMA).write.saveAsTable(table)
    spec = LoadSpec(SCHEMA, delimiter=",", candidates=[["p"], ["id"]])
    load_table(spark, table, feed_lines(spark, ["1,b,x", "2,c,x", "2,c,x"]), spec, "1")
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "b", "x"), (2, "c", "x")]


def test_firsts_need_no_sort_aggregate(spark):
    rows = spark.createDataFrame([(1, "f", 0, 2), (1, "f", 0, 1), (2, "f", 0, 3)], "id long, file string, block long, line_no long")
    marked = load.mark_first(rows, ["id"], load.LINE_KEY)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "LocalTableScan" not in plan
    assert sorted(tuple(r) for r in marked.select("line_no", "_first").collect()) == [(1, True), (2, False), (3, True)]


def test_transform_jobs_take_delimiters_by_word(spark):
    out = transform_chain(feed_lines(spark, ["1\tabc", "2\td"]), ["truncate_columns"], FeedSpec(delimiter="tab", limits={1: 2}))
    assert sorted((r["kind"], r["value"]) for r in out.collect()) == [("good", "1\tab"), ("good", "2\td")]


def test_files_end_with_a_status(spark):
    table, inbox, ledger, status = f"{scratch_database(spark)}.goods", *(scratch_path(spark, x) for x in ("inbox", "ledger", "status"))
    spark.createDataFrame([(1, "old", "x")], SCHEMA).write.saveAsTable(table)
    batch = incremental.load_batches(spark, table, LoadSpec(SCHEMA, ["id"], ","), status)
    for values in (["1,a,x", "2,b,x"], ["3,c,y", "bad", "3,d,y", "3,c,y"]):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(inbox)
        incremental.incremental_load(spark, inbox, batch, ledger)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "a", "x"), (2, "b", "x"), (3, "c", "y")]
    ends = spark.read.parquet(status).select("lines", "rejects", "clean").collect()
    assert sorted(map(tuple, ends)) == [(2, 0, True), (4, 2, False)]
