"""Column helpers and their parameters."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedkit.functions import dates, match, text
from feedkit.operators import extract, filters, order, reports
from feedkit.sinks import jdbc as jdbc_sink
from feedkit.sources import jdbc


def one(spark, column, **values):
    df = spark.range(1)
    return df.select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_")).select(column.alias("c")).first()["c"]


@given(st.binary(max_size=20))
def test_decode_escapes_undoes_python_escapes(raw):
    assert text.decode_escapes(repr(raw)[2:-1]) == raw


def test_delimiters():
    assert [text.delimiter_of(w) for w in (None, "tab", "TAB", "\\t", "pipe", "&|", "csv")] == [
        "&@!&", "\t", "\t", "\t", "|", "&|", ","
    ]


def test_java_quote(spark):
    for d in ("a\\Eb", "\\Q", ".*", "|"):
        assert one(spark, text.split_literal(F.col("s"), d), s=f"x{d}y{d}") == ["x", "y", ""]


@pytest.mark.parametrize("raw,trim,want", [
    ("a:1,b:2", False, {"a": "1", "b": "2"}), ("a:b:1", False, {"a:b": "1"}), (" a : 1 ", True, {"a": "1"}),
    ("a:1,a:2", False, {"a": "2"}), ("", False, {}), (":x", False, {"": "x"}), ("k:", False, {"k": ""}),
])
def test_parse_mapping(spark, raw, trim, want):
    assert one(spark, text.parse_mapping(F.col("s"), trim=trim), s=raw) == want


def test_parse_mapping_needs_a_colon(spark):
    with pytest.raises(Exception, match="no ':'"):
        one(spark, text.parse_mapping(F.col("s")), s="a:1,b")


def test_parse_list(spark):
    assert one(spark, text.parse_list(F.col("s"), trim=True), s=" a ,,b") == ["a", "", "b"]
    assert one(spark, text.parse_list(F.col("s")), s="") == []


def test_time_zone_does_not_bend_times(spark, conf):
    conf(spark__sql__session__timeZone="America/Los_Angeles")
    s = F.col("s")
    assert one(spark, dates.date_reformat(s, "YYYYMMDDHHMM", "YYYYMMDDHHMMSS"), s="202003080230") == "20200308023000"
    assert one(spark, dates.format_timestamp(s.cast("timestamp_ntz")), s="2020-03-08 02:30:00") == "2020-03-08 02:30:00"


@pytest.mark.parametrize("fmt,good,bad", [
    ("YYYYMM", "202002", "202013"), ("YYYYMMDD", "20200229", "20210229"), ("YYYYMMDDHHMM", "202002292359", "202002292400"),
    ("YYYYMMDDHHMMSS", "20200229235959", "20200229235960"), ("YYYY-MM-DD", "2020-02-29", "2020-02-30"),
    ("YYYY/MM/DD", "2020/02/29", "2020-02-29"), ("DD/MM/YYYY", "29/02/2020", "02/29/2020"), ("MM/DD/YYYY", "02/29/2020", "29/02/2020"),
])
def test_date_formats_round_trip(spark, fmt, good, bad):
    assert one(spark, dates.date_reformat(F.col("s"), fmt, fmt), s=good) == good
    assert one(spark, dates.is_valid_date(F.col("s"), fmt), s=good) is True
    assert one(spark, dates.is_valid_date(F.col("s"), fmt), s=bad) is False
    assert one(spark, dates.date_shift(F.col("s"), 1, fmt), s=bad) == bad


def test_date_words(spark):
    day = dt.date(2024, 3, 1)
    got = [one(spark, dates.date_reformat(F.col("s"), "YYYYMMDD", "YYYY-MM-DD", 1, day), s=s) for s in ("today", "yesterday", "x")]
    assert got == ["2024-02-29", "2024-02-28", None]
    with pytest.raises(ValueError, match="unknown date format"):
        dates.date_reformat(F.col("s"), "YY", "YYYYMMDD")
    with pytest.raises(ValueError):
        dates.date_list(F.col("s"), -1)


def test_path_tokens(spark):
    path = dates.path_tokens("S_<ORIGINAL_NAME_4:11>_<TODAY>", "2024-01-31", F.col("s"))
    assert one(spark, path, s="abc_20240131.csv") == "S_2024013_20240131"
    path = dates.path_tokens("<ORIGINAL_NAME_-4:99><ORIGINAL_NAME_0:-4><ORIGINAL_NAME_3:1>", "2024-01-31", F.col("s"))
    assert one(spark, path, s="abc.csv") == ".csvabc"
    path = dates.path_tokens("<NEXT_MONTH><LAST_MONTH><RANDOM>", "2024-01-31", random=F.lit("r"))
    assert one(spark, path) == "202402202312r"


@pytest.mark.parametrize("name,as_of,want", [
    ("t_20240101", "2024-01-11", False), ("t_20240101", "2024-01-12", True), ("t_20240101", "2024-01-11 00:00:01", True),
    ("t_20240230", "2025-01-01", False), ("t", "2025-01-01", False), ("t_2024010", "2025-01-01", False), (None, "2025-01-01", False),
])
def test_expired_by_suffix(spark, name, as_of, want):
    assert one(spark, match.expired_by_suffix(F.col("s").cast("string"), 10, as_of), s=name) is want


def test_season_and_range(spark):
    ts = F.col("t").cast("timestamp_ntz")
    wrap = match.match_season(ts, 11, 15, 2, 10)
    assert [one(spark, wrap, t=t) for t in ("2020-11-15", "2020-02-10", "2020-02-11", "2020-07-01")] == [True, True, False, False]
    assert one(spark, match.match_season(ts, None, 1, 2, 3), t="2020-01-01") is True
    assert one(spark, match.match_season(F.lit(None).cast("date"), 1, 1, 2, 2)) is False
    assert one(spark, match.match_range(F.lit(None).cast("int"), None, 5)) is False
    assert one(spark, match.match_range(F.lit(None).cast("int"))) is True


def test_window_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = filters.date_window(orders, "o_orderdate", "19970131", 30)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_target_day():
    assert filters.target_day("yesterday", dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)
    assert filters.target_day("20240301") == dt.date(2024, 3, 1)


def test_conditions_only_in_full_mode(spark):
    df = spark.range(5)
    assert filters.extract_mode(df, "full", conditions="id > 2").count() == 2
    assert filters.extract_mode(df, "days_back", conditions="id > 2").count() == 5


def test_strict_keeps_columns_that_cannot_be_null(spark):
    df = spark.range(1).select("id", F.lit(None).cast("string").alias("s"))
    strict = extract.clean_columns(df, "strict")
    assert strict.first().asDict() == {"id": "0", "s": ""}


def test_lobs_first_and_projection(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(3).alias("select"))
    assert extract.lobs_first(df, ["T2"], ["T1", "T2", "T3"]).columns == ["b", "a", "select"]
    with pytest.raises(ValueError):
        extract.lobs_first(df, ["b"], ["T1"])
    assert extract.load_projection(df).columns == ["a", "b", "selectField"]
    assert extract.load_projection(df, "select,a", ["x", "y"]).columns == ["x", "y"]


def test_ordered_list_in_pieces(spark):
    rows = spark.range(0, 5000, 1, 8).select((F.col("id") % 2).alias("g"), "id", F.col("id").cast("string").alias("v"))
    for piece in (3, 4096):
        got = {r["g"]: r["items"] for r in reports.ordered_list_agg(rows, ["g"], "id", "v", piece=piece).collect()}
        assert got == {g: ",".join(str(i) for i in range(g, 5000, 2)) for g in (0, 1)}


def test_rank_is_global(spark):
    rows = spark.range(0, 10000, 1, 8).select((F.col("id") * 7919 % 10007).alias("x"))
    ranked = order.with_rank(rows, [("x", "desc")]).collect()
    assert {r["rank"]: r["x"] for r in ranked} == dict(enumerate(sorted((i * 7919 % 10007 for i in range(10000)), reverse=True), 1))


def test_jdbc_options():
    assert jdbc.read_options("u", "SELECT 1", isolation=2) == {
        "url": "u", "fetchsize": "100", "query": "SELECT 1",
        "sessionInitStatement": "SET SESSION TRANSACTION ISOLATION LEVEL READ COMMITTED",
    }
    ranged = jdbc.read_options("u", "SELECT k FROM t", partition_column="k", lower=0, upper=9, partitions=3)
    assert ranged["dbtable"] == "(SELECT k FROM t) q" and "query" not in ranged and ranged["numPartitions"] == "3"
    with pytest.raises(ValueError):
        jdbc.read_options("u", "q", partition_column="k")
    assert jdbc_sink.write_options("u", "t", isolation=4)["isolationLevel"] == "SERIALIZABLE"
