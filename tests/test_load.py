"""Loads end to end."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text
from feedkit.operators import keys, load, repair, tables
from feedkit.plans.extract_job import ExtractSpec, extract_records
from feedkit.plans.load_job import LoadSpec, load_table, tag_rows
from feedkit.plans.storage import scratch_database, scratch_path
from feedkit.sinks import delimited
from feedkit.sources import lines as src
from feedkit.streaming import incremental

SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True, {"max_length": 5}),
    T.StructField("price", T.DecimalType(8, 2)),
    T.StructField("day", T.DateType()),
])


def feed_lines(spark, values, file="f.txt"):
    rows = [(file, 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "file string, block long, line_no long, value string")


def test_stage_typed_reasons(spark):
    lines = feed_lines(spark, [
        "1,ann,1.50,2020-02-29", "2,,,", "x,bob,1,2020-01-01", ",bob,1,", "3,toolong,9999999.99,2020-02-30",
        "4,a", "5,b,123456789012345678901,", "6,c,1,2020-01-01,more",
    ])
    staged, et = load.stage_typed(lines, ",", SCHEMA)
    assert [tuple(r)[3:] for r in staged.orderBy("line_no").collect()] == [
        (1, "ann", Decimal("1.50"), dt.date(2020, 2, 29)), (2, None, None, None)
    ]
    assert [r["reason"] for r in et.orderBy("line_no").collect()] == [
        "id: not bigint", "id: empty", "name: longer than 5; price: not decimal(8,2); day: not date",
        "2 fields, not 4", "price: not decimal(8,2)", "5 fields, not 4",
    ]
    assert et.orderBy("line_no").first()["value"] == "x,bob,1,2020-01-01"


def test_bytes_cannot_be_loaded(spark):
    schema = T.StructType([T.StructField("b", T.BinaryType())])
    with pytest.raises(ValueError, match="cannot be loaded"):
        load.stage_typed(feed_lines(spark, ["x"]), ",", schema)


def test_tags(spark):
    lines = feed_lines(spark, ["1,a,1,", "1,a,1,", "1,b,1,", "2,c,1,", "bad,c,1,", "1,b,1,", "2,c,1,"])
    kinds = [r["kind"] for r in tag_rows(lines, LoadSpec(SCHEMA, ["id"], ",")).orderBy("line_no").collect()]
    assert kinds == ["good", "duplicate", "uv", "good", "et", "duplicate", "duplicate"]


def test_load_table_upserts_and_keeps_rejects(spark):
    table = f"{scratch_database(spark)}.goods"
    first = feed_lines(spark, ["1,a,1,", "2,b,2,", "3,c,3,"])
    spec = LoadSpec(SCHEMA, ["id"], ",", mode="full")
    m = load_table(spark, table, first, spec, "202001010000").first()
    assert (m["applied"], m["deleted"], m["status"]) == (3, 0, "ok")
    second = feed_lines(spark, ["2,bb,9,", "4,d,4,", "4,e,4,", "x,,,", "4,d,4,"])
    spec = LoadSpec(SCHEMA, ["id"], ",")
    m = load_table(spark, table, second, spec, "202001020000").first()
    assert m.asDict() == {
        "rows_read": 5, "applied": 2, "et": 1, "uv": 1, "duplicates": 1, "deleted": 1, "status": "failed"
    }
    rows = spark.table(table).orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "a"), (2, "bb"), (3, "c"), (4, "d")]
    assert spark.table(f"{table}_tmp_et_202001020000").count() == 1
    assert spark.table(f"{table}_tmp_uv_202001020000").first()["name"] == "e"
    assert not spark.catalog.tableExists(f"{table}_bak_202001020000")


def test_full_mode_takes_one_input(spark):
    two = feed_lines(spark, ["1,a,1,"], "x.txt").unionAll(feed_lines(spark, ["2,a,1,"], "y.txt"))
    with pytest.raises(ValueError, match="one input"):
        load.assert_single_batch(two)
    load.assert_single_batch(feed_lines(spark, ["1"], "x.txt").unionAll(feed_lines(spark, ["2"], "x.lob")))


def test_key_discovery(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (2, 1, 6)], "a int, b int, c int")
    assert load.discover_key(df, [["a"], ["c"], ["a", "b"]]) == ["a", "b"]
    with pytest.raises(ValueError, match="no candidate"):
        load.discover_key(df, [["a"]])


def test_clone_and_sql(spark):
    base = scratch_database(spark)
    spark.range(3).write.saveAsTable(f"{base}.a")
    tables.clone_table(spark, f"{base}.a", f"{base}.b")
    tables.clone_table(spark, f"{base}.a", f"{base}.c", with_data=True)
    assert spark.table(f"{base}.b").count() == 0
    out = tables.run_sql(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE id < :top", {"t": f"{base}.c", "top": 2})
    assert out.first()["n"] == 2


def test_incremental_load_sees_each_file_once(spark):
    inbox, out, ledger = (scratch_path(spark, x) for x in ("inbox", "out", "ledger"))
    batch = incremental.stage_batches(out, ",", SCHEMA)
    for values in (["1,a,1,", "2,b,2,"], ["3,c,3,", "bad"]):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(inbox)
        incremental.incremental_load(spark, inbox, batch, ledger)
    incremental.incremental_load(spark, inbox, batch, ledger)
    staged = spark.read.parquet(out)
    assert sorted(r["id"] for r in staged.where("reason IS NULL").collect()) == [1, 2, 3]
    assert sorted((r["lines"], r["rejects"], r["clean"]) for r in incremental.file_status(staged).collect()) == [
        (2, 0, True), (2, 1, False)
    ]


def test_extract_corrupt_repair_load_reconcile(spark):
    """Orders go out, get broken by line feeds, come back in, and nothing differs."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")
    )
    records = extract_records(orders, ExtractSpec(mode="full"))
    parts = F.split("record", "&@!&")
    broken = records.select(F.when(F.abs(F.hash("record")) % 3 > 0, F.concat_ws(
        "&@!&", parts[0], F.concat(F.substring(parts[1], 1, 1), F.lit("\n"), F.expr("substring(split(record, '&@!&')[1], 2)")),
        F.array_join(F.slice(parts, 3, 9), "&@!&"),
    )).otherwise(F.col("record")).alias("value"))
    path = scratch_path(spark, "orders")
    broken.write.text(path)
    lines = src.scan_lines(spark, path)
    assert lines.count() > orders.count()
    repaired = repair.repair_linefeeds(lines, text.DEFAULT_DELIMITER, 6, in_order=True, chunk_lines=100)
    good, error = repair.good_and_error(repaired)
    assert error.count() == 0
    loaded, et = load.stage_typed(good, text.DEFAULT_DELIMITER, orders.schema)
    assert et.count() == 0
    sides = [df.select("o_orderkey", F.xxhash64(*orders.columns).alias("row")) for df in (orders, loaded)]
    statuses = keys.reconcile(*sides, ["row"], "o_orderkey").select("status").distinct().collect()
    assert [r[0] for r in statuses] == ["same"]


def test_written_files(spark):
    path = scratch_path(spark, "out")
    df = spark.createDataFrame([(1, None, "a"), (2, "x", "")], "k int, a string, b string").coalesce(1)
    delimited.write_delimited(df, path, "tab", header=True, enclosed_by="double-quote")
    rows = [r["value"] for r in src.number_lines(src.scan_lines(spark, path)).orderBy("file", "line_no").collect()]
    assert rows == ['"k"\t"a"\t"b"', '"1"\t""\t"a"', '"2"\t"x"\t""']


def test_transcoded_lines(spark):
    path = scratch_path(spark, "out")
    df = spark.createDataFrame([(' é, "q" ',), ("",), ("plain",)], "value string").coalesce(1)
    assert delimited.write_transcoded(df, path, "ISO-8859-1", "windows") == 3
    blob = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(path).collect())
    assert blob == 'é, "q"\r\n\r\nplain\r\n'.encode("latin-1")
    greek = spark.createDataFrame([("\u03b1",)], "value string")
    with pytest.raises(Exception, match="(?i)encod|charset|malformed"):
        delimited.write_transcoded(greek, scratch_path(spark, "out"), "ISO-8859-1")
    with pytest.raises(ValueError):
        delimited.write_transcoded(greek, scratch_path(spark, "out"), newline="nothing")
