"""repair_linefeeds against the line-by-line model."""

import random

import foldcheck
import models
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedkit.operators import repair
from feedkit.plans.storage import scratch_path
from feedkit.sources import lines as src

# Texts that make, break and overlap each delimiter.
PIECES = {
    b"\t": [b"\t", b"a", b" ", b"\r"],
    b"aa": [b"a", b"b", b"aaa"],
    b"&@!&": [b"&", b"@!", b"!&", b"&@!&", b"&@", b"x"],
    b"aba": [b"a", b"b", b"ab", b"c"],
    "é|".encode(): ["é".encode(), b"\xa9", b"|", b"\xc3", b"z"],
}


@st.composite
def feeds(draw):
    delimiter = draw(st.sampled_from(sorted(PIECES)))
    line = st.lists(st.sampled_from(PIECES[delimiter]), max_size=5).map(b"".join)
    lines = draw(st.lists(line, min_size=1, max_size=30))
    return delimiter, lines, draw(st.sampled_from([None, 1, 2, 3, 4, 6]))


@settings(max_examples=500, deadline=None)
@given(feeds(), st.sampled_from([1, 2, 3, 7, 100]), st.sampled_from([1, 2, 3, 10]), st.sampled_from([1, 3, 100]),
       st.sampled_from([1, 2, 3, 4096]), st.sampled_from([1, 2000, 3000, 1 << 34]))
def test_chunks_give_what_one_pass_gives(feed, chunk_lines, blocks, batch, fan, span):
    delimiter, lines, width = feed
    good, error = models.repair(lines, delimiter, width)
    got = foldcheck.repair(lines, delimiter, width, chunk_lines, blocks, batch, fan, span)
    assert got == (sorted(good), sorted(error))


def random_feed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(["\t", "a", "b", "é", ""]) for _ in range(rng.randint(0, 5))) for _ in range(n)]


def outcome(repaired):
    rows = repaired.collect()
    return tuple(sorted(r["value"] for r in rows if r["kind"] == kind) for kind in ("good", "error"))


def expected(lines, width, delimiter="\t"):
    sides = models.repair([line.encode() for line in lines], delimiter.encode(), width)
    return tuple(sorted(v.decode() for v in side) for side in sides)


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("chunk_lines", [5, 64, 1 << 18])
def test_partitions_and_chunks_change_nothing(spark, partitions, chunk_lines):
    files = {"f1": random_feed(1, 200), "f2": random_feed(2, 150)}
    rows = [(name, i, line) for i in range(200) for name, lines in files.items() for line in lines[i:i + 1]]
    df = spark.createDataFrame(rows, "file string, line_no long, value string").repartition(partitions)
    repaired = repair.repair_linefeeds(df, "\t", 4, chunk_lines=chunk_lines)
    for name, lines in files.items():
        assert outcome(repaired.where(F.col("file") == name)) == expected(lines, 4)


def test_files_scanned_in_many_splits(spark, conf):
    conf(spark__sql__files__maxPartitionBytes="2048")
    path = scratch_path(spark, "feed")
    lines = random_feed(3, 3000)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    scanned = src.scan_lines(spark, path)
    assert scanned.select("block").distinct().count() > 3
    numbered = src.number_lines(scanned).orderBy("line_no").collect()
    assert [r["value"] for r in numbered] == lines
    assert [r["line_no"] for r in numbered] == list(range(1, 3001))
    for in_order, tree in ((True, {}), (False, {"fan": 2, "span": 5000})):
        repaired = repair.repair_linefeeds(scanned, "\t", 5, chunk_lines=100, in_order=in_order, **tree)
        assert outcome(repaired) == expected(lines, 5)


def test_width_of_the_first_line(spark):
    rows = [("a", 0, "x\ty\tz"), ("a", 1, "1\t2"), ("a", 2, "\t3"), ("b", 0, "x\ty"), ("b", 1, "1\t2\t3"), ("b", 2, "")]
    df = spark.createDataFrame(rows, "file string, line_no long, value string")
    got = {(r["file"], r["kind"], r["value"]) for r in repair.repair_linefeeds(df, "\t").collect()}
    assert got == {
        ("a", "good", "x\ty\tz"), ("a", "good", "1\t2\t3"), ("b", "good", "x\ty"), ("b", "error", "1\t2\t3"),
    }


def test_one_record_over_many_chunks(spark):
    rows = [("a", i, "x" if i % 100 else "x\t") for i in range(300)]
    df = spark.createDataFrame(rows, "file string, line_no long, value string")
    got = repair.repair_linefeeds(df, "\t", 4, chunk_lines=7).collect()
    assert [(r["kind"], len(r["value"])) for r in got if r["kind"] == "good"] == [("good", 201 + 3)]
    assert sum(r["kind"] == "error" for r in got) == 99


@pytest.mark.parametrize("in_order", [True, False])
def test_documents_with_missing_and_extra_fields(spark, in_order):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    k = F.col("doc_id")
    text = F.when(k % 10 == 0, F.concat_ws("\t", "doc_id", "text")).when(
        k % 10 == 1, F.concat_ws("\t", "doc_id", "text", "lang", "source", F.lit("extra"))
    ).otherwise(F.concat_ws("\t", "doc_id", "text", "lang", "source"))
    path = scratch_path(spark, "broken")
    docs.coalesce(1).orderBy("doc_id").select(text.alias("value")).write.text(path)
    scanned = src.scan_lines(spark, path)
    lines = [r["value"] for r in src.number_lines(scanned).orderBy("file", "line_no").collect()]
    repaired = repair.repair_linefeeds(scanned, "\t", 4, chunk_lines=50, in_order=in_order)
    assert outcome(repaired) == expected(lines, 4)


def test_no_task_reads_more_notes_than_the_tree_says(spark, monkeypatch):
    lines = random_feed(4, 900)
    df = spark.createDataFrame([("f", i // 300 * 1000, i, line) for i, line in enumerate(lines)],
                               "file string, block long, line_no long, value string")
    whole = repair.linefold.in_file_order

    def few(notes):
        if notes.num_rows > 4:
            raise ValueError("too many notes")
        return whole(notes)

    # 30 chunks in each of 3 blocks: their 24 notes are too many for one task of the second level
    monkeypatch.setattr(repair.linefold, "in_file_order", few)
    with pytest.raises(Exception, match="too many notes"):
        repair.repair_linefeeds(df, "\t", 5, chunk_lines=10, fan=4).collect()
    assert outcome(repair.repair_linefeeds(df, "\t", 5, chunk_lines=100, fan=4, span=2000)) == expected(lines, 5)


def test_bytes_that_are_no_text_stay(spark):
    rows = [("a", 0, bytearray(b"\xff\t1")), ("a", 1, bytearray(b"\xfe\t2"))]
    df = spark.createDataFrame(rows, "file string, line_no long, value binary")
    df = df.withColumn("value", F.col("value").cast("string"))
    got = repair.repair_linefeeds(df, "\t", 3).select(F.hex("value")).collect()
    assert [r[0] for r in got] == [(b"\xff\t1\xfe\t2").hex().upper()]


def test_empty_and_blank_feeds(spark):
    empty = spark.createDataFrame([], "file string, line_no long, value string")
    assert repair.repair_linefeeds(empty, "\t", 3).count() == 0
    blank = spark.createDataFrame([("a", 0, ""), ("a", 1, " \t\t ")], "file string, line_no long, value string")
    assert repair.repair_linefeeds(blank, "\t", 3).count() == 0


def test_lines_out_of_order_raise(spark):
    rows = [("a", i, "x\ty") for i in (2, 1, 0)]
    df = spark.createDataFrame(rows, "file string, line_no long, value string").coalesce(1)
    with pytest.raises(Exception, match="not in order"):
        repair.repair_linefeeds(df, "\t", 3, in_order=True).collect()


@pytest.mark.parametrize("blob", [
    b"", b"1\ta\tb", b"\n\n \n", b"\t\t\n\t\t", b"1\ta\r\tb\n2\r\n\tx\ty\n", b"1\t\xff\n\xfe\tb\n", b"1&@\n!&a&@!&b\n",
])
def test_odd_files(spark, tmp_path, blob):
    (tmp_path / "f.txt").write_bytes(blob)
    delimiter = "&@!&" if b"&" in blob else "\t"
    pieces = blob.split(b"\n")
    read = pieces[:-1] if pieces[-1] == b"" else pieces
    scanned = src.scan_lines(spark, str(tmp_path))
    raw = scanned.orderBy("block", "line_no").select(F.hex("value")).collect()
    assert [bytes.fromhex(r[0]) for r in raw] == read
    good, error = models.repair(read, delimiter.encode(), 3)
    rows = repair.repair_linefeeds(scanned, delimiter, 3, in_order=True).select("kind", F.hex("value").alias("v")).collect()
    got = [sorted(bytes.fromhex(r["v"]) for r in rows if r["kind"] == kind) for kind in ("good", "error")]
    assert got == [sorted(good), sorted(error)]
