"""Feeds: scanning, writing, repairing lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import query, table
from feedkit.functions import text
from feedkit.operators import feed, load, lobstore, repair
from feedkit.operators.order import with_rank
from feedkit.plans.feed_job import FeedSpec, transform_chain
from feedkit.plans.storage import materialize, scratch_path
from feedkit.sinks import delimited
from feedkit.sources import lines as src
from feedkit.streaming import incremental

FLAT_SQL = "replace(text, chr(10), ' ')"


def document_lines(spark, sf):
    """One line per document: id, text without line feeds, language, source."""
    docs = table(spark, sf, "documents")
    return docs.select(
        F.lit("documents").alias("file"), F.col("doc_id").alias("line_no"),
        F.concat_ws("\t", "doc_id", F.replace("text", F.lit("\n"), F.lit(" ")), "lang", "source").alias("value"),
    )


LINES_SQL = f"""
    SELECT doc_id, concat_ws(chr(9), CAST(doc_id AS VARCHAR), {FLAT_SQL}, lang, source) AS value FROM documents
"""


@query(
    "scan_lines",
    """
    SELECT doc_id, CAST(i AS BIGINT) AS place, string_split(text, chr(10))[i] || chr(13) AS line
    FROM documents, LATERAL (SELECT unnest(generate_series(1, len(string_split(text, chr(10))))) AS i)
    """,
)
def scan_lines(spark, sf):
    path = scratch_path(spark, "lines")
    parts = F.explode(F.split("text", "\n", -1)).alias("part")
    written = table(spark, sf, "documents").select("doc_id", parts)
    written.select(F.concat("doc_id", F.lit(":"), "part", F.lit("\r")).alias("value")).write.text(path)
    numbered = src.number_lines(src.scan_lines(spark, path)).select(
        "line_no", F.substring_index("value", ":", 1).cast("bigint").alias("doc_id"), "value"
    )
    first = numbered.groupBy("doc_id").agg(F.min("line_no").alias("first"))
    return numbered.join(first, "doc_id").select(
        "doc_id", (F.col("line_no") - F.col("first") + 1).alias("place"),
        F.expr("substring(value, instr(value, ':') + 1)").alias("line"),
    )


ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType(), True, {"max_length": 1}),
    T.StructField("o_totalprice", T.DecimalType(18, 2)),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType(), True, {"max_length": 15}),
])


def plain_orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


@query(
    "scan_delimited",
    """
    SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus,
           CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, '' AS o_orderpriority
    FROM orders
    """,
)
def scan_delimited(spark, sf):
    path = scratch_path(spark, "orders")
    rows = plain_orders(spark, sf).withColumns(
        {"o_orderstatus": F.nullif("o_orderstatus", F.lit("F")), "o_orderpriority": F.lit("")}
    )
    delimited.write_delimited(rows, path)
    return src.scan_delimited(spark, path, None, ORDER_SCHEMA).withColumn(
        "o_orderstatus", F.nullif("o_orderstatus", F.lit(""))
    )


@query(
    "scan_charset",
    # every tenth line is blank, every other tenth is only spaces or has a field too many
    """
    SELECT CASE conv_id % 10 WHEN 3 THEN '' WHEN 4 THEN '   ' ELSE CAST(conv_id AS VARCHAR) END AS conv_id,
           CASE WHEN conv_id % 10 NOT IN (3, 4) THEN CAST(turn AS VARCHAR) END AS turn,
           CASE WHEN conv_id % 10 NOT IN (3, 4) THEN replace(text, chr(10), ' ') END AS text,
           CASE WHEN conv_id % 10 = 5 THEN 'more&@!&' END AS surplus
    FROM conversations
    """,
)
def scan_charset(spark, sf):
    path = scratch_path(spark, "talk")
    kind = F.col("conv_id") % 10
    whole = F.concat_ws("&@!&", "conv_id", "turn", F.replace("text", F.lit("\n"), F.lit(" ")))
    line = F.when(kind == 3, "").when(kind == 4, "   ").when(kind == 5, F.concat(whole, F.lit("&@!&more&@!&"))).otherwise(whole)
    coded = F.encode(line, "UTF-16LE").cast("string").alias("value")
    table(spark, sf, "conversations").select(coded).write.option("lineSep", "\n\0").text(path)
    return src.scan_charset(spark, path, "UTF-16LE", None, ["conv_id", "turn", "text"], surplus="surplus")


NATION_OF_SQL = "SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg, c_nationkey FROM customer"


def customer_rows(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "c_nationkey"
    )


def fields_sql(sep: str) -> str:
    return f"concat_ws('{sep}', CAST(c_custkey AS VARCHAR), c_name, coalesce(seg, ''), CAST(c_nationkey AS VARCHAR))"


def written_records(spark, path):
    return src.scan_lines(spark, path).select(F.col("value").alias("record"))


@query("write_delimited", f"SELECT {fields_sql('|')} AS record FROM ({NATION_OF_SQL})")
def write_delimited(spark, sf):
    path = scratch_path(spark, "customer")
    delimited.write_delimited(customer_rows(spark, sf), path, "pipe")
    return written_records(spark, path)


@query(
    "write_header",
    f"""
    SELECT true AS first, 'c_custkey,c_name,seg,c_nationkey' AS record
    UNION ALL SELECT false, {fields_sql(',')} FROM ({NATION_OF_SQL})
    """,
)
def write_header(spark, sf):
    path = scratch_path(spark, "customer")
    delimited.write_delimited(customer_rows(spark, sf), path, "comma", header=True)
    rows = src.scan_lines(spark, path)
    # The header is line 1 of the first part in name order.
    head = rows.agg(F.min_by("value", F.struct("file", "block", "line_no")).alias("h")).scalar()
    return rows.select((F.col("value") == head).alias("first"), F.col("value").alias("record"))


@query(
    "write_enclosed",
    f"""
    SELECT '"' || {fields_sql('";"')} || '"' AS record FROM ({NATION_OF_SQL})
    UNION ALL SELECT '''' || c_name || '''' FROM customer
    """,
)
def write_enclosed(spark, sf):
    path, names = scratch_path(spark, "customer"), scratch_path(spark, "names")
    delimited.write_delimited(customer_rows(spark, sf), path, ";", enclosed_by="double-quote")
    delimited.write_delimited(customer_rows(spark, sf).select("c_name"), names, ";", enclosed_by="single-quote")
    return written_records(spark, path).unionAll(written_records(spark, names))


@query("write_append", f"SELECT {fields_sql(',')} AS record FROM ({NATION_OF_SQL}) UNION ALL SELECT c_name FROM customer")
def write_append(spark, sf):
    path = scratch_path(spark, "customer")
    delimited.write_delimited(customer_rows(spark, sf), path, "comma")
    delimited.write_delimited(customer_rows(spark, sf).select("c_name"), path, "comma", mode="append")
    return written_records(spark, path)


@query(
    "write_split",
    "SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus AS record, true AS within FROM orders",
)
def write_split(spark, sf):
    path = scratch_path(spark, "orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    delimited.write_delimited(rows, path, "comma", max_records=4000)
    back = src.scan_lines(spark, path)
    longest = back.groupBy("file").count().agg(F.max("count").alias("n")).scalar()
    return back.select(F.col("value").alias("record"), (longest <= 4000).alias("within"))


@query(
    "write_split_exact",
    """
    WITH lines AS (SELECT 0 AS n, 'o_orderkey,o_orderstatus' AS record UNION ALL
                   SELECT row_number() OVER (ORDER BY o_orderkey DESC), CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus FROM orders)
    SELECT CAST(n // 700 + 1 AS INTEGER) AS file_no, record, count(*) OVER (PARTITION BY n // 700) AS lines FROM lines
    """,
)
def write_split_exact(spark, sf):
    path = scratch_path(spark, "orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").orderBy(F.desc("o_orderkey"))
    delimited.write_delimited(rows, path, "comma", header=True, lines_per_file=700)
    back = src.scan_lines(spark, path)
    sizes = back.groupBy("file").agg(F.count("*").alias("lines"))
    # files in the order of their names: one row for each file
    places = with_rank(sizes, [("file", "asc")], "file_no")
    return back.join(places, "file").select(F.col("file_no").cast("int").alias("file_no"), F.col("value").alias("record"), "lines")


@query(
    "write_transcoded",
    """
    SELECT record, (SELECT count(*) FROM customer) AS written FROM (
        SELECT 'name' AS record UNION ALL SELECT c_name || chr(233) FROM customer)
    """,
)
def write_transcoded(spark, sf):
    path = scratch_path(spark, "names")
    padded = table(spark, sf, "customer").select(F.concat(F.lit("  "), "c_name", F.lit("é \t")).alias("value"))
    n = delimited.write_transcoded(padded, path, charset="ISO-8859-1", newline="windows", header="name")
    back = spark.read.schema("record string").options(
        encoding="ISO-8859-1", lineSep="\r\n", quote="", sep="\t"
    ).csv(path)
    return back.withColumn("written", F.lit(n).cast("bigint"))


@query(
    "incremental_load",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
           o_orderdate, o_orderpriority, o_orderkey % 50 <> 0 AS ok
    FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM orders)
    """,
)
def incremental_load(spark, sf):
    inbox, out, ledger = (scratch_path(spark, label) for label in ("inbox", "staged", "ledger"))
    k = F.col("o_orderkey")
    rows = plain_orders(spark, sf).withColumn("o_custkey", F.when(k % 50 == 0, "?").otherwise(F.col("o_custkey").cast("string")))
    load_batch = incremental.stage_batches(out, "\t", ORDER_SCHEMA)
    for half in (0, 1):
        delimited.write_delimited(rows.where(k % 2 == half), inbox, "tab", mode="append")
        incremental.incremental_load(spark, inbox, load_batch, ledger)
    staged = spark.read.parquet(out)
    return staged.select(*ORDER_SCHEMA.fieldNames(), F.col("reason").isNull().alias("ok"))


@query(
    "repair_linefeeds",
    """
    SELECT 'good' AS kind, concat_ws(chr(9), CAST(doc_id AS VARCHAR), replace(text, chr(10), ''), lang, source) AS value
    FROM documents
    UNION ALL SELECT 'error', concat_ws(chr(9), 'e', doc_id, 1, 2, 3) FROM documents WHERE doc_id % 10 = 1
    """,
)
def repair_linefeeds(spark, sf):
    path = scratch_path(spark, "broken")
    # lines with a field too many stand between the records; small chunks cut through records
    record = F.concat_ws("\t", "doc_id", "text", "lang", "source")
    odd = F.when(F.col("doc_id") % 10 == 1, F.concat(F.lit("\n"), F.concat_ws("\t", F.lit("e"), "doc_id", F.lit("1"), F.lit("2"), F.lit("3"))))
    table(spark, sf, "documents").select(F.concat(record, F.coalesce(odd, F.lit(""))).alias("value")).write.text(path)
    repaired = repair.repair_linefeeds(src.scan_lines(spark, path), "\t", 4, in_order=True, chunk_lines=100)
    return repaired.select("kind", "value")


# Bytes as "E0 A1 " text, so that SQL can replace parts of characters too.
def spaced_hex(c: str) -> str:
    return f"regexp_replace(hex(encode({c})), '(..)', '\\1 ', 'g')"


@query(
    "replace_chars",
    f"""
    SELECT doc_id, replace(replace(replace(text, 'the', 'th'), 'th', 'TH'), 'e', '') AS words,
           replace(replace(replace({spaced_hex('text')}, 'A9 20 ', '5F '), 'C3 ', ''), ' ', '') AS hex_bytes
    FROM documents
    """,
)
def replace_chars(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("words"), F.col("text").alias("raw"))
    out = feed.replace_chars(docs, "words", {"e": "", "th": "TH", "the": "th"})
    out = feed.replace_chars(out, "raw", {b"\xc3": b"", b"\xa9 ": b"_"})
    return out.select("doc_id", "words", F.hex("raw").alias("hex_bytes"))


@query(
    "truncate_columns",
    f"""
    SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'error' ELSE 'good' END AS kind,
           CASE WHEN doc_id % 10 = 3 THEN CAST(doc_id AS VARCHAR) || chr(9) || {FLAT_SQL}
                ELSE concat_ws(chr(9), CAST(doc_id AS VARCHAR), left({FLAT_SQL}, 50), left(lang, 1), source) END AS value
    FROM documents
    """,
)
def truncate_columns(spark, sf):
    rows = document_lines(spark, sf).withColumn(
        "value", F.when(F.col("line_no") % 10 == 3, F.substring_index("value", "\t", 2)).otherwise(F.col("value"))
    )
    cut = feed.truncate_columns(rows, "\t", {1: 50, 2: 1})
    return cut.select(F.col("line_no").alias("doc_id"), "kind", "value")


@query("remove_mbc", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE text || '.' END AS text FROM documents")
def remove_mbc(spark, sf):
    # The first cut joins CE and A9 into another prefix.
    spliced = F.concat(F.unhex(F.lit("CECEA978A979")), F.col("text").cast("binary"), F.unhex(F.lit("CEA92E")))
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, spliced.cast("string")).otherwise(F.concat("text", F.lit("."))).alias("text"),
    )
    return feed.remove_mbc(docs, "text", {"Ω": 3})


@query(
    "split_over_length",
    f"""
    SELECT doc_id, CASE WHEN strlen({FLAT_SQL}) > 2000 THEN 'over' ELSE 'normal' END AS part, value
    FROM (SELECT d.*, l.value FROM documents d JOIN ({LINES_SQL}) l USING (doc_id))
    """,
)
def split_over_length(spark, sf):
    marked = feed.mark_over_length(document_lines(spark, sf), "\t", {1: 2000, 3: 100})
    part = F.when(F.col("kind") == "good", "normal").otherwise(F.col("kind"))
    return marked.select(F.col("line_no").alias("doc_id"), part.alias("part"), "value")


LOB_ID_SQL = "sha256('documents' || chr(31) || CAST(doc_id AS VARCHAR) || chr(31) || '1')"


@query(
    "externalize_lobs",
    f"""
    SELECT doc_id, {LOB_ID_SQL} AS lob_id, {FLAT_SQL} AS content,
           concat_ws(chr(9), CAST(doc_id AS VARCHAR), {LOB_ID_SQL}, lang, source) AS value
    FROM documents WHERE strlen({FLAT_SQL}) > 2000
    """,
)
def externalize_lobs(spark, sf):
    _, over, _ = feed.split_over_length(document_lines(spark, sf), "\t", {1: 2000})
    rows, lobs = feed.externalize_lobs(over, "\t", {1: 2000}, keys=["file", "line_no"])
    named = rows.withColumn("lob_id", F.split("value", "\t")[1]).join(lobs.select("lob_id", "content"), "lob_id")
    return named.select(F.col("line_no").alias("doc_id"), "lob_id", "content", "value")


@query(
    "externalize_by_key",
    """
    SELECT conv_id, turn, 'talk_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '_text' AS ref, text AS content
    FROM conversations
    """,
)
def externalize_by_key(spark, sf):
    talk = table(spark, sf, "conversations")
    rows, lobs = feed.externalize_by_key(talk, ["conv_id", "turn"], ["text"], "talk")
    found = lobs.select(F.col("lob_id").alias("text"), "content")
    return rows.join(found, "text").select("conv_id", "turn", F.col("text").alias("ref"), "content")


@query(
    "lob_load",
    "SELECT doc_id, lang || '_' || source AS a, CASE WHEN doc_id % 9 > 0 THEN '_' || lang END AS b, text, source, n_chars FROM documents",
)
def lob_load(spark, sf):
    # keys hold the separator and NULLs
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat_ws("_", "lang", "source").alias("a"),
        F.when(F.col("doc_id") % 9 > 0, F.concat(F.lit("_"), "lang")).alias("b"), "text", "source", "n_chars")
    is_over = F.octet_length("text") > 2000
    rows, lobs = feed.externalize_by_key(docs.where(is_over), ["doc_id", "a", "b"], ["text", "source"], "documents")
    return load.lob_load(docs.where(~is_over), rows, lobs, ["text", "source"])


@query(
    "transform_chain",
    f"""
    WITH r AS (
        SELECT doc_id, source, strlen(replace(text, chr(10), '')) > 4000 AS over,
               max(CASE WHEN doc_id % 97 = 5 THEN 1 ELSE 0 END) OVER (PARTITION BY source) AS bad,
               concat_ws(chr(9), CAST(doc_id AS VARCHAR), replace(replace(text, chr(10), ''), 'th', 'T'),
                         lang, source) AS whole,
               concat_ws(chr(9), CAST(doc_id AS VARCHAR), left(replace(replace(text, chr(10), ''), 'th', 'T'), 3000),
                         lang, source) AS cut,
               strlen(left(replace(replace(text, chr(10), ''), 'th', 'T'), 3000)) > 2000 AS over_cut
        FROM documents)
    SELECT source AS file,
           CASE WHEN bad = 1 THEN (CASE WHEN doc_id % 97 = 5 THEN 'error' ELSE 'good' END)
                WHEN over_cut THEN 'over' ELSE 'good' END AS kind,
           CASE WHEN bad = 1 THEN whole ELSE cut END AS value,
           CASE WHEN bad = 1 THEN 'refuse_some' END AS failed_step
    FROM r
    """,
)
def transform_chain_query(spark, sf):
    # One file per source; its documents follow each other, lines in order.
    parts = F.posexplode(F.split(F.concat_ws("\t", "doc_id", "text", "lang", "source"), "\n", -1)).alias("i", "value")
    broken = table(spark, sf, "documents").select(
        F.col("source").alias("file"), "doc_id", parts
    ).select("file", (F.col("doc_id") * 100000 + F.col("i")).alias("line_no"), "value")

    def refuse_some(rows):
        doc_id = F.split("value", "\t")[0].cast("bigint")
        return rows.withColumn("kind", F.when(doc_id % 97 == 5, "error").otherwise("good"))

    # Line numbers are sparse here: 100,000 for each document.
    spec = FeedSpec(delimiter="\t", n_columns=4, replacements={"th": "T"}, limits={1: 3000}, chunk_lines=1 << 34)
    over = FeedSpec(delimiter="\t", limits={1: 2000})

    def mark_over(rows):
        return feed.mark_over_length(rows, over.delimiter, over.limits)

    steps = ["repair_linefeeds", "replace_chars", refuse_some, "truncate_columns", mark_over]
    return transform_chain(broken, steps, spec).select("file", "kind", "value", "failed_step")


@query(
    "lob_store",
    """
    WITH v AS (SELECT text AS content FROM documents UNION ALL SELECT lang FROM documents)
    SELECT doc_id, text, lang, (SELECT count(*) FROM v WHERE content = lang) AS lang_refs,
           (SELECT count(DISTINCT content) FROM v) AS stored FROM documents
    """,
)
def lob_store(spark, sf):
    # stored in two batches, merged and read back
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    parts = [lobstore.store_contents(docs.where(part), ["text", "lang"]) for part in ("doc_id % 2 = 0", "doc_id % 2 = 1")]
    store = materialize(lobstore.merge_stores(parts[0][1], parts[1][1]))
    rows = parts[0][0].unionAll(parts[1][0])
    refs = store.select(F.col("content").alias("lang"), F.col("refs").alias("lang_refs"))
    stored = store.agg(F.count("*").alias("n")).scalar()
    back = lobstore.load_contents(rows, store, ["text", "lang"])
    return back.join(refs, "lang").select("doc_id", "text", "lang", "lang_refs", stored.alias("stored"))
