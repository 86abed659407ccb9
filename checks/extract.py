"""Extract: windows, filters, projections, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from feedkit.functions import dates, match, text
from feedkit.operators import extract, filters
from feedkit.plans.extract_job import ExtractSpec, extract_records

MONEY = "decimal(18,2)"

# The same record text in SQL: window on orders, cleaned fields, default delimiter.
ORDER_FIELDS_SQL = """
    CAST(o_orderkey AS VARCHAR),
    CAST(o_custkey AS VARCHAR),
    coalesce(replace(replace(replace(o_orderstatus, chr(9), ' '), chr(10), ' '), chr(13), ' '), ''),
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR),
    CAST(o_orderdate AS VARCHAR),
    coalesce(replace(replace(replace(o_orderpriority, chr(9), ' '), chr(10), ' '), chr(13), ' '), '')
"""
WINDOW_SQL = "CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'"


def orders_with_money(spark, sf):
    return table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast(MONEY))


@query("flagship_extract", f"SELECT concat_ws('&@!&', {ORDER_FIELDS_SQL}) AS record FROM orders WHERE {WINDOW_SQL}")
def flagship_extract(spark, sf):
    spec = ExtractSpec(date_column="o_orderdate", target="19970131", days_back=30)
    return extract_records(orders_with_money(spark, sf), spec)


@query("date_window", f"SELECT o_orderkey, o_orderdate FROM orders WHERE {WINDOW_SQL}")
def date_window(spark, sf):
    orders = table(spark, sf, "orders")
    return filters.date_window(orders, "o_orderdate", "19970131", 30).select("o_orderkey", "o_orderdate")


@query(
    "extract_mode",
    f"""
    SELECT 'full' AS run, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'days_back', o_orderkey FROM orders WHERE {WINDOW_SQL}
    """,
)
def extract_mode(spark, sf):
    orders = table(spark, sf, "orders")
    wanted = F.col("o_orderstatus") == "F"
    args = dict(date_column="o_orderdate", target="19970131", days_back=30, conditions=wanted)
    runs = [
        filters.extract_mode(orders, mode, **args).select(F.lit(mode).alias("run"), "o_orderkey")
        for mode in ("full", "days_back")
    ]
    return runs[0].unionAll(runs[1])


@query("project_columns", "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def project_columns(spark, sf):
    return extract.project_columns(table(spark, sf, "orders"), ["`o_totalprice`", 0, "o_orderstatus"])


UUID_SQL = """
    substring(md5(CAST({k} AS VARCHAR)), 1, 8) || '-' || substring(md5(CAST({k} AS VARCHAR)), 9, 4) || '-' ||
    substring(md5(CAST({k} AS VARCHAR)), 13, 4) || '-' || substring(md5(CAST({k} AS VARCHAR)), 17, 4) || '-' ||
    substring(md5(CAST({k} AS VARCHAR)), 21, 12)
"""


def typed_documents(spark, sf):
    """Documents with a column of each source type, some NULL."""
    k = F.col("doc_id")
    return table(spark, sf, "documents").select(
        k,
        F.unhex(F.md5(k.cast("string"))).alias("uid"),
        F.unhex(F.when(k % 3 == 0, "616263").when(k % 3 == 1, F.concat(F.md5(k.cast("string")), F.lit("00" * 24)))).alias("blob"),
        F.when(k % 7 != 0, F.col("text")).alias("body"),
        F.nullif(F.col("lang"), F.lit("en")).alias("lang"),
        F.when(k % 5 != 0, F.date_add(F.lit("2020-02-27").cast("date"), (k % 400).cast("int"))).alias("day"),
        F.when(
            k % 3 != 0,
            F.lit("2020-02-27 10:20:30").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k % 90000),
        ).alias("moment"),
        F.when(k % 4 != 0, F.col("n_chars")).alias("size"),
    )


TYPED_SQL = f"""
    SELECT doc_id AS k, {UUID_SQL.format(k="doc_id")} AS uid,
           CASE doc_id % 3 WHEN 0 THEN '616263' WHEN 1 THEN md5(CAST(doc_id AS VARCHAR)) || repeat('00', 24) ELSE '' END AS blob,
           CASE WHEN doc_id % 7 <> 0 THEN text END AS body, nullif(lang, 'en') AS lang,
           CASE WHEN doc_id % 5 <> 0 THEN DATE '2020-02-27' + CAST(doc_id % 400 AS INTEGER) END AS day,
           CASE WHEN doc_id % 3 <> 0
                THEN TIMESTAMP '2020-02-27 10:20:30' + to_seconds(doc_id % 90000) END AS moment,
           CASE WHEN doc_id % 4 <> 0 THEN n_chars END AS size
    FROM documents
"""


def spaced(c: str) -> str:
    return f"replace(replace(replace({c}, chr(9), ' '), chr(10), ' '), chr(13), ' ')"


CLEAN_REST_SQL = """
    coalesce(strftime(day, '%Y-%m-%d'), '') AS day,
    coalesce(strftime(moment, '%Y-%m-%d %H:%M:%S'), '') AS moment,
    coalesce(CAST(size AS VARCHAR), '') AS size
"""


@query(
    "clean_columns",
    f"""
    SELECT CAST(k AS VARCHAR) AS doc_id, uid, blob, coalesce({spaced("body")}, '') AS body,
           coalesce(lang, '') AS lang, {CLEAN_REST_SQL}
    FROM ({TYPED_SQL})
    """,
)
def clean_columns(spark, sf):
    return extract.clean_columns(typed_documents(spark, sf))


def without_sequences(c: str) -> str:
    for code in ("127", "26", "65533", "65471", "1806", "1868", "897", "898", "1422", "4785"):
        c = f"replace({c}, chr({code}), '')"
    return c


@query(
    "clean_columns_strict",
    f"""
    SELECT CAST(k AS VARCHAR) AS doc_id, uid, blob, coalesce({without_sequences(spaced("body"))}, '') AS body,
           coalesce(lang, '') AS lang, {CLEAN_REST_SQL}
    FROM (SELECT * REPLACE (chr(65533) || body || chr(127) || 'x' || chr(1422) AS body) FROM ({TYPED_SQL}))
    """,
)
def clean_columns_strict(spark, sf):
    dirty = typed_documents(spark, sf).withColumn(
        "body", F.concat(F.lit("\ufffd"), F.col("body"), F.lit("\x7fx\u058e"))
    )
    return extract.clean_columns(dirty, style="strict")


@query("add_literals", "SELECT *, 'customer@db1' AS src, 'crm' AS owner FROM customer")
def add_literals(spark, sf):
    customers = table(spark, sf, "customer")
    return extract.add_literals(customers, "src:<TABLENAME>@<HOST>,owner:<SCHEMA>", "customer", "db1", "crm")


@query(
    "record_concat",
    """
    SELECT concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), ''),
                     CAST(c_nationkey AS VARCHAR)) AS record
    FROM customer
    """,
)
def record_concat(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "c_nationkey"
    )
    return extract.record_concat(rows, "|")


@query(
    "fixed_width_record",
    """
    SELECT rpad(left(concat_ws(',', '"' || CAST(o_orderkey AS VARCHAR) || '"',
                '"' || trim(o_orderpriority, ' ') || '"',
                '"' || coalesce(nullif(o_orderstatus, 'F'), '') || '"',
                '"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"'), 45), 45, ' ') AS record
    FROM orders
    """,
)
def fixed_width_record(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("p"),
        F.nullif("o_orderstatus", F.lit("F")).alias("s"), "o_orderdate",
    )
    return extract.fixed_width_record(rows, ",", width=45, enclosed_by="double-quote")


@query("load_projection", 'SELECT p_partkey AS "field_1key", p_name AS "titleField", p_size AS size FROM part')
def load_projection(spark, sf):
    part = table(spark, sf, "part").withColumnsRenamed({"p_partkey": "1key", "p_name": "title", "p_size": "size"})
    return extract.load_projection(part, "size,1key,title")


@query("lobs_first", "SELECT text, source, doc_id, lang, n_chars FROM documents")
def lobs_first(spark, sf):
    return extract.lobs_first(table(spark, sf, "documents"), ["source", "text"])


@query("match_values", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'error')")
def match_values(spark, sf):
    events = table(spark, sf, "events")
    everything = match.match_values(F.col("event_type"), [])
    wanted = match.match_values(F.col("event_type"), ["click", "error"])
    return events.where(everything & wanted).select("event_id", "event_type")


@query(
    "match_range",
    "SELECT event_id, v FROM (SELECT event_id, nullif(user_id, 8) AS v FROM events) WHERE v >= 5 AND v <= 40",
)
def match_range(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.nullif("user_id", F.lit(8)).alias("v"))
    return events.where(match.match_range(F.col("v"), 5, 40))


@query(
    "match_season",
    """
    SELECT o_orderkey, CAST(month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS month_day FROM orders
    WHERE month(o_orderdate) * 100 + day(o_orderdate) >= 1115 OR month(o_orderdate) * 100 + day(o_orderdate) <= 210
    """,
)
def match_season(spark, sf):
    at = F.col("o_orderdate")
    orders = table(spark, sf, "orders").where(match.match_season(at, 11, 15, 2, 10))
    return orders.select("o_orderkey", (F.month(at) * 100 + F.dayofmonth(at)).alias("month_day"))


@query(
    "name_like_filter",
    """
    SELECT p_partkey, n AS name FROM (SELECT p_partkey, replace(p_name, ' ', '_') AS n FROM part)
    WHERE (n LIKE 'red!_%' ESCAPE '!' OR n LIKE '%!_ring' ESCAPE '!')
      AND n NOT LIKE 'small%' AND n <> 'red_widget'
    """,
)
def name_like_filter(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    return filters.like_filter(part, "name", ["red!_%", "%!_ring"], ["small%"], names=["red_widget"])


@query(
    "expired_by_suffix",
    """
    WITH named AS (
        SELECT event_id, event_type || CASE event_id % 5
            WHEN 0 THEN '_20230230' WHEN 1 THEN '' ELSE strftime(ts, '_%Y%m%d') END AS name FROM events)
    SELECT event_id, name FROM named
    WHERE regexp_matches(name, '_[0-9]{8}$')
      AND date_diff('day', CAST(try_strptime(right(name, 8), '%Y%m%d') AS DATE), DATE '2024-02-01') > 20
    """,
)
def expired_by_suffix(spark, sf):
    k = F.col("event_id") % 5
    suffix = F.when(k == 0, "_20230230").when(k == 1, "").otherwise(F.date_format("ts", "_yyyyMMdd"))
    named = table(spark, sf, "events").select("event_id", F.concat("event_type", suffix).alias("name"))
    return filters.expired(named, "name", 20, "2024-02-01")


@query("null_to_empty", "SELECT c_custkey, trim(coalesce(nullif(c_mktsegment, 'BUILDING'), ''), ' ') AS seg FROM customer")
def null_to_empty(spark, sf):
    padded = F.concat(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("  "))
    return table(spark, sf, "customer").select("c_custkey", text.null_to_empty(padded, trim=True).alias("seg"))


@query(
    "zero_date_guard",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS at FROM orders",
)
def zero_date_guard(spark, sf):
    raw = F.when(F.col("o_orderkey") % 10 == 0, "0000-00-00 00:00:00").otherwise(dates.format_timestamp(F.col("o_orderdate")))
    return table(spark, sf, "orders").select("o_orderkey", dates.zero_date_guard(raw).alias("at"))


@query("format_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d') AS day FROM events")
def format_timestamp(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", dates.format_timestamp(ts).alias("at"), dates.format_date(ts).alias("day")
    )


@query(
    "binary_to_uuid",
    f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE {UUID_SQL.format(k='doc_id')} END AS uid FROM documents",
)
def binary_to_uuid(spark, sf):
    k = F.col("doc_id")
    raw = F.when(k % 7 != 0, F.unhex(F.md5(k.cast("string"))))
    return table(spark, sf, "documents").select("doc_id", text.binary_to_uuid(raw).alias("uid"))


@query("whitespace_to_space", f"SELECT doc_id, {spaced('text')} AS body FROM documents")
def whitespace_to_space(spark, sf):
    noisy = F.concat(F.lit("\0"), "text", F.lit("\0"))
    return table(spark, sf, "documents").select("doc_id", text.whitespace_to_space(noisy).alias("body"))


@query("rtrim_spaces", "SELECT conv_id, turn, rtrim(text, ' ') || chr(160) AS body FROM conversations")
def rtrim_spaces(spark, sf):
    padded = F.concat(F.rtrim("text"), F.lit("\u00a0   "))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.rtrim_spaces(padded).alias("body"))


@query(
    "percent_of",
    """
    SELECT l_orderkey, l_quantity AS q, CAST(CASE WHEN l_discount = 0 THEN 0
           ELSE CAST(l_discount AS DECIMAL(18,4)) * 100 / 4 END AS DECIMAL(18,1)) AS share
    FROM lineitem
    """,
)
def percent_of(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", F.col("l_quantity").alias("q"), text.percent_of(F.col("l_discount"), F.lit(4)).alias("share")
    )


@query(
    "date_reformat",
    """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '30/01/2020' WHEN 1 THEN '29/01/2020' WHEN 2 THEN NULL
           ELSE strftime(o_orderdate - INTERVAL 2 DAY, '%d/%m/%Y') END AS day
    FROM orders
    """,
)
def date_reformat(spark, sf):
    k = F.col("o_orderkey") % 4
    raw = (F.when(k == 0, "today").when(k == 1, "yesterday").when(k == 2, "20201301")
           .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    day = dates.date_reformat(raw, "YYYYMMDD", "DD/MM/YYYY", days_back=2, as_of="2020-02-01")
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"))


@query(
    "date_shift",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'soon'
           ELSE strftime(o_orderdate + INTERVAL 45 DAY, '%Y/%m/%d') END AS day
    FROM orders
    """,
)
def date_shift(spark, sf):
    raw = F.when(F.col("o_orderkey") % 9 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    return table(spark, sf, "orders").select("o_orderkey", dates.date_shift(raw, 45, "YYYY/MM/DD").alias("day"))


@query(
    "date_list",
    """
    SELECT CAST(d.day AS DATE) AS day, count(*) AS orders
    FROM orders, LATERAL (SELECT unnest(generate_series(
        CAST(o_orderdate AS DATE) - 3, CAST(o_orderdate AS DATE), INTERVAL 1 DAY)) AS day) d
    GROUP BY 1
    """,
)
def date_list(spark, sf):
    days = F.explode(dates.date_list(F.col("o_orderdate"), 3)).alias("day")
    return table(spark, sf, "orders").select(days).groupBy("day").agg(F.count("*").alias("orders"))


@query(
    "is_valid_date",
    """
    SELECT o_orderkey, o_orderkey % 6 <> 0 AS valid,
           CASE WHEN o_orderkey % 6 = 0 THEN TIMESTAMP '1900-01-01 00:00:00' ELSE o_orderdate END AS at
    FROM orders
    """,
)
def is_valid_date(spark, sf):
    raw = F.when(F.col("o_orderkey") % 6 == 0, "31/02/1997").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    fallback = F.lit("1900-01-01 00:00:00")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.is_valid_date(raw, "DD/MM/YYYY").alias("valid"),
        dates.parse_date(raw, "DD/MM/YYYY", fallback).alias("at"),
    )


@query("months_back_4w", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 84 AS day FROM orders")
def months_back_4w(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.months_back_4w(F.col("o_orderdate"), 3).alias("day"))


@query(
    "month_tokens",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS this_month,
           strftime(o_orderdate - INTERVAL 1 MONTH, '%Y%m') AS last_month,
           strftime(o_orderdate + INTERVAL 1 MONTH, '%Y%m') AS next_month
    FROM orders
    """,
)
def month_tokens(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.month_token(d).alias("this_month"),
        dates.month_token(d, -1).alias("last_month"),
        dates.month_token(d, 1).alias("next_month"),
    )


@query(
    "path_tokens",
    """
    SELECT p_partkey, 'out_' || substring(p_name, 3, 4) || '_20240229_20240228_202403_202402_202401_'
           || substring(p_name, 1, 2) || '.csv' AS path
    FROM part
    """,
)
def path_tokens(spark, sf):
    name = ("out_<ORIGINAL_NAME_2:6>_<TODAY>_<YESTERDAY>_<NEXT_MONTH>_<THIS_MONTH>_<LAST_MONTH>_"
            "<ORIGINAL_NAME_0:2>.csv")
    path = dates.path_tokens(name, "2024-02-29", F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", path.alias("path"))


@query(
    "parse_mapping",
    """
    SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, 2 AS n
    FROM part
    """,
)
def parse_mapping(spark, sf):
    raw = F.concat(F.lit("part:brand:"), "p_brand", F.lit("| size:0| size :"), F.col("p_size").cast("string"))
    parsed = text.parse_mapping(raw, "|", trim=True)
    return table(spark, sf, "part").select("p_partkey", parsed.alias("m")).select(
        "p_partkey", F.col("m")["part:brand"].alias("brand"), F.col("m")["size"].alias("size"),
        F.size("m").alias("n"),
    )


@query(
    "parse_list",
    """
    SELECT p_partkey, list_transform(string_split(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END, ' '),
                                     lambda x: x)[1] AS first_item,
           CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE len(string_split(p_name, ' ')) + 1 END AS INTEGER) AS n
    FROM part
    """,
)
def parse_list(spark, sf):
    raw = F.when(F.col("p_partkey") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(","))
    )
    items = text.parse_list(raw, ",", trim=True)
    return table(spark, sf, "part").select(
        "p_partkey", F.try_element_at(items, F.lit(1)).alias("first_item"), F.size(items).alias("n")
    )


@query(
    "logical_schema",
    """
    SELECT event_id, 'DEV_' || CASE WHEN event_type IN ('click', 'view') THEN 'sample' ELSE event_type END AS target,
           event_type AS source
    FROM events
    """,
)
def logical_schema(spark, sf):
    kind = F.col("event_type")
    key = F.when(kind == "click", "sample1_click").when(kind == "view", "sample_view").otherwise(kind)
    names = text.logical_schema(key, "DEV_")
    return table(spark, sf, "events").select("event_id", names.alias("n")).select("event_id", "n.target", "n.source")


@query(
    "error_classify",
    """
    SELECT event_id, CASE event_id % 7
        WHEN 0 THEN 'The user does not have SELECT access' WHEN 1 THEN 'Syntax error detected in the statement'
        WHEN 2 THEN 'Out of spool space on disk' WHEN 3 THEN 'Warning' WHEN 4 THEN 'User error'
        WHEN 5 THEN 'Fatal error' END AS reason
    FROM events
    """,
)
def error_classify(spark, sf):
    k = F.col("event_id") % 7
    message = F.concat(
        F.lit("*** "),
        F.when(k == 0, "RDBMS failure, 3523").when(k == 1, "RDBMS failure, 3707")
        .when(k == 2, "RDBMS failure, 2507: Out of spool space on disk.").otherwise("done"),
    )
    code = F.when(k == 3, 4).when(k == 4, 8).when(k == 5, 12).when(k == 6, 0).otherwise(8)
    return table(spark, sf, "events").select("event_id", text.error_classify(message, code).alias("reason"))
