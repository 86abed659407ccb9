"""Reports, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from feedkit.operators import order, reports


@query(
    "skew_report",
    """
    SELECT l_returnflag, l_suppkey, round(stddev_pop(l_extendedprice) / avg(l_extendedprice), 6) AS bias,
           round(min(l_extendedprice) / max(l_extendedprice), 6) AS min_max_ratio,
           round(sum(l_extendedprice) / 1024 / 1024, 6) AS size_mb, max(l_extendedprice) AS max_unit
    FROM lineitem WHERE l_linestatus NOT LIKE 'F%' GROUP BY 1, 2
    """,
)
def skew_report(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_linestatus NOT LIKE 'F%'")
    report = reports.skew_report(lines, ["l_returnflag", "l_suppkey"], "l_extendedprice")
    return report.withColumns({c: F.round(c, 6) for c in ("bias", "min_max_ratio", "size_mb")})


@query(
    "size_report",
    """
    SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS size,
           grouping(l_suppkey) = 1 AS is_total
    FROM (SELECT * REPLACE (nullif(l_suppkey, 3) AS l_suppkey) FROM lineitem) GROUP BY ROLLUP (l_suppkey)
    """,
)
def size_report(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns({
        "l_extendedprice": F.col("l_extendedprice").cast("decimal(18,2)"), "l_suppkey": F.nullif("l_suppkey", F.lit(3)),
    })
    return reports.size_report(lines, "l_suppkey", "l_extendedprice")


@query(
    "usage_report",
    """
    SELECT l_suppkey, sum(cur) AS sum_current, sum(most) AS sum_max, sum(peak) AS sum_peak,
           CAST(CASE WHEN sum(cur) = 0 THEN 0 ELSE sum(cur) / sum(most) * 100 END AS DECIMAL(18,1)) AS usage,
           (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS groups
    FROM (SELECT l_suppkey, CASE WHEN l_suppkey % 10 = 0 THEN 0 WHEN l_suppkey % 10 = 1 THEN l_quantity * 1000 ELSE l_quantity END AS cur,
                 l_quantity * 2 + l_linenumber AS most, l_quantity * 3 AS peak FROM lineitem)
    GROUP BY 1
    """,
)
def usage_report(spark, sf):
    q = F.col("l_quantity")
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_suppkey") % 10 == 0, 0.0).when(F.col("l_suppkey") % 10 == 1, q * 1000).otherwise(q).alias("cur"),
        (q * 2 + F.col("l_linenumber")).alias("most"), (q * 3).alias("peak"),
    )
    return reports.usage_report(lines, "l_suppkey", "cur", "most", "peak")


@query("distinct_by_group", "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem")
def distinct_by_group(spark, sf):
    return reports.distinct_sorted(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_tax"])


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return reports.row_count(table(spark, sf, "lineitem"))


@query(
    "ordered_list_agg",
    "SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS items FROM conversations GROUP BY 1",
)
def ordered_list_agg(spark, sf):
    return reports.ordered_list_agg(table(spark, sf, "conversations"), ["conv_id"], "turn", "role", piece=2)


def column_sql(ordinal: int, name: str, kind: str) -> str:
    return f"""
        SELECT CAST({ordinal} AS INTEGER) AS ordinal, '{name}' AS "column", '{kind}' AS type, count(*) AS rows,
               count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS distinct_values,
               CAST(min({name}) AS VARCHAR) AS low, CAST(max({name}) AS VARCHAR) AS high
        FROM (SELECT * REPLACE (nullif(o_orderstatus, 'F') AS o_orderstatus),
                     '[' || o_orderstatus || ', ' || o_orderpriority || ']' AS pair FROM orders)
    """


STAT_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"), ("pair", "array<string>")]


@query("column_stats", " UNION ALL ".join(column_sql(i + 1, n, k) for i, (n, k) in enumerate(STAT_COLUMNS)))
def column_stats(spark, sf):
    orders = table(spark, sf, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("F")), "pair": F.array("o_orderstatus", "o_orderpriority"),
    })
    return reports.column_stats(orders, [n for n, _ in STAT_COLUMNS])


def sketch_sql(ordinal: int, name: str, kind: str) -> str:
    number = kind in ("bigint", "timestamp_ntz")
    return f"SELECT ordinal, \"column\", type, rows, nulls, low, high, true AS distinct_near, {str(number).lower()} AS has_quantiles FROM ({column_sql(ordinal, name, kind)})"


@query("column_sketches", " UNION ALL ".join(sketch_sql(i + 1, n, k) for i, (n, k) in enumerate(STAT_COLUMNS)))
def column_sketches(spark, sf):
    # statistics of two batches, merged, against exact counts of the whole
    orders = table(spark, sf, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("F")), "pair": F.array("o_orderstatus", "o_orderpriority"),
    })
    names = [n for n, _ in STAT_COLUMNS]
    batches = [orders.where("o_custkey % 3 = 0"), orders.where("o_custkey % 3 <> 0")]
    merged = reports.merge_sketches(batches_of(batches, names), orders.select(*names).schema)
    exact = reports.column_stats(orders, names).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * (4 * reports.DISTINCT_ERROR)
    return reports.read_sketches(merged).join(exact, "column").select(
        "ordinal", "column", "type", "rows", "nulls", "low", "high", near.alias("distinct_near"), F.col("quantiles").isNotNull().alias("has_quantiles"))


def batches_of(frames, names):
    parts = [reports.column_sketches(df, names) for df in frames]
    return parts[0].unionAll(parts[1])


@query(
    "order_multi",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS rank
    FROM orders
    """,
)
def order_multi(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return order.with_rank(orders, [("o_orderstatus", "asc"), (3, "desc"), ("o_orderkey", "asc")])


@query(
    "top_n",
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def top_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return order.top_n(orders, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 100)


@query("union_distinct", "SELECT l_returnflag AS a, l_tax AS b FROM lineitem UNION SELECT o_orderstatus, 0 FROM orders")
def union_distinct(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("a"), F.col("l_tax").alias("b"))
    b = table(spark, sf, "orders").select("o_orderstatus", F.lit(0.0))
    return order.union_distinct(a, b)


@query("append_rows", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_rows(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return order.append_rows(customers, table(spark, sf, "supplier").select("s_suppkey", "s_name"))


@query(
    "run_report",
    """
    SELECT source AS feed, count(*) FILTER (n_chars <= 9000) AS good, count(*) FILTER (n_chars > 9000) AS error,
           CASE WHEN count(*) FILTER (n_chars > 9000) > 0 THEN 1 ELSE 0 END AS failed,
           CASE WHEN count(*) FILTER (n_chars > 9000) > 0 THEN 'failed' ELSE 'ok' END AS status, false AS is_total
    FROM (SELECT * REPLACE (nullif(source, 'src3') AS source) FROM documents) GROUP BY 1
    UNION ALL
    SELECT NULL, count(*) FILTER (n_chars <= 9000), count(*) FILTER (n_chars > 9000),
           count(DISTINCT CASE WHEN n_chars > 9000 THEN source END),
           CASE WHEN count(*) FILTER (n_chars > 9000) > 0 THEN 'failed' ELSE 'ok' END, true
    FROM documents
    """,
)
def run_report(spark, sf):
    kind = F.when(F.col("n_chars") > 9000, "error").otherwise("good")
    tagged = table(spark, sf, "documents").select(
        F.nullif("source", F.lit("src3")).alias("feed"), kind.alias("kind"))
    return reports.run_report(tagged)
