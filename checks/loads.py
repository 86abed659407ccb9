"""Loads: staging, rejects, merges, key joins, table copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.feeds import ORDER_SCHEMA, plain_orders
from checks.registry import query, table
from feedkit.operators import keys, load, publish, reports, tables
from feedkit.plans.load_job import LoadSpec, tag_rows
from feedkit.plans.storage import materialize, scratch_database


def order_lines(spark, sf):
    """Orders as delimited lines, some of which do not fit the table."""
    k = F.col("o_orderkey")
    price = F.when(k % 97 == 0, "n/a").when(k % 103 == 0, "").otherwise(F.col("o_totalprice").cast("string"))
    date = F.when(k % 89 == 0, "1997-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", price, date]
    tail = F.when(k % 101 == 0, F.lit("")).otherwise(F.concat(F.lit("|"), "o_orderpriority"))
    return plain_orders(spark, sf).select(
        F.col("o_orderstatus").alias("file"), F.lit(0).cast("bigint").alias("block"), k.alias("line_no"),
        F.concat(F.concat_ws("|", *fields), tail).alias("value"),
    )


REASON_SQL = """
    CASE WHEN o_orderkey % 101 = 0 THEN '5 fields, not 6'
         ELSE nullif(concat_ws('; ', CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice: not decimal(18,2)' END,
              CASE WHEN o_orderkey % 89 = 0 THEN 'o_orderdate: not timestamp_ntz' END), '') END
"""
STAGED_SQL = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 103 = 0 THEN NULL
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS o_totalprice,
           o_orderdate, o_orderpriority, {REASON_SQL} AS reason
    FROM orders
"""


@query(
    "stage_typed",
    f"""
    SELECT o_orderkey AS line_no, reason, CASE WHEN reason IS NULL THEN o_orderkey END AS o_orderkey,
           CASE WHEN reason IS NULL THEN o_totalprice END AS o_totalprice,
           CASE WHEN reason IS NULL THEN o_orderdate END AS o_orderdate,
           CASE WHEN reason IS NULL THEN o_orderpriority END AS o_orderpriority
    FROM ({STAGED_SQL})
    """,
)
def stage_typed(spark, sf):
    tagged = load.typed_lines(order_lines(spark, sf), "|", ORDER_SCHEMA)
    fits = F.col("reason").isNull()
    typed = [F.when(fits, F.col(c)).alias(c) for c in ("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")]
    return tagged.select("line_no", "reason", *typed)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@query(
    "unique_violations",
    f"""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1 AS kept
    FROM lineitem
    """,
)
def unique_violations(spark, sf):
    # The table has no line number, so every other column tells rows apart.
    marked = load.mark_first(table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER + LINE_KEY)
    return marked.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", F.col("_first").alias("kept")
    )


@query(
    "duplicate_rows",
    """
    SELECT l_returnflag, l_linestatus, l_quantity, min(l_shipdate) AS l_shipdate, count(*) AS copies
    FROM lineitem GROUP BY ALL
    """,
)
def duplicate_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")
    return load.duplicate_rows(rows, order=["l_shipdate"])


# All orders are in the target and all are staged again with a new price, but a third of the
# target's keys and half of the staged keys are others, and some are NULL on either side.
def target_orders(spark, sf):
    k = F.col("o_orderkey")
    key = F.when(k % 3 == 0, -k).when(k % 500 != 1, k)
    return plain_orders(spark, sf).withColumn("o_orderkey", key)


def staged_orders(spark, sf):
    k = F.col("o_orderkey")
    key = F.when(k % 2 == 1, k + 1000000000000).when(k % 1000 != 2, k)
    price = (F.col("o_totalprice") + 1).cast("decimal(18,2)")
    return plain_orders(spark, sf).withColumns({"o_totalprice": price, "o_orderkey": key})


ORDER_COLUMNS = "o_custkey, o_orderstatus, CAST(o_totalprice {} AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority"
TARGET_SQL = f"""
    SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey WHEN o_orderkey % 500 <> 1 THEN o_orderkey END AS o_orderkey,
           {ORDER_COLUMNS.format("")} FROM orders
"""
CHANGED_SQL = f"""
    SELECT CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey + 1000000000000
                WHEN o_orderkey % 1000 <> 2 THEN o_orderkey END AS o_orderkey,
           {ORDER_COLUMNS.format("+ 1")} FROM orders
"""
MATCH_SQL = f"(SELECT 1 FROM ({CHANGED_SQL}) s WHERE s.o_orderkey = t.o_orderkey)"


@query("delete_by_keys", f"SELECT * FROM ({TARGET_SQL}) t WHERE NOT EXISTS {MATCH_SQL}")
def delete_by_keys(spark, sf):
    return keys.delete_by_keys(target_orders(spark, sf), staged_orders(spark, sf), ["o_orderkey"])


@query("rows_to_replace", f"SELECT * FROM ({TARGET_SQL}) t WHERE EXISTS {MATCH_SQL}")
def rows_to_replace(spark, sf):
    return keys.rows_to_replace(target_orders(spark, sf), staged_orders(spark, sf), ["o_orderkey"])


@query(
    "upsert_by_key",
    f"SELECT * FROM ({TARGET_SQL}) t WHERE NOT EXISTS {MATCH_SQL} UNION ALL SELECT * FROM ({CHANGED_SQL})",
)
def upsert_by_key(spark, sf):
    return load.upsert_by_key(target_orders(spark, sf), staged_orders(spark, sf), ["o_orderkey"])


@query(
    "publish_upsert",
    f"SELECT * FROM ({TARGET_SQL}) t WHERE NOT EXISTS {MATCH_SQL} UNION ALL SELECT * FROM ({CHANGED_SQL})",
)
def publish_upsert(spark, sf):
    # through a partitioned table, and a second time with the same stamp
    name = f"{scratch_database(spark)}.orders_t"
    columns = [*[c for c in target_orders(spark, sf).columns if c != "o_orderstatus"], "o_orderstatus"]
    target_orders(spark, sf).select(*columns).write.partitionBy("o_orderstatus").saveAsTable(name)
    first = staged_orders(spark, sf)
    publish.publish_upsert(spark, name, first, ["o_orderkey"], "199701010000")
    named = first.where("o_orderkey IS NOT NULL")
    publish.publish_upsert(spark, name, named, ["o_orderkey"], "199701010000")
    assert publish.partition_columns(spark, name) == ["o_orderstatus"]
    return spark.table(name)


@query(
    "tuple_in_filter",
    """
    SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem
    WHERE (l_returnflag, l_suppkey) IN (SELECT l_returnflag, l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_tax = 0)
    """,
)
def tuple_in_filter(spark, sf):
    lines = table(spark, sf, "lineitem")
    other = lines.where("l_quantity >= 50 AND l_tax = 0")
    kept = keys.tuple_in_filter(lines, other, ["l_returnflag", "l_suppkey"])
    return kept.select("l_orderkey", "l_suppkey", "l_quantity")


# Right list: some orders moved by one place, some replaced, some at places the left list lacks.
LEFT_SQL = "SELECT o_orderkey AS place, o_orderkey * 10 AS item FROM orders"
RIGHT_SQL = """
    SELECT CASE WHEN o_orderkey % 60 = 11 THEN -o_orderkey ELSE o_orderkey END AS place,
        CASE WHEN o_orderkey % 50 = 7 THEN -o_orderkey WHEN o_orderkey % 40 = 3 THEN o_orderkey * 10 + 10
             ELSE o_orderkey * 10 END AS item
    FROM orders
"""


RECONCILED_SQL = f"""
    WITH l AS ({LEFT_SQL}), r AS ({RIGHT_SQL})
    SELECT l.place, l.item, CASE WHEN l.item = r.item THEN 'same'
           WHEN l.item IN (SELECT item FROM r) THEN 'moved' ELSE 'only_left' END AS status
    FROM l LEFT JOIN r ON l.place = r.place
    UNION ALL SELECT place, item, 'only_right' FROM r WHERE item NOT IN (SELECT item FROM l)
"""


def two_lists(spark, sf):
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    left = orders.select(k.alias("place"), (k * 10).alias("item"))
    item = F.when(k % 50 == 7, -k).when(k % 40 == 3, k * 10 + 10).otherwise(k * 10)
    right = orders.select(F.when(k % 60 == 11, -k).otherwise(k).alias("place"), item.alias("item"))
    return left, right


@query("reconcile", RECONCILED_SQL)
def reconcile(spark, sf):
    return keys.reconcile(*two_lists(spark, sf), ["item"], "place")


@query("reconcile_ranges", RECONCILED_SQL)
def reconcile_ranges(spark, sf):
    return keys.reconcile_ranges(*two_lists(spark, sf), ["item"], "place", width=25)


@query(
    "list_tests",
    """
    WITH c AS (SELECT unnest(['itself', 'its beginning', 'another']) AS of)
    SELECT of, of = 'itself' AS equal, of <> 'another' AS prefix FROM c WHERE (SELECT count(*) FROM orders) > 10
    """,
)
def list_tests(spark, sf):
    left, other = two_lists(spark, sf)
    cases = {"itself": (left, left), "its beginning": (left.where("place < 10"), left), "another": (left, other)}
    rows = [
        keys.list_tests(keys.reconcile_ranges(a, b, ["item"], "place", width=1000), a, b).select(F.lit(of).alias("of"), "equal", "prefix")
        for of, (a, b) in cases.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def stats_sql(name: str, columns: list[str]) -> str:
    parts = [
        f"SELECT {i + 1} AS ordinal, '{c}' AS col, '{kind}' AS type, count(*) AS rows FROM {name}"
        for i, (c, kind) in enumerate(columns)
    ]
    return " UNION ALL ".join(parts)


ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")]


@query(
    "schema_pairing",
    f"""
    SELECT s.ordinal, s.col AS "column", s.rows, t.col AS target_column, t.type AS target_type, t.rows AS target_rows
    FROM ({stats_sql("orders", ORDER_TYPES)}) s JOIN ({stats_sql("events", EVENT_TYPES)}) t USING (ordinal)
    """,
)
def schema_pairing(spark, sf):
    stats = [reports.column_stats(table(spark, sf, t)).select("ordinal", "column", "type", "rows") for t in ("orders", "events")]
    return keys.schema_pairing(stats[0].drop("type"), stats[1])


@query(
    "missing_feeds",
    """
    SELECT n_nationkey AS nation, d.day FROM nation,
           (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders) d
    WHERE (n_nationkey, d.day) NOT IN (
        SELECT c_nationkey, CAST(o_orderdate AS DATE) FROM orders JOIN customer ON o_custkey = c_custkey)
    """,
)
def missing_feeds(spark, sf):
    span = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.explode(F.expr("array(1)")).alias("one"))
    expected = nations.join(span.withColumn("one", F.lit(1)), "one").select("nation", F.explode(F.sequence("a", "b")).alias("day"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    present = table(spark, sf, "orders").join(customers, "o_custkey").select(
        "nation", F.col("o_orderdate").cast("date").alias("day")
    )
    return keys.missing_feeds(expected, present, ["nation", "day"])


@query(
    "missing_feeds_by_pattern",
    """
    WITH e AS (SELECT DISTINCT c_nationkey || '.' || c_mktsegment AS section,
                      CASE WHEN c_nationkey % 4 = 1 THEN '*' ELSE '' END || 'N' || c_nationkey || '_' || c_mktsegment || '_*[0-6]7.csv'
                      || CASE WHEN c_nationkey % 4 = 2 THEN '*' ELSE '' END AS pattern FROM customer
               UNION ALL SELECT 'open' || c_nationkey, 'N' || c_nationkey || '[_*' FROM customer GROUP BY c_nationkey
               UNION ALL SELECT 'any' || c_nationkey, '*N' || c_nationkey || '_*_1*' FROM customer GROUP BY c_nationkey),
         p AS (SELECT 'N' || c_nationkey || '_' || c_mktsegment || '_' || c_custkey || '.csv' AS name FROM customer)
    SELECT section, pattern FROM e WHERE section LIKE 'open%' OR NOT EXISTS (SELECT 1 FROM p WHERE p.name GLOB e.pattern)
    """,
)
def missing_feeds_by_pattern(spark, sf):
    customers = table(spark, sf, "customer")
    stem = F.concat(F.lit("N"), "c_nationkey", F.lit("_"), "c_mktsegment", F.lit("_"))
    kind = F.col("c_nationkey") % 4
    expected = customers.select(
        F.concat_ws(".", "c_nationkey", "c_mktsegment").alias("section"),
        F.concat(F.when(kind == 1, "*").otherwise(""), stem, F.lit("*[0-6]7.csv"), F.when(kind == 2, "*").otherwise("")).alias("pattern"),
    ).distinct()
    # a bracket that is never closed, and patterns with wildcards at both ends
    nation = customers.select("c_nationkey").distinct()
    for label, before, after in (("open", "N", "[_*"), ("any", "*N", "_*_1*")):
        expected = expected.unionAll(nation.select(
            F.concat(F.lit(label), "c_nationkey"), F.concat(F.lit(before), "c_nationkey", F.lit(after))))
    present = customers.select(F.concat(stem, "c_custkey", F.lit(".csv")).alias("name"))
    return keys.missing_feeds_by_pattern(expected, present)


@query("full_refresh_swap", f"SELECT * FROM ({CHANGED_SQL})")
def full_refresh_swap(spark, sf):
    name = f"{scratch_database(spark)}.orders_t"
    publish.full_refresh_swap(spark, name, target_orders(spark, sf), "199701010000")
    publish.full_refresh_swap(spark, name, staged_orders(spark, sf), "199701020000")
    return spark.table(name)


@query("full_refresh_rewrite", f"SELECT * FROM ({CHANGED_SQL})")
def full_refresh_rewrite(spark, sf):
    name = f"{scratch_database(spark)}.orders_t"
    target_orders(spark, sf).write.saveAsTable(name)
    load.full_refresh_rewrite(name, staged_orders(spark, sf))
    return spark.table(name)


def triple_lines(spark, sf):
    """Every order line, the same line again, and once more with another customer."""
    lines = order_lines(spark, sf)
    changed = F.regexp_replace("value", r"^([0-9]+)\|[0-9]+", "$1|-1")
    copies = F.posexplode(F.array("value", "value", changed)).alias("copy", "text")
    return lines.select("file", "line_no", copies).select(
        "file", F.col("copy").cast("bigint").alias("block"), "line_no", F.col("text").alias("value")
    )


@query(
    "load_metrics",
    f"""
    WITH s AS ({STAGED_SQL}), good AS (SELECT o_orderkey FROM s WHERE reason IS NULL)
    SELECT count(*) * 3 AS rows_read, count(*) FILTER (reason IS NULL) AS applied, count(reason) * 3 AS et,
           count(*) FILTER (reason IS NULL) AS uv, count(*) FILTER (reason IS NULL) AS duplicates,
           (SELECT count(*) FROM ({TARGET_SQL}) t WHERE o_orderkey IN (SELECT o_orderkey FROM good)) AS deleted,
           'failed' AS status
    FROM s
    """,
)
def load_metrics(spark, sf):
    spec = LoadSpec(ORDER_SCHEMA, ["o_orderkey"], delimiter="pipe")
    tagged = materialize(tag_rows(triple_lines(spark, sf), spec))
    good = tagged.where("kind = 'good'").select(*ORDER_SCHEMA.fieldNames())
    deleted = keys.rows_to_replace(target_orders(spark, sf), good, ["o_orderkey"])
    return load.load_metrics(tagged, deleted)


@query(
    "reject_snapshot",
    f"SELECT 'orders_t_tmp_et_199701010000' AS name, o_orderkey AS line_no, reason FROM ({STAGED_SQL}) WHERE reason IS NOT NULL",
)
def reject_snapshot(spark, sf):
    base = scratch_database(spark)
    _, et = load.stage_typed(order_lines(spark, sf), "|", ORDER_SCHEMA)
    names = load.reject_snapshot(spark, {"et": et, "uv": None}, f"{base}.orders_t", "199701010000")
    return spark.table(names[0]).select(F.lit(names[0].split(".")[1]).alias("name"), "line_no", "reason")


@query(
    "reject_preview",
    f"""
    WITH et AS (SELECT o_orderkey AS line_no, reason FROM ({STAGED_SQL}) WHERE reason IS NOT NULL),
         uv AS (SELECT o_orderkey AS line_no FROM orders)
    SELECT * FROM (SELECT 'et' AS kind, (SELECT count(*) FROM et) AS total, line_no,
                   '{{"reason":"' || reason || '"}}' AS row FROM et ORDER BY line_no LIMIT 200)
    UNION ALL
    SELECT * FROM (SELECT 'uv', (SELECT count(*) FROM uv), line_no,
                   '{{"o_orderkey":' || CAST(line_no AS VARCHAR) || '}}' FROM uv ORDER BY line_no LIMIT 200)
    """,
)
def reject_preview(spark, sf):
    _, et = load.stage_typed(order_lines(spark, sf), "|", ORDER_SCHEMA)
    uv = table(spark, sf, "orders").select(F.col("o_orderkey").alias("line_no"), "o_orderkey")
    return load.reject_preview(et.select("line_no", "reason"), uv, ["line_no"], 200)


@query(
    "single_batch_guard",
    "SELECT count(DISTINCT p_brand || '_' || p_type) AS stems FROM part",
)
def single_batch_guard(spark, sf):
    ending = F.when(F.col("p_size") > 25, ".lob").otherwise(".txt.gz")
    named = table(spark, sf, "part").select(F.concat("p_brand", F.lit("_"), "p_type", ending).alias("file"))
    return load.batch_stems(named)


CANDIDATES = [["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"], ["l_discount"]]


def candidate_sql(i: int, columns: list[str]) -> str:
    # l_discount counts as NULL where it is 0.
    names = ["nullif(l_discount, 0)" if c == "l_discount" else c for c in columns]
    null = " OR ".join(f"{n} IS NULL" for n in names)
    return f"""
        SELECT {i + 1} AS rank, '{",".join(columns)}' AS candidate, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys,
               CAST(coalesce(sum(n) FILTER (missing), 0) AS BIGINT) AS null_rows,
               sum(n) = count(*) AND coalesce(sum(n) FILTER (missing), 0) = 0 AS is_key
        FROM (SELECT count(*) AS n, bool_or({null}) AS missing FROM lineitem GROUP BY {", ".join(names)})
    """


@query("key_discovery", " UNION ALL ".join(candidate_sql(i, c) for i, c in enumerate(CANDIDATES)))
def key_discovery(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    return load.key_discovery(lines, CANDIDATES)


@query(
    "clone_table",
    "SELECT 'copy' AS of, * FROM part UNION ALL SELECT 'empty', * FROM part WHERE false",
)
def clone_table(spark, sf):
    base = scratch_database(spark)
    table(spark, sf, "part").write.saveAsTable(f"{base}.part_t")
    tables.clone_table(spark, f"{base}.part_t", f"{base}.part_copy", with_data=True)
    tables.clone_table(spark, f"{base}.part_t", f"{base}.part_empty")
    sides = [spark.table(f"{base}.part_{n}").select(F.lit(n).alias("of"), "*") for n in ("copy", "empty")]
    return sides[0].unionAll(sides[1])


@query(
    "templated_sql",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderpriority = '1-URGENT' GROUP BY 1",
)
def templated_sql(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("feedkit_orders")
    return tables.run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n FROM IDENTIFIER(:t) "
        "WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderpriority = :priority GROUP BY 1",
        {"t": "feedkit_orders", "since": "1997-01-01", "priority": "1-URGENT"},
    )
