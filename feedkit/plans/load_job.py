"""The load job: lines in, table and reject tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text
from feedkit.operators import keys as key_joins
from feedkit.operators import load, publish
from feedkit.plans.storage import materialize


@dataclass(frozen=True)
class LoadSpec:
    """What one table's load takes."""

    schema: T.StructType
    keys: Sequence[str] = ()
    delimiter: str = text.DEFAULT_DELIMITER
    mode: str = "upsert"
    candidates: Sequence[Sequence[str]] = ()


def tag_rows(lines: DataFrame, spec: LoadSpec) -> DataFrame:
    """All lines, typed and tagged: ``kind`` is good, et, uv or duplicate.  Runs at once.

    A row equal to an earlier one is a duplicate; another row with a key that is taken violates uniqueness.  One hash
    aggregate by key and content (two 64-bit hashes) finds firsts and copies; rows meet only the groups that come again.
    Lines are neither sorted nor written, and are parsed twice: for the groups, dealt out evenly, and for the rows.
    """
    order = load.LINE_KEY
    names, key = spec.schema.fieldNames(), list(spec.keys)
    placed, n = load.in_place(lines)
    rows, slices = [
        load.typed_lines(part, text.delimiter_of(spec.delimiter), spec.schema)
        .withColumns({"_hash": F.xxhash64(*names), "_more": F.xxhash64(F.lit(1), *names)})
        for part in (placed, load.dealt(placed, n))
    ]
    groups = slices.where("reason IS NULL").groupBy(*key, "_hash", "_more").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    again = groups.groupBy(*key).agg(F.min("_first").alias("_first"), F.sum("_n").alias("_n")).where("_n > 1")
    met = _meet(rows, again, key, "_key_first")
    met = _meet(met, groups.where("_n > 1"), [*key, "_hash", "_more"], "_row_first")
    kind = (
        F.when(F.col("reason").isNotNull(), "et").when(F.col("_row_first") < F.col("_id"), "duplicate")
        .when(F.col("_key_first") < F.col("_id"), "uv").otherwise("good")
    )
    return met.select(*order, *names, "reason", "value", kind.alias("kind"))


def _meet(rows: DataFrame, firsts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Adds the least ``_id`` of a row's group, NULL where it is the only one."""
    named = firsts.select(F.col("_first").alias(name), *[F.col(c).alias(f"_k_{i}_{name}") for i, c in enumerate(keys)])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{i}_{name}")) for i, c in enumerate(keys)]
    return rows.join(named, same, "left").select(*rows.columns, name)


def load_table(spark: SparkSession, table: str, lines: DataFrame, spec: LoadSpec, stamp: str) -> DataFrame:
    """Load lines into a catalog table, keep the rejects, return the metrics.  Runs at once.

    Rejects are kept before the table changes, and a second try of the same stamp replaces them.  Without ``keys``
    the first of ``candidates`` that is a key of the good rows is taken.
    """
    if spec.mode == "full":
        load.assert_single_batch(lines)
    if not spec.keys:
        fits = load.typed_lines(lines, text.delimiter_of(spec.delimiter), spec.schema).where("reason IS NULL")
        spec = replace(spec, keys=load.discover_key(fits.select(*spec.schema.fieldNames()).distinct(), spec.candidates))
    tagged = materialize(tag_rows(lines, spec))
    return load.load_metrics(tagged, load_tagged(spark, table, tagged, spec, stamp))


def _digest(rows: DataFrame) -> str:
    """What tells one set of rows from another, in any order: their number and the sum of their hashes.  Runs at once."""
    total = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    return "/".join(str(v) for v in rows.agg(F.count("*"), F.coalesce(total, F.lit(0))).first())


def load_tagged(spark: SparkSession, table: str, tagged: DataFrame, spec: LoadSpec, stamp: str) -> int:
    """Keep the rejects of tagged rows, put the good ones into the table, return how many rows they replaced.  Runs at once.

    A try that broke off is finished or undone first.  If the same rows were published under this stamp already the table
    stays as it is, and the number is the one of then.
    """
    names = spec.schema.fieldNames()
    good = tagged.where("kind = 'good'").select(*names)
    rejects = {
        "et": tagged.where("kind = 'et'").select(*load.LINE_KEY, "value", "reason"),
        "uv": tagged.where("kind = 'uv'").select(*load.LINE_KEY, *names),
    }
    load.reject_snapshot(spark, rejects, table, stamp)
    digest = _digest(good)
    if done := publish.is_published(spark, table, stamp, {"digest": digest}):
        return done["replaced"]
    if spec.mode == "full":
        publish.full_refresh_swap(spark, table, good, stamp, {"digest": digest, "replaced": 0})
        return 0
    replaced = key_joins.rows_to_replace(spark.table(table), good, spec.keys).count()
    publish.publish_upsert(spark, table, good, spec.keys, stamp, {"digest": digest, "replaced": replaced})
    return replaced
