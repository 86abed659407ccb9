"""Large contents stored once: a table from digest to content, with a count of the values that refer to each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORE = ["digest", "content", "refs"]


def digest_of(content: Column) -> Column:
    """What a content is stored under: its SHA-256 and its length in bytes; NULL for NULL."""
    return F.concat(F.sha2(content, 256), F.lit(":"), F.octet_length(content).cast("string"))


def store_contents(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with digests in place of the contents of ``columns``, and the store ``(digest, content, refs)`` of these.

    Equal contents of any row and column are stored once; copies in one task meet before the shuffle.  NULL stays NULL
    and is not stored.
    """
    rows = df.withColumns({c: digest_of(F.col(c)) for c in columns})
    held = df.select(F.explode(F.array(*columns)).alias("content")).where(F.col("content").isNotNull())
    one = held.select(digest_of(F.col("content")).alias("digest"), "content", F.lit(1).cast("long").alias("refs"))
    return rows, _grouped(one)


def _grouped(entries: DataFrame) -> DataFrame:
    return entries.groupBy("digest").agg(F.any_value("content").alias("content"), F.sum("refs").alias("refs")).select(*STORE)


def merge_stores(store: DataFrame, more: DataFrame) -> DataFrame:
    """One store of two; contents of both are kept once."""
    return _grouped(store.select(*STORE).unionAll(more.select(*STORE)))


def release(store: DataFrame, gone: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The store after rows with digests went; contents that nothing refers to any more go too."""
    freed = gone.select(F.explode(F.array(*columns)).alias("digest")).where(F.col("digest").isNotNull())
    freed = freed.groupBy("digest").agg(F.count("*").alias("_gone"))
    left = store.join(freed, "digest", "left").withColumn("refs", F.col("refs") - F.coalesce("_gone", F.lit(0)))
    return left.where("refs > 0").select(*STORE)


def load_contents(rows: DataFrame, store: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with the contents that their digests stand for.

    A digest that the store lacks, or whose content has another digest, raises when the row is read.  Many rows may
    share one content; Spark splits such a key of the rows at run time.
    """
    for i, c in enumerate(columns):
        held = store.select(F.col("digest").alias(f"_d_{i}"), F.col("content").alias(f"_c_{i}"))
        met = rows.join(held, F.col(c) == F.col(f"_d_{i}"), "left")
        wrong = F.raise_error(F.concat(F.lit("no content for "), F.col(c))).cast("string")
        sound = digest_of(F.col(f"_c_{i}")).eqNullSafe(F.col(c))
        rows = met.select(*[
            F.when(F.col(c).isNull() | sound, F.col(f"_c_{i}")).otherwise(wrong).alias(c) if n == c else F.col(n) for n in rows.columns])
    return rows
