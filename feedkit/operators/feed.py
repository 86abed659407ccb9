"""Repairs of dirty delimited lines.

Lines are rows ``(file, [block,] line_no, value)``.  A step that can refuse a line adds
``kind`` and ``reason``; nothing is dropped on the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions import text
from feedkit.operators import bytecut
from feedkit.plans.once import compute_once

cloudpickle.register_pickle_by_value(bytecut)

Limits = Mapping[int, int]


def replace_chars(df: DataFrame, column: str, mapping: Mapping[text.BytesLike, text.BytesLike]) -> DataFrame:
    """Literal replacement in a column, longest key first."""
    return df.withColumn(column, text.replace_mapping(F.col(column), mapping))


def _field_checks(limits: Limits, fields: Column) -> Column:
    """Reason why a line cannot be handled, or NULL: it lacks a field the limits name."""
    need = max(limits) + 1
    lacking = F.concat(F.lit(f"has no field {need - 1}, only "), F.size(fields).cast("string"))
    return F.when(F.size(fields) < need, lacking)


def truncate_columns(lines: DataFrame, delimiter: str, limits: Limits, column: str = "value") -> DataFrame:
    """Cut field ``i`` to ``limits[i]`` characters, dropping bytes that are no text.

    Adds ``kind`` and ``reason``: a line that lacks a field keeps its value as ``error``.
    """
    if not limits:
        return lines.withColumns({"kind": F.lit("good"), "reason": F.lit(None).cast("string")})

    def cut(field, i):
        out = field
        for at, n in limits.items():
            out = F.when(i == at, F.substring(text.decodable(field), 1, n)).otherwise(out)
        return out

    fields = F.col("_fields")
    reason = _field_checks(limits, fields)
    short = F.array_join(F.transform(fields, cut), delimiter)
    return (
        compute_once(lines, "_fields", text.raw_fields(F.col(column), delimiter))
        .withColumn("reason", reason)
        .withColumn("kind", F.when(F.col("reason").isNull(), "good").otherwise("error"))
        .withColumn(column, F.when(F.col("reason").isNull(), short).otherwise(F.col(column)))
        .drop("_fields")
    )


def remove_mbc(df: DataFrame, column: str, prefixes: Mapping[text.BytesLike, int]) -> DataFrame:
    """For each prefix cut that many bytes at its first place, and again until none is left.

    The order of cuts matters, so this is a loop over the bytes of a value; only values
    that hold a prefix leave the JVM.
    """
    rules = [(text.as_bytes(p), int(n)) for p, n in prefixes.items()]
    for prefix, n in rules:
        if n <= 0 or not prefix:
            raise ValueError(f"cannot cut {n} bytes at {prefix!r}")
    if not rules:
        return df
    raw = F.col(column).cast("binary")
    holds = F.lit(False)
    for prefix, _ in rules:
        holds = holds | F.contains(raw, F.lit(prefix))
    cut = F.pandas_udf(bytecut.cutter(rules), "binary")
    return (
        df.withColumn("_dirty", F.when(holds, raw))
        .withColumn("_clean", cut("_dirty").cast("string"))
        .withColumn(column, F.when(F.col("_dirty").isNull(), F.col(column)).otherwise(F.col("_clean")))
        .drop("_dirty", "_clean")
    )


def mark_over_length(lines: DataFrame, delimiter: str, limits: Limits, column: str = "value") -> DataFrame:
    """Adds ``kind`` (``good``, ``over``, ``error``) and ``reason``: ``over`` has a field of
    more bytes than its limit."""
    if not limits:
        return lines.withColumns({"kind": F.lit("good"), "reason": F.lit(None).cast("string")})
    fields = F.col("_fields")
    over = F.lit(False)
    for at, n in limits.items():
        over = over | (F.octet_length(F.get(fields, F.lit(at))) > n)
    return (
        compute_once(lines, "_fields", text.raw_fields(F.col(column), delimiter))
        .withColumn("reason", _field_checks(limits, fields))
        .withColumn("kind", F.when(F.col("reason").isNotNull(), "error").when(over, "over").otherwise("good"))
        .drop("_fields")
    )


def split_over_length(lines: DataFrame, delimiter: str, limits: Limits,
                      column: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Normal, over-length and refused lines."""
    marked = mark_over_length(lines, delimiter, limits, column)
    plain = marked.drop("kind", "reason")
    return (
        plain.where(marked["kind"] == "good"),
        plain.where(marked["kind"] == "over"),
        marked.where("kind = 'error'").drop("kind"),
    )


def externalize_lobs(lines: DataFrame, delimiter: str, limits: Limits, keys: Sequence[str] = ("file", "block", "line_no"),
                     column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Replace every field the limits name by a reference; contents go to a side table.

    ``keys`` must identify a line.  The side table is ``(lob_id, keys..., field, content)``.
    """
    key_text = [F.col(k).cast("string") for k in keys]

    def reference(at):
        return F.sha2(F.concat_ws("\x1f", *key_text, at.cast("string")), 256)

    wanted = sorted(limits)
    split = compute_once(lines, "_fields", text.raw_fields(F.col(column), delimiter))
    swapped = F.transform("_fields", lambda f, i: F.when(i.isin(wanted), reference(i)).otherwise(f))
    rows = split.withColumn(column, F.array_join(swapped, delimiter)).drop("_fields")
    contents = F.array(*[F.struct(F.lit(at).alias("field"), F.get("_fields", F.lit(at)).alias("content")) for at in wanted])
    lobs = split.select(*keys, F.explode(contents).alias("_c")).select(
        reference(F.col("_c.field")).alias("lob_id"), *keys, "_c.field", "_c.content",
    )
    return rows, lobs


def externalize_by_key(df: DataFrame, keys: Sequence[str], lob_columns: Sequence[str],
                       table: str) -> tuple[DataFrame, DataFrame]:
    """Replace declared large columns by ``<table>_<key values>_<column>``; contents go to a
    side table ``(lob_id, keys..., column, content)``.  ``keys`` must identify a row.

    ``_`` and the backslash inside a key value get a backslash and a NULL is ``\\N``, so no two keys share a reference.
    """
    def part(k):
        value = F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("_"), F.lit("\\_"))
        return F.coalesce(value, F.lit("\\N"))

    def reference(column):
        return F.concat_ws("_", F.lit(table), *[part(k) for k in keys], column)

    rows = df.withColumns({c: reference(F.lit(c)) for c in lob_columns})
    lobs = (
        df.select(*keys, *lob_columns)
        .unpivot(list(keys), list(lob_columns), "column", "content")
        .select(reference(F.col("column")).alias("lob_id"), *keys, "column", "content")
    )
    return rows, lobs
