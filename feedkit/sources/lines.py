"""Text feeds as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import text
from feedkit.operators.keys import join_small
from feedkit.plans.once import compute_once


# Charsets that Spark reads without its legacy setting.
PLAIN_CHARSETS = {"UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32", "ISO-8859-1", "US-ASCII"}


def charset_name(spark: SparkSession, charset: str | None) -> str:
    """Java's name of a charset; one that Spark refuses in this session is an error."""
    if not charset:
        return "UTF-8"
    wanted = {"UTF8": "UTF-8", "SJIS": "SHIFT_JIS"}.get(charset.upper(), charset.upper())
    if wanted not in PLAIN_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        raise ValueError(f"charset {charset} needs spark.sql.legacy.javaCharsets=true")
    return wanted


def scan_lines(spark: SparkSession, path: str | Sequence[str], charset: str | None = None, **options: str) -> DataFrame:
    """Lines of text files as ``(file, block, line_no, value)``.

    With a ``charset`` other than UTF-8 each line is decoded by itself, so that all steps on lines count and cut
    its characters.  Every charset of Java works in which LF cannot be part of another character's bytes, as in
    Shift_JIS, and UTF-16 and UTF-32 with a named byte order; one outside Spark's own list needs
    ``spark.sql.legacy.javaCharsets``, set by the caller: the setting belongs to the session, not to one read.

    Lines end at LF only; a CR stays in the value.  The order within a file is that of
    ``(block, line_no)``: the split's start and a number that grows inside the split.
    ``number_lines`` makes consecutive numbers of it.
    """
    name = charset_name(spark, charset)
    reader = spark.read.option("lineSep", "\n").options(**options)
    value = F.col("value")
    if name != "UTF-8":
        reader = reader.option("encoding", name)
        value = F.decode(value.cast("binary"), name).alias("value")
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        value,
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Replace ``line_no`` by 1, 2, 3, ... within each file.

    Only one row per split is gathered: where its numbers begin, and how many there are.
    """
    splits = lines.groupBy("file", "block").agg(
        F.min("line_no").alias("first"), F.count("*").alias("n")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("n").over(earlier)
    shifts = splits.select(
        "file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift")
    )
    return join_small(lines, shifts, ["file", "block"], "line_no").select(
        "file", "block", (F.col("line_no") + F.col("shift")).alias("line_no"), "value"
    )


def fields_of(lines: DataFrame, delimiter: str, schema: T.StructType | Sequence[str],
              surplus: str | None = None) -> DataFrame:
    """Split lines into named text columns; a missing field is NULL.

    Fields beyond the schema go, as one text with their delimiters, to the column that ``surplus`` names (NULL
    where there are none); without a name such a line raises when it is read.
    """
    names = schema.fieldNames() if isinstance(schema, T.StructType) else list(schema)
    parts = compute_once(lines, "_fields", text.split_literal(F.col("value"), delimiter))
    n = len(names)
    columns = [F.get("_fields", F.lit(i)).alias(name) for i, name in enumerate(names)]
    more = F.size("_fields") > n
    if surplus is not None:
        rest = F.array_join(F.slice("_fields", n + 1, F.greatest(F.size("_fields") - n, F.lit(0))), delimiter)
        return parts.select(*columns, F.when(more, rest).alias(surplus))
    message = F.concat(F.lit("a line has "), F.size("_fields").cast("string"), F.lit(f" fields, not {n}: "), "value")
    first = F.when(more, F.raise_error(message).cast("string")).otherwise(F.get("_fields", F.lit(0)))
    return parts.select(first.alias(names[0]), *columns[1:]) if names else parts.select()


def scan_delimited(spark: SparkSession, path: str | Sequence[str], delimiter: str | None,
                   schema: T.StructType | Sequence[str], surplus: str | None = None,
                   charset: str | None = None, **options: str) -> DataFrame:
    """A delimited feed as text columns: literal delimiter, no quoting, empty fields kept, surplus fields as in ``fields_of``.

    With a typed schema the fields are cast; the empty string and text that does not
    convert give NULL (``stage_typed`` tells them apart).
    """
    rows = fields_of(scan_lines(spark, path, charset, **options), text.delimiter_of(delimiter), schema, surplus)
    if not isinstance(schema, T.StructType):
        return rows
    return rows.select(*[_typed(f) for f in schema.fields], *([surplus] if surplus else []))


def _typed(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return c
    return F.nullif(c, F.lit("")).try_cast(field.dataType).alias(field.name)


def scan_charset(spark: SparkSession, path: str | Sequence[str], charset: str, delimiter: str | None,
                 names: Sequence[str], surplus: str | None = None) -> DataFrame:
    """A delimited feed in a named charset (for example ``SJIS``), as text columns.

    Every line is a row, blank ones too; see ``scan_lines`` for charsets and ``fields_of`` for surplus fields.
    """
    return scan_delimited(spark, path, delimiter, list(names), surplus, charset)
