"""Projections of an extract: choose, clean, join into records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions import dates, text

# Words that cannot be column names in a load job.
RESERVED_WORDS = frozenset(
    """
    create drop grant select insert update delete table into from where and or like value values
    order by on to as asc desc having group limit escape if else then when case yes no not password
    sum count unique cast max min view trim with type help all set primary index default multiset
    fallback before after journal checksum mergeblockratio character unicode casespecific account
    sample year month date hour minute second error comment day title row_number level operator
    next summary user
    """.split()
)

# Enclosing characters a job may ask for by word.
ENCLOSURES = {"single-quote": "'", "double-quote": '"', "nothing": ""}

# Fixed value: width of a fixed-width export record.
RECORD_WIDTH = 1000


def project_columns(df: DataFrame, columns: str | Sequence[str | int] | None = None) -> DataFrame:
    """The named columns in the given order (names may carry back-ticks, numbers are
    0-based positions), or all columns."""
    if columns is None or columns == "":
        return df
    wanted = columns.split(",") if isinstance(columns, str) else columns
    names = [df.columns[c] if isinstance(c, int) else c.strip().strip("`") for c in wanted]
    return df.select(*[df[f"`{name}`"] for name in names])


def _is_binary(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.BinaryType)


def _is_id(field: T.StructField) -> bool:
    return bool(field.metadata.get("uuid"))


def _loose(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.DateType):
        dated = F.when(c >= F.lit("0000-01-01").cast("date"), c)
        return F.coalesce(dates.format_date(dated), F.lit(""))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        first = F.lit("0000-01-01").cast(kind)
        return F.coalesce(F.when(c >= first, c).cast("string"), F.lit(""))
    if _is_binary(field):
        return text.binary_to_text(c, _is_id(field))
    if isinstance(kind, T.StringType):
        return text.whitespace_to_space(text.null_to_empty(c))
    return F.coalesce(c.cast("string"), F.lit(""))


def _strict(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        cleaned = dates.format_timestamp(c)
    elif isinstance(kind, T.DateType):
        cleaned = dates.format_date(c)
    elif _is_binary(field):
        cleaned = text.binary_to_text(c, _is_id(field))
    elif isinstance(kind, T.StringType):
        cleaned = text.strict_text(c)
    else:
        cleaned = c.cast("string")
    return F.coalesce(cleaned, F.lit("")) if field.nullable else cleaned


def clean_columns(df: DataFrame, style: str = "loose") -> DataFrame:
    """Every column as cleaned text, by its type.

    ``loose`` turns every NULL into ``''`` and control characters into spaces.
    ``strict`` also removes odd byte sequences, cuts timestamps to seconds, and leaves
    columns that are declared not nullable as they are.  Binary values of 16 bytes become UUID texts, others
    hex digits; a field with ``{"uuid": True}`` in its metadata holds ids only.
    """
    rule = {"loose": _loose, "strict": _strict}[style]
    return df.select(*[rule(field).alias(field.name) for field in df.schema.fields])


def add_literals(df: DataFrame, literals: Mapping[str, str] | str, table: str = "", host: str = "",
                 schema: str = "") -> DataFrame:
    """Append constant columns; ``<TABLENAME>``, ``<HOST>`` and ``<SCHEMA>`` are filled in."""
    if isinstance(literals, str):
        literals = dict(item.split(":") for item in literals.split(","))
    fills = [("<TABLENAME>", table), ("<HOST>", host), ("<SCHEMA>", schema)]
    columns = {}
    for name, value in literals.items():
        for token, fill in fills:
            value = value.replace(token, fill)
        columns[name] = F.lit(value)
    return df.withColumns(columns)


def record_column(df: DataFrame, delimiter: str, enclosed_by: str = "") -> Column:
    """All columns of a row as one delimited text, each enclosed; NULL is ``''``."""
    mark = ENCLOSURES.get(enclosed_by, enclosed_by)
    fields = [text.null_to_empty(F.col(f"`{f.name}`")) for f in df.schema.fields]
    joined = F.concat_ws(mark + delimiter + mark, *fields)
    return F.concat(F.lit(mark), joined, F.lit(mark)) if mark else joined


def record_concat(df: DataFrame, delimiter: str = text.DEFAULT_DELIMITER, enclosed_by: str = "",
                  name: str = "record") -> DataFrame:
    return df.select(record_column(df, delimiter, enclosed_by).alias(name))


def fixed_width_record(df: DataFrame, delimiter: str, width: int = RECORD_WIDTH, enclosed_by: str = "",
                       name: str = "record") -> DataFrame:
    """Trimmed fields joined and cut or padded to ``width`` characters."""
    mark = ENCLOSURES.get(enclosed_by, enclosed_by)
    fields = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = dates.format_timestamp(c)
        fields.append(F.concat(F.lit(mark), text.null_to_empty(c, trim=True), F.lit(mark)))
    joined = F.concat_ws(delimiter, *fields)
    return df.select(F.rpad(F.substring(joined, 1, width), width, " ").alias(name))


def load_name(column: str) -> str:
    """A column name that a load job accepts."""
    if column in RESERVED_WORDS:
        return f"{column}Field"
    return f"field_{column}" if column[0].isdigit() else column


def load_projection(df: DataFrame, columns: Sequence[str] | str = "all",
                    targets: Sequence[str] | None = None) -> DataFrame:
    """Columns to load, in table order, under names a load job accepts or under target names."""
    wanted = columns.split(",") if isinstance(columns, str) and columns != "all" else columns
    kept = [c for c in df.columns if wanted == "all" or c in wanted]
    names = [load_name(c) for c in kept] if targets is None else list(targets)
    if len(names) != len(kept):
        raise ValueError(f"{len(kept)} columns to load but {len(names)} target columns")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)])


def lobs_first(df: DataFrame, lob_columns: Sequence[str], target_columns: Sequence[str] | None = None) -> DataFrame:
    """Large-object columns first, then the others, each in their order.

    With the target's columns given, ``lob_columns`` are target names and pair by position.
    """
    if target_columns is not None and len(target_columns) != len(df.columns):
        raise ValueError(f"source has {len(df.columns)} columns, target {len(target_columns)}")
    paired = dict(zip(df.columns, target_columns or df.columns))
    lobs = [c for c in df.columns if paired[c] in lob_columns]
    return df.select(*[df[f"`{c}`"] for c in lobs + [c for c in df.columns if c not in lobs]])
