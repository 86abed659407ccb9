"""Row filters over whole DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions import match


def target_day(target: str, as_of: dt.date | None = None) -> dt.date:
    """The day meant by ``today``, ``yesterday`` or ``YYYYMMDD``."""
    if target in ("today", "yesterday"):
        day = as_of or dt.date.today()
        return day if target == "today" else day - dt.timedelta(days=1)
    return dt.datetime.strptime(str(target), "%Y%m%d").date()


def date_window(df: DataFrame, column: str, target: str, days_back: int = 0,
                as_of: dt.date | None = None) -> DataFrame:
    """Rows whose day lies in ``[target - days_back, target]``.

    Written as a half-open range on the column itself, so the scan gets both bounds.
    """
    end = target_day(target, as_of)
    start = end - dt.timedelta(days=int(days_back))
    kind = df.schema[column].dataType
    low = F.lit(start.isoformat()).cast(kind)
    high = F.lit((end + dt.timedelta(days=1)).isoformat()).cast(kind)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def extract_mode(df: DataFrame, mode: str, date_column: str | None = None, target: str = "today",
                 days_back: int = 0, conditions: Column | str | None = None,
                 as_of: dt.date | None = None) -> DataFrame:
    """``full`` keeps all rows that meet the conditions; other modes only take the window."""
    if mode == "full":
        return df if conditions is None else df.where(conditions)
    return df if date_column is None else date_window(df, date_column, target, days_back, as_of)


def like_filter(df: DataFrame, column: str, include: Sequence[str] | None = None,
                exclude: Sequence[str] | None = None, escape: str = "!",
                names: Sequence[str] | None = None) -> DataFrame:
    return df.where(match.name_like(F.col(column), include, exclude, escape, names))


def expired(df: DataFrame, name_column: str, days_back: int, as_of: Column | dt.date | str) -> DataFrame:
    return df.where(match.expired_by_suffix(F.col(name_column), days_back, as_of))
