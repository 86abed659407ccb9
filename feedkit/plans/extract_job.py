"""The extract job: window, choose, clean, one record per row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from feedkit.functions import text
from feedkit.operators import extract, filters


@dataclass(frozen=True)
class ExtractSpec:
    """What one table's extract takes."""

    columns: str | Sequence[str] | None = None
    delimiter: str = text.DEFAULT_DELIMITER
    mode: str = "days_back"
    date_column: str | None = None
    target: str = "today"
    days_back: int = 0
    conditions: Column | str | None = None
    style: str = "loose"
    enclosed_by: str = ""
    as_of: dt.date | None = None


def extract_records(df: DataFrame, spec: ExtractSpec) -> DataFrame:
    """Records of a table as one lazy plan: the window and the columns reach the scan."""
    rows = filters.extract_mode(
        df, spec.mode, spec.date_column, spec.target, spec.days_back, spec.conditions, spec.as_of
    )
    chosen = extract.project_columns(rows, spec.columns)
    cleaned = extract.clean_columns(chosen, spec.style)
    return extract.record_concat(cleaned, text.delimiter_of(spec.delimiter), spec.enclosed_by)
