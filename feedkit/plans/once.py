"""Keep Catalyst from copying an expensive expression into everything that uses it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    A filter above a projection takes the whole expression of each column it tests down with
    it.  It cannot do that with the output of a generator, here one of a single element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
