"""Rows into a database table."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Isolation levels by number, as jobs name them.
ISOLATION = {1: "READ_UNCOMMITTED", 2: "READ_COMMITTED", 3: "REPEATABLE_READ", 4: "SERIALIZABLE"}


def write_options(url: str, table: str, batchsize: int = 1000, isolation: int = 0, **options: str) -> dict:
    out = {"url": url, "dbtable": table, "batchsize": str(int(batchsize)), **options}
    if isolation:
        out["isolationLevel"] = ISOLATION[isolation]
    return out


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 1000, isolation: int = 0,
               mode: str = "append", **options: str) -> int:
    """Batched insert, one connection per partition; returns the number of rows.  Runs at once."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("inserted")
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.format("jdbc").options(**write_options(url, table, batchsize, isolation, **options)).mode(mode).save()
    return seen.get["n"]
