"""Delimited text output.  Every writer runs at once; Spark's committer publishes it whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedkit.functions import text
from feedkit.operators import extract
from feedkit.plans.storage import materialize

# Line ends a job may ask for by word.
NEWLINES = {"windows": "\r\n", "unix": "\n"}


def header_row(df: DataFrame, delimiter: str, enclosed_by: str = "") -> DataFrame:
    """The column names as a record, in a partition of its own."""
    mark = extract.ENCLOSURES.get(enclosed_by, enclosed_by)
    line = mark + (mark + delimiter + mark).join(df.columns) + mark
    return df.sparkSession.range(0, 1, 1, 1).select(F.lit(line).alias("record"))


def write_delimited(df: DataFrame, path: str, delimiter: str | None = None, header: bool = False,
                    enclosed_by: str = "", mode: str = "error", max_records: int | None = None,
                    lines_per_file: int | None = None) -> None:
    """One record per row: fields joined, NULL as ``''``, nothing escaped.

    The header is the first part file, so the parts in name order are the file.
    ``mode="append"`` adds part files; ``max_records`` cuts the files of each task at that many lines.
    ``lines_per_file`` gives files of exactly that many lines, the last excepted, in the order of the rows and with the
    header as the first line; it writes the records to the shared folder first.
    """
    sep = text.delimiter_of(delimiter)
    records = extract.record_concat(df, sep, enclosed_by)
    if header:
        records = header_row(df, sep, enclosed_by).unionAll(records)
    if lines_per_file:
        records, max_records = in_files(records, int(lines_per_file)), int(lines_per_file)
    writer = records.write.mode(mode).option("lineSep", "\n")
    if max_records:
        writer = writer.option("maxRecordsPerFile", int(max_records))
    writer.text(path)


# Files of one task; more would not sort by name.
TASK_FILES = 900


def in_files(records: DataFrame, lines: int, keep: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """``records`` in their order, dealt so that each task has whole files of ``lines`` lines.  Runs at once.

    A row's line number is its place in its partition plus the rows of the partitions before, so only one count for
    each partition is gathered.  A task gets neighbouring files and no row of another.
    """
    if lines < 1:
        raise ValueError("a file has at least one line")
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    held = keep(records.withColumns({"_part": F.spark_partition_id(), "_at": at}))
    counts = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select(F.col("_part").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    files = max(1, -(-total // lines))
    tasks = min(files, max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-files // TASK_FILES)))
    share = -(-files // tasks)
    numbered = held.join(shifts, F.col("_part") == F.col("_of")).withColumn("_line", F.col("_at") + F.col("_before"))
    task = F.expr(f"_line div {lines * share}").cast("int")
    return numbered.repartitionById(-(-files // share), task).sortWithinPartitions("_line").select(*records.columns)


def write_transcoded(lines: DataFrame, path: str, charset: str = "UTF-8", newline: str = "unix",
                     header: str | None = None, column: str = "value", mode: str = "error") -> int:
    """Stripped lines in another charset and with another line end; returns how many.

    A character that the charset lacks raises.
    """
    if newline not in NEWLINES:
        raise ValueError(f"newline is one of {', '.join(NEWLINES)}; Spark needs one between records")
    seen = Observation("written")
    stripped = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    out = lines.select(stripped.alias("record")).observe(seen, F.count(F.lit(1)).alias("n"))
    if header is not None:
        out = lines.sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("record")).unionAll(out)
    # The text writer writes the bytes of a string as they are.
    encoded = out.select(F.encode("record", charset).cast("string").alias("record"))
    encoded.write.mode(mode).options(lineSep=NEWLINES[newline], encoding=charset).text(path)
    return seen.get["n"]
