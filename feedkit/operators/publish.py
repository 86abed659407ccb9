"""Publishing into catalog tables that Spark cannot change in place.

Every publication keeps a journal that says what is under way, which files or tables are old and new, and how far it
has come.  Whoever publishes next reads it first and finishes or undoes what broke off, so a try may break off anywhere
and be made again.  One job at a time publishes into a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.operators import keys as key_joins
from feedkit.plans.journal import Journal, delete_files

# Types whose least and greatest staged key narrow the scan for rows to replace.
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.StringType)


def _run(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def _there(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def recover(spark: SparkSession, table: str) -> dict | None:
    """Finish or undo a publication into ``table`` that broke off.  Runs at once.

    Returns the record of the last publication that is complete, or None.  Steps and what is done about them:

    ``new``: a new table was being filled; it goes, the old one is untouched.
    ``swap``: the new table is complete; it is renamed into place.
    ``append``: new files were being added; those that the journal does not list go.
    ``remove``: the new files are all there; the files that they replace go.
    """
    journal = Journal(spark, table)
    record = journal.read()
    step = record["step"] if record else None
    if step == "new":
        _run(spark, f"DROP TABLE IF EXISTS {record['new']}")
        _undone(journal, record)
    elif step == "swap":
        _finish_swap(spark, table, journal, record)
    elif step == "append":
        spark.catalog.refreshTable(table)
        known = set(record["before"])
        delete_files(spark, [f for f in spark.table(table).inputFiles() if f not in known])
        spark.catalog.refreshTable(table)
        _undone(journal, record)
    elif step == "remove":
        _finish_remove(spark, table, journal, record)
    last = journal.read() if step else None
    return last if last and last["step"] == "published" else None


def _undone(journal: Journal, record: dict) -> None:
    journal.write(record.get("last") or {"step": "undone"})


def _begin(spark: SparkSession, table: str, stamp: str, note: dict | None) -> tuple[Journal, dict]:
    last = recover(spark, table)
    kept = {k: v for k, v in last.items() if k != "last"} if last else None
    return Journal(spark, table), {"stamp": stamp, "note": note or {}, "last": kept}


def _end(spark: SparkSession, table: str, journal: Journal, record: dict) -> None:
    journal.write({"step": "published", "stamp": record["stamp"], "note": record["note"], "created": _created(spark, table)})


def _created(spark: SparkSession, table: str) -> str | None:
    """When the table was made; a table that was dropped and made again is another one."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Created Time'").first()
    return found["data_type"] if found else None


def is_published(spark: SparkSession, table: str, stamp: str, note: dict) -> dict | None:
    """The note of the last publication, if it had this stamp and what ``note`` says, and the table is still the one of then.  Runs at once."""
    last = recover(spark, table)
    if not last or last["stamp"] != stamp or not note.items() <= last["note"].items() or not _there(spark, table):
        return None
    return last["note"] if last["created"] == _created(spark, table) else None


def full_refresh_swap(spark: SparkSession, table: str, staged: DataFrame, stamp: str, note: dict | None = None) -> None:
    """Write the rows next to the table, then rename them into its place.  Runs at once.

    A table that is there already hands its format, partitioning, comments and properties on, and takes columns by
    name.  Whatever breaks off, the next call with any stamp finds the table with its old rows or with its new ones.
    ``note`` is kept with the record of the publication.
    """
    journal, record = _begin(spark, table, stamp, note)
    new, backup = f"{table}_tmp", f"{table}_bak_{stamp}"
    record |= {"new": new, "backup": backup}
    if _there(spark, table):
        _run(spark, f"DROP TABLE IF EXISTS {backup}")
    elif _there(spark, backup):
        _run(spark, f"ALTER TABLE {backup} RENAME TO {table}")
    journal.write(record | {"step": "new"})
    _run(spark, f"DROP TABLE IF EXISTS {new}")
    if _there(spark, table) and sorted(spark.table(table).columns) == sorted(staged.columns):
        _run(spark, f"CREATE TABLE {new} LIKE {table}")
        kept = [r for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if not r["key"].startswith(("transient", "numFiles", "totalSize"))]
        if kept:
            pairs = ", ".join(f"{_quoted(r['key'])} = {_quoted(r['value'])}" for r in kept)
            _run(spark, f"ALTER TABLE {new} SET TBLPROPERTIES ({pairs})")
        _add(staged, new)
    else:
        staged.write.saveAsTable(new)
    journal.write(record | {"step": "swap"})
    _finish_swap(spark, table, journal, record)


def _finish_swap(spark: SparkSession, table: str, journal: Journal, record: dict) -> None:
    new, backup = record["new"], record["backup"]
    if _there(spark, new):
        if _there(spark, table):
            _run(spark, f"ALTER TABLE {table} RENAME TO {backup}")
        _run(spark, f"ALTER TABLE {new} RENAME TO {table}")
    _run(spark, f"DROP TABLE IF EXISTS {backup}")
    _end(spark, table, journal, record)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _add(rows: DataFrame, table: str) -> None:
    rows.select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def _range_of(staged: DataFrame, target: DataFrame, keys: Sequence[str]) -> Column:
    """A filter on the target's keys that the scan can use: between the least and the greatest staged key.  Runs at once."""
    ranged = [k for k in keys if isinstance(staged.schema[k].dataType, RANGED) and staged.schema[k].dataType == target.schema[k].dataType]
    if not ranged:
        return F.lit(True)
    ends = staged.dropna("any", subset=list(keys)).agg(*[f(k).alias(f"{f.__name__}_{k}") for k in ranged for f in (F.min, F.max)]).first()
    if ends[0] is None:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.col(k).between(F.lit(ends[f"min_{k}"]), F.lit(ends[f"max_{k}"])) for k in ranged])


def files_to_replace(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> list[str] | None:
    """Files of the target that hold a staged key; None if the target is not a table of files.  Runs at once.

    Only key columns are read, and only files and row groups whose key range meets the staged one.  The driver gets
    one path for each file, as Spark's own file index does.
    """
    try:
        located = target.withColumn("_file", target.metadataColumn("_metadata")["file_path"])
    except AnalysisException:
        return None
    near = located.where(_range_of(staged, target, keys)).select(*keys, "_file")
    return sorted(r["_file"] for r in key_joins.semi(near, staged, keys).select("_file").distinct().collect())


def publish_upsert(spark: SparkSession, table: str, staged: DataFrame, keys: Sequence[str], stamp: str, note: dict | None = None) -> None:
    """Upsert into a table that Spark cannot change in place: rows of a staged key go, all staged rows come.  Runs at once.

    Only files that hold a replaced key are written anew: what stays of them and the staged rows are added as new
    files, then the replaced files go.  All other files keep their names and bytes.  Between the two steps a reader sees
    both; a try that breaks off is undone before the new files are complete and finished afterwards.  A target that is not
    a table of files is written whole and swapped.  A partition may be left without files.

    ``staged`` is evaluated up to three times: its keys' range, its keys, its rows.
    """
    recover(spark, table)
    target = spark.table(table)
    replaced = files_to_replace(target, staged, keys)
    if replaced is None:
        full_refresh_swap(spark, table, key_joins.delete_by_keys(target, staged, keys).unionByName(staged.select(*target.columns)), stamp, note)
        return
    rows = staged.select(*target.columns)
    if replaced:
        touched = target.where(target.metadataColumn("_metadata")["file_path"].isin(replaced))
        rows = key_joins.delete_by_keys(touched, staged, keys).select(*target.columns).unionByName(rows)
    journal, record = _begin(spark, table, stamp, note)
    journal.write(record | {"step": "append", "before": target.inputFiles()})
    # files of an even size, also where one partition takes most rows
    _add(rows.hint("rebalance", *[F.col(c) for c in partition_columns(spark, table)]), table)
    record["remove"] = replaced
    journal.write(record | {"step": "remove"})
    _finish_remove(spark, table, journal, record)


def _finish_remove(spark: SparkSession, table: str, journal: Journal, record: dict) -> None:
    delete_files(spark, record["remove"])
    spark.catalog.refreshTable(table)
    _end(spark, table, journal, record)
