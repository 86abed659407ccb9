"""Small files in shared storage: what is under way with a table, kept where the next try finds it."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _place(spark: SparkSession, location: str):
    """A Hadoop path and its file system; ``location`` is a URI as Spark reports it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location))
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_files(spark: SparkSession, locations: Iterable[str]) -> None:
    """Remove files; one that is gone already is no error."""
    for location in locations:
        path, fs = _place(spark, location)
        fs.delete(path, False)


def _split(table: str) -> tuple[str | None, str]:
    parts = [p.strip("`") for p in table.split(".")]
    return (parts[-2] if len(parts) > 1 else None), parts[-1]


class Journal:
    """The record of one table's publication, in ``_publish/<table>`` of its database's folder.

    A record is written under the next number and renamed into place, so a reader sees a whole one: the old or the new.
    """

    def __init__(self, spark: SparkSession, table: str):
        database, name = _split(table)
        home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        self.spark, self.folder = spark, f"{home.rstrip('/')}/_publish/{name}"

    def _numbers(self) -> list[int]:
        path, fs = _place(self.spark, self.folder)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def read(self) -> dict | None:
        numbers = self._numbers()
        if not numbers:
            return None
        path, fs = _place(self.spark, f"{self.folder}/{numbers[-1]}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, record: dict) -> None:
        numbers = self._numbers()
        at = numbers[-1] + 1 if numbers else 0
        path, fs = _place(self.spark, f"{self.folder}/{at}.new")
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        if not fs.rename(path, _place(self.spark, f"{self.folder}/{at}.json")[0]):
            raise OSError(f"{self.folder}/{at}.json could not be written")
        delete_files(self.spark, [f"{self.folder}/{n}.json" for n in numbers])
