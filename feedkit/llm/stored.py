"""Tables written to the shared folder between the steps of a job, and batches handed to Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedkit.plans.storage import scratch_path


class Scratch:
    """Written tables of one job; ``drop`` removes those that no later step reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)
        self.used = 0

    def write(self, df: DataFrame, **options: str) -> DataFrame:
        """Run ``df`` once; its rows are then read from files that every executor sees.  ``options`` are the writer's."""
        path = f"{self.root}/{self.used}"
        self.used += 1
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            self._delete(df._scratch)

    def drop_others(self, *tables: DataFrame) -> None:
        """Remove all tables of the job but these."""
        kept = {df._scratch for df in tables}
        for k in range(self.used):
            if f"{self.root}/{k}" not in kept:
                self._delete(f"{self.root}/{k}")

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# Rows and bytes that Spark hands to Python at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering its session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes.

    The helpers here work on pieces of about a megabyte; Spark's batches of 10,000 texts would only take memory.
    A session that has set the number of rows itself keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df
