"""Pick up the new files of a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.operators import load
from feedkit.plans.load_job import LoadSpec, load_tagged, tag_rows
from feedkit.plans.storage import materialize


def incremental_load(spark: SparkSession, directory: str, load_batch: Callable[[DataFrame, int], None],
                     checkpoint: str, max_files: int | None = None) -> None:
    """Hand the lines of files not seen before to ``load_batch(lines, batch_id)``.  Runs at once.

    The checkpoint remembers which files are done.  A batch that fails is offered again with
    the same id, so ``load_batch`` should write by it (``stage_batches`` does).
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    lines = reader.text(directory).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )

    def numbered(batch, batch_id):
        load_batch(batch.withColumn("line_no", F.monotonically_increasing_id()), batch_id)

    query = (
        lines.writeStream.foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stage_batches(out: str, delimiter: str, schema: T.StructType) -> Callable[[DataFrame, int], None]:
    """A ``load_batch`` that writes typed lines to ``<out>/batch=<id>``, replacing a first try."""

    def write(lines, batch_id):
        load.typed_lines(lines, delimiter, schema).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def file_status(typed: DataFrame) -> DataFrame:
    """Per file: its lines, its rejects, and whether it may go (``clean``) or must stay."""
    return typed.groupBy("file").agg(
        F.count("*").alias("lines"), F.count("reason").alias("rejects"),
        (F.count("reason") == 0).alias("clean"),
    )


def load_batches(spark: SparkSession, table: str, spec: LoadSpec, status: str) -> Callable[[DataFrame, int], None]:
    """A ``load_batch`` that loads into a catalog table and says what became of each file.

    Rows are checked for uniqueness and upserted as by ``load_table``, under the batch id as stamp, so a batch that
    is offered again gives the same table and the same rejects.  ``<status>/batch=<id>`` gets one row per file: its lines,
    rejects, and whether it may go (``clean``) or must stay.
    """

    def write(lines, batch_id):
        tagged = materialize(tag_rows(lines, spec))
        load_tagged(spark, table, tagged, spec, f"batch_{batch_id}")
        refused = tagged.withColumn("reason", F.when(F.col("kind") == "uv", "key is taken").otherwise(F.col("reason")))
        file_status(refused).write.mode("overwrite").parquet(f"{status}/batch={batch_id}")

    return write
