"""Where intermediate data may be written so that every executor can read it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting (tests) gets a new temporary folder.  A
    cluster session without it is an error: executors could not see such a folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="feedkit-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables live in the shared folder."""
    name = f"feedkit_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def materialize(df: DataFrame) -> DataFrame:
    """Run ``df`` once and cut its lineage with a reliable checkpoint."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
