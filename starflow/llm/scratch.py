"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.sources.storage import run_folder, shared_folder


def scratch_root(spark: SparkSession) -> str:
    """A run folder under ``spark.checkpoint.dir``, which driver and executors share.

    A session without one is refused: a folder on the driver's own disk would not be
    the one the executors write to, and rows would be lost without an error. The
    folder goes with ``discard_runs`` once the results are written.
    """
    shared_folder(spark)
    return run_folder(spark)


def saved(df: DataFrame, name: str, *, compression: str = "zstd") -> DataFrame:
    """The rows written once as Parquet and read again, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
