"""Published folders as partitioned tables of the session's catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from starflow.sources.storage import FORMAT


def create_table(
    spark: SparkSession, name: str, schema: StructType, root: str, fmt: str = FORMAT
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over ``root``, partitioned by the last column."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
        f"PARTITIONED BY (`{schema.fields[-1].name}`) LOCATION '{root}'"
    )


def add_partition(
    spark: SparkSession, name: str, day: str, column: str = "pt"
) -> None:
    """Make one published day visible to SQL; a day already there is read afresh."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (`{column}`='{day}')")
    spark.catalog.refreshTable(name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Make every day present visible to SQL, by listing them all."""
    spark.catalog.recoverPartitions(name)
