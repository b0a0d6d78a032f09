"""Daily partitions of a table kept as ``<root>/<column>=<day>`` directories.

Publishing replaces one partition directory. That is repeatable, clears the day
when the result is empty, and leaves the other days readable by the same job, so
a table may be built from its own earlier days.

A day is written beside the table first and takes its place by rename only when it
is complete, so a failed load leaves the old day whole. Only days that carry Spark's
success marker count as present.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Storage settings of the published tables.
FORMAT = "orc"
COMPRESSION = "snappy"
FACT_STRIPE_BYTES = 67_108_864

MARKER = "_SUCCESS"


def publish(
    df: DataFrame,
    root: str,
    day: str,
    *,
    column: str = "pt",
    fmt: str = FORMAT,
    stripe_bytes: int | None = None,
    file_rows: int | None = None,
) -> None:
    """Write ``df`` as the whole of one day's partition.

    ``file_rows`` caps the rows of a file, for readers that want smaller ones.
    """
    spark = df.sparkSession
    writer = df.drop(column).write.format(fmt).option("compression", COMPRESSION)
    if stripe_bytes is not None and fmt == "orc":
        writer = writer.option("orc.stripe.size", stripe_bytes)
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    final = partition_path(root, day, column)
    new = f"{root.rstrip('/')}/.new-{uuid.uuid4().hex}"
    try:
        writer.save(new)
        _swap(spark, new, final, _set_aside(root, day, column))
    finally:
        discard(spark, new)


def read_partition(
    spark: SparkSession,
    root: str,
    day: str,
    *,
    column: str = "pt",
    fmt: str = FORMAT,
    schema: StructType | None = None,
) -> DataFrame:
    """One day's rows; only that directory is listed. The day stays a string.

    A day whose replacement was cut off between its two renames is put back first; a
    day that is not there at all raises.
    """
    _heal(spark, root, day, column)
    reader = spark.read.format(fmt)
    if schema is not None:
        kept = [f for f in schema.fields if f.name != column]
        reader = reader.schema(StructType(kept))
    rows = reader.load(partition_path(root, day, column))
    return rows.withColumn(column, F.lit(day))


def read_table(
    spark: SparkSession, root: str, schema: StructType, *, fmt: str = FORMAT
) -> DataFrame:
    """Every day of a table. Filter on the partition column to prune directories.

    Days whose replacement was cut off between its two renames are put back first, so
    none of them reads as absent.
    """
    partitions(spark, root)
    return spark.read.format(fmt).schema(schema).load(root)


def partitions(spark: SparkSession, root: str, column: str = "pt") -> list[str]:
    """The complete days, from the directory listing.

    A directory without the success marker is a write that did not end. A day whose
    replacement was cut off between its two renames is put back.
    """
    files, path = _files(spark, root)
    if not files.exists(path):
        return []
    prefix, aside = f"{column}=", f".old-{column}="
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    for name in [n for n in names if n.startswith(aside)]:
        day = name[len(aside) :]
        if f"{prefix}{day}" not in names:
            final = partition_path(root, day, column)
            _rename(spark, _set_aside(root, day, column), final)
            names.append(f"{prefix}{day}")
    days = sorted(n[len(prefix) :] for n in names if n.startswith(prefix))
    return [d for d in days if _complete(spark, partition_path(root, d, column))]


def read_previous(
    spark: SparkSession,
    root: str,
    day: str,
    *,
    column: str = "pt",
    fmt: str = FORMAT,
    schema: StructType | None = None,
) -> DataFrame | None:
    """The latest complete partition before ``day``, or None when there is none."""
    earlier = [d for d in partitions(spark, root, column) if d < day]
    if not earlier:
        return None
    return read_partition(
        spark, root, earlier[-1], column=column, fmt=fmt, schema=schema
    )


def partition_path(root: str, day: str, column: str = "pt") -> str:
    return f"{root.rstrip('/')}/{column}={day}"


def materialise(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write an intermediate result once and read it back.

    It goes below ``folder``, a run folder that the caller discards, or else into a
    new run folder.
    """
    spark = df.sparkSession
    path = f"{folder or run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: the session's checkpoint folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


_runs: list[str] = []


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run's intermediate tables, until :func:`discard_runs`."""
    path = f"{shared_folder(spark)}/starflow-{uuid.uuid4().hex}"
    _runs.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; one that is absent is fine."""
    files, at = _files(spark, path)
    files.delete(at, True)


def discard_runs(spark: SparkSession) -> None:
    """Remove the run folders made so far, once their results are written."""
    while _runs:
        discard(spark, _runs.pop())


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _heal(spark: SparkSession, root: str, day: str, column: str) -> None:
    """Put back the day set aside by a swap that was cut off before its second rename."""
    files, final = _files(spark, partition_path(root, day, column))
    if files.exists(final):
        return
    aside = _set_aside(root, day, column)
    if files.exists(_files(spark, aside)[1]):
        _rename(spark, aside, partition_path(root, day, column))


def _set_aside(root: str, day: str, column: str) -> str:
    return f"{root.rstrip('/')}/.old-{column}={day}"


def _complete(spark: SparkSession, path: str) -> bool:
    files, marker = _files(spark, f"{path}/{MARKER}")
    return files.exists(marker)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, at = _files(spark, source)
    if not files.rename(at, _files(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def _swap(spark: SparkSession, new: str, final: str, old: str) -> None:
    """Put a complete new day in place; the old one stays aside until then."""
    files, at = _files(spark, final)
    if not _complete(spark, new):
        files.create(_files(spark, f"{new}/{MARKER}")[1]).close()
    if files.exists(at):
        discard(spark, old)
        _rename(spark, final, old)
    _rename(spark, new, final)
    discard(spark, old)
