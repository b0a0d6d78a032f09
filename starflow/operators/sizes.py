"""Joins planned by the rows a table holds, not by the bytes its files take."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_side(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join, which is broadcast only if its rows are small in memory.

    Spark takes the size of files for that of rows, but columnar files hold sorted keys
    and repeated texts in a hundredth of their bytes, so millions of rows pass below its
    broadcast threshold and are built into one table on the driver. A side that the file
    size would let through is counted (it is small to read); one whose rows exceed the
    threshold is joined by a shuffle. Others are left to Spark.
    """
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    by_files = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if most <= 0 or by_files > most:
        return df
    row = 8 + df._jdf.schema().defaultSize()
    return df.hint("merge") if df.count() * row > most else df
