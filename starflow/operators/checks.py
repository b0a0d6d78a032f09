"""Checks of loaded data against the model: grain, joins, attributes, intervals.

Each returns counts. Rows are pre-aggregated by the column they join or group on,
so a value that fills a third of a fact crosses the shuffle as a few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.functions import differs
from starflow.operators.dimensions import OPEN_END
from starflow.operators.facts import UNKNOWN_SK

RATE = "decimal(9,6)"


def grain_unique(df: DataFrame, grain: list[str], name: str) -> DataFrame:
    """Rows, distinct grain keys, keys held by several rows, and the surplus rows."""
    per_key = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("__n") > 1, 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("surplus_rows"),
    ).select(F.lit(name).alias("fact_name"), "*")


def repeated_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    """The grain keys held by more than one row."""
    per_key = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.where(F.col("row_count") > 1)


def join_miss(
    fact: DataFrame, fk: str, dim: DataFrame, key: str, fact_name: str, dim_name: str
) -> DataFrame:
    """Share of fact rows whose foreign key has no dimension row."""
    per_fk = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    known = dim.select(F.col(key).alias("__key")).distinct()
    matched = per_fk.join(known, per_fk[fk] == known["__key"], "left")
    missed = F.when(F.col("__key").isNull(), F.col("__n")).otherwise(F.lit(0))
    return (
        matched.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("fact_rows"),
            F.coalesce(F.sum(missed), F.lit(0)).alias("missed_rows"),
        )
        .withColumn("miss_rate", rate("missed_rows", "fact_rows"))
        .select(
            F.lit(fact_name).alias("fact_name"), F.lit(dim_name).alias("dim_name"), "*"
        )
    )


def lookup_miss(fact: DataFrame, fact_name: str, keys: dict[str, str]) -> DataFrame:
    """The same shares for a loaded fact, whose failed lookups hold the unknown key.

    ``keys`` maps dimension names to the fact's surrogate key columns. One pass, no join.
    """
    missed = {d: F.count(F.when(F.col(sk) == UNKNOWN_SK, 1)) for d, sk in keys.items()}
    counted = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"), *[n.alias(d) for d, n in missed.items()]
    )
    each = [
        F.struct(F.lit(d).alias("dim_name"), F.col("fact_rows"), F.col(d).alias("missed_rows"))
        for d in keys
    ]
    rows = counted.select(F.inline(F.array(*each)))
    return rows.withColumn("miss_rate", rate("missed_rows", "fact_rows")).select(
        F.lit(fact_name).alias("fact_name"), "*"
    )


def coverage_matrix(misses: DataFrame, dim_names: list[str]) -> DataFrame:
    """Facts x dimensions with the match rate in each cell; NULL where not joined."""
    return (
        misses.withColumn("match_rate", (F.lit(1) - F.col("miss_rate")).cast(RATE))
        .groupBy("fact_name")
        .pivot("dim_name", dim_names)
        .agg(F.max("match_rate"))
    )


def conformed_attribute(
    fact: DataFrame,
    fk: str,
    fact_column: str,
    dim: DataFrame,
    key: str,
    dim_column: str,
) -> DataFrame:
    """How often an attribute kept on the fact agrees with the dimension's."""
    kind = fact.schema[fact_column].dataType
    per_value = fact.groupBy(fk, fact_column).agg(F.count(F.lit(1)).alias("__n"))
    side = dim.select(F.col(key).alias("__key"), F.col(dim_column).alias("__attr"))
    joined = per_value.join(side, per_value[fk] == side["__key"], "left")
    unmatched = F.col("__key").isNull()
    disagree = ~unmatched & differs(per_value[fact_column], F.col("__attr"), kind)

    def rows_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("__n"))), F.lit(0))

    return joined.agg(
        rows_where(~unmatched & ~disagree).alias("agreeing_rows"),
        rows_where(disagree).alias("disagreeing_rows"),
        rows_where(unmatched).alias("unmatched_rows"),
    ).select(F.lit(fact_column).alias("attribute"), "*")


def one_to_one(
    source: DataFrame, source_key: str, target: DataFrame, target_key: str, name: str
) -> DataFrame:
    """Whether source and target hold the same keys, once each.

    Both sides are stacked and counted per key in a single shuffle.
    """
    sides = source.select(
        F.col(source_key).alias("k"), F.lit(1).alias("s"), F.lit(0).alias("t")
    ).unionByName(
        target.select(
            F.col(target_key).alias("k"), F.lit(0).alias("s"), F.lit(1).alias("t")
        )
    )
    per_key = sides.groupBy("k").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))

    def keys_where(test: Column) -> Column:
        return F.count(F.when(test, 1))

    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        keys_where(F.col("t") == 0).alias("source_only_keys"),
        keys_where(F.col("s") == 0).alias("target_only_keys"),
        keys_where((F.col("s") > 1) | (F.col("t") > 1)).alias("repeated_keys"),
    ).select(F.lit(name).alias("mapping"), "*")


def scd2_intervals(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Counts of broken history rules in one day's copy of a dimension.

    Copies of a version collapse before the per-key window, so the rows of one key
    in it are bounded by its distinct intervals.
    """
    versions = dim.groupBy(key, "begin_date", "end_date", "is_active").agg(
        F.count(F.lit(1)).alias("__n")
    )
    of_key = Window.partitionBy(key)
    in_time = of_key.orderBy("begin_date", "end_date", "is_active")
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    active = F.when(F.col("is_active") == 1, F.col("__n")).otherwise(F.lit(0))
    marked = versions.select(
        "*",
        F.max("end_date").over(earlier).alias("reached"),
        F.row_number().over(in_time).alias("position"),
        F.sum(active).over(of_key).alias("active_of_key"),
    )
    is_open = F.col("end_date") == OPEN_END

    def versions_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("__n"))), F.lit(0))

    # Against the furthest end of all earlier versions, so a long one that holds
    # several later ones overlaps each of them.
    overlaps = F.col("__n") - 1 + F.when(
        F.col("begin_date") < F.col("reached"), 1
    ).otherwise(0)
    return marked.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("versions"),
        F.count(F.when(F.col("position") == 1, 1)).alias("keys"),
        F.count(
            F.when((F.col("position") == 1) & (F.col("active_of_key") != 1), 1)
        ).alias("keys_not_one_active"),
        F.coalesce(F.sum(overlaps), F.lit(0)).alias("overlaps"),
        F.count(F.when(F.col("begin_date") > F.col("reached"), 1)).alias("gaps"),
        versions_where(is_open != (F.col("is_active") == 1)).alias("open_mismatches"),
        versions_where(F.col("begin_date") >= F.col("end_date")).alias("empty_intervals"),
    ).select(F.lit(name).alias("dim_name"), "*")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def rate(part: str, whole: str) -> Column:
    share = F.col(part).cast("double") / F.col(whole).cast("double")
    return F.when(F.col(whole) > 0, share).cast(RATE)
