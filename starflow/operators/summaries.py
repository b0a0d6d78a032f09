"""Summaries of atomic metrics over valid fact rows.

Rows are aggregated on surrogate keys first, so the shuffle carries one partial
result per key and task, and the dimension's attributes join the small result
afterwards. Several facts at one grain are stacked and aggregated together: one
shuffle, and a fact without rows for a key gives COUNT 0 and SUM NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from starflow.operators.facts import current_slice
from starflow.operators.sizes import join_side
from starflow.specs import DimSpec, FactSpec, Metric, SummarySpec

_AGGREGATES = {
    "sum": F.sum,
    "count": F.count,
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
}


def summarise(
    facts: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    spec: SummarySpec,
    dim_specs: Mapping[str, DimSpec],
    bizdate: str,
    fact_specs: Mapping[str, FactSpec],
) -> DataFrame:
    """The summary ``spec`` for one day, keyed by the dimensions' business keys.

    Refuses an aggregate that a measure's additivity does not allow.
    """
    spec.check(fact_specs)
    sks = [dim_specs[d].sk for d in spec.grain]
    totals = drill_across(facts, spec.metrics, sks, bizdate)

    for name in spec.grain:
        dim = dim_specs[name]
        shown = spec.attributes.get(name, ())
        side = current_slice(dims[name], bizdate).select(dim.sk, dim.key, *shown)
        totals = totals.join(join_side(side), dim.sk, "left")

    return totals.select(
        F.lit(bizdate).alias("dt"),
        *[dim_specs[d].key for d in spec.grain],
        *[a for d in spec.grain for a in spec.attributes.get(d, ())],
        *[m.name for m in spec.metrics],
    )


def drill_across(
    facts: Mapping[str, DataFrame],
    metrics: tuple[Metric, ...],
    keys: list[str],
    bizdate: str,
) -> DataFrame:
    """Metrics of several facts side by side, one row per key in any of them."""
    stacked: DataFrame | None = None
    for name in dict.fromkeys(m.fact for m in metrics):
        fact = facts[name].where((F.col("pt") == bizdate) & (F.col("is_valid") == 1))
        part = fact.select(
            *keys, *[F.col(m.column).alias(m.name) for m in metrics if m.fact == name]
        )
        stacked = (
            part
            if stacked is None
            else stacked.unionByName(part, allowMissingColumns=True)
        )
    return stacked.groupBy(*keys).agg(*[_metric(m) for m in metrics])


def _metric(m: Metric) -> Column:
    return _AGGREGATES[m.agg](m.name).cast(m.dtype).alias(m.name)


def period_end(
    df: DataFrame, keys: list[str], measure: str, order: list[str]
) -> DataFrame:
    """A semi-additive measure over time: its value at the last ``order``."""
    last = F.max_by(measure, F.struct(*order)).cast("long")
    return df.groupBy(*keys).agg(last.alias(f"{measure}_end"))


def daily_average(df: DataFrame, keys: list[str], measure: str, day: str) -> DataFrame:
    """A semi-additive measure over time: the mean of its daily totals."""
    daily = df.groupBy(*keys, day).agg(F.sum(measure).alias("__day_total"))
    mean = F.avg("__day_total").cast("decimal(18,2)")
    return daily.groupBy(*keys).agg(mean.alias(f"{measure}_daily_avg"))


def carried_daily(
    df: DataFrame, keys: list[str], measure: str, day: str, first: str, last: str
) -> DataFrame:
    """A semi-additive measure over every calendar day of [first, last], per key.

    Daily totals are summed; a day without a row carries the last known total, also
    one from before ``first``. A key appears once it has a row on or before ``last``;
    days before its first row have no value and are left out of the mean. Returns the
    mean over the days with a value and the value at ``last``. The calendar is laid over
    a key's totals inside its row, an array of at most the period's days, so neither a
    hot key nor the days times the keys grow a task.
    """
    daily = df.where(F.col(day) <= last).groupBy(*keys, F.col(day).alias("__d")).agg(
        F.sum(measure).alias("__total")
    )
    total = daily.schema["__total"].dataType
    inside = F.col("__d") >= first
    found = F.struct(F.col("__d").cast("string").alias("d"), F.col("__total").alias("v"))
    per_key = daily.groupBy(*keys).agg(
        F.max_by("__total", F.when(~inside, F.col("__d"))).alias("__before"),
        F.collect_list(F.when(inside, found)).alias("__inside"),
    )
    calendar = F.transform(
        F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last))), lambda d: d.cast("string")
    )

    def value_at(d: Column) -> Column:
        last_known = F.array_max(F.filter("__inside", lambda x: (x["d"] <= d) & x["v"].isNotNull()))
        return F.coalesce(last_known["v"], F.col("__before"))

    every_day = F.array_union(calendar, F.transform("__inside", lambda x: x["d"]))
    valued = per_key.withColumn("__values", F.transform(every_day, value_at)).withColumn(
        "__values", F.filter("__values", lambda v: v.isNotNull())
    )
    # As avg() counts: sums of decimals stay decimal, all else is summed as double.
    kind = f"decimal(38,{total.scale})" if isinstance(total, DecimalType) else "double"
    added = F.aggregate("__values", F.lit(0).cast(kind), lambda a, v: (a + v).cast(kind))
    return valued.select(
        *keys,
        F.when(F.size("__values") > 0, added / F.size("__values")).cast("decimal(18,2)").alias(f"{measure}_mean"),
        value_at(F.array_max(every_day)).cast("long").alias(f"{measure}_at_end"),
    )
