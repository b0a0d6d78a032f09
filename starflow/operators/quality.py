"""The one-row check run after every fact load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.specs import FactSpec


def quality_summary(fact: DataFrame, spec: FactSpec, bizdate: str) -> DataFrame:
    """Row count, valid rows and each measure's range, in one pass.

    On an empty day the count is 0 and everything else NULL.
    """
    valid = F.when(F.col("is_valid") == 1, F.lit(1)).otherwise(F.lit(0))
    ranges = [
        bound(m).alias(f"{m}_{suffix}")
        for m in spec.measure_names
        for bound, suffix in ((F.min, "min"), (F.max, "max"))
    ]
    counts = fact.where(F.col("pt") == bizdate).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(valid).alias("valid_records"),
        *ranges,
    )
    return counts.select(
        F.lit(spec.table).alias("table_name"), F.lit(bizdate).alias("pt"), "*"
    )
