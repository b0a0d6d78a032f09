"""Landing a source snapshot under its declared schema."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructField, StructType

from starflow.functions import load_time


def land_snapshot(
    src: DataFrame,
    schema: StructType,
    bizdate: str,
    at: datetime | None = None,
    *,
    rounding: Collection[str] = (),
) -> DataFrame:
    """Source columns cast to ``schema``, stamped with load time and day.

    A column missing from the source is refused, and so is a value its type cannot
    hold or would change (1.7 to an integer, 12.345 to two places, a time of day to a
    date), whatever the session's ANSI setting; columns named in ``rounding`` may be
    rounded or cut instead. Extra source columns are left out.
    """
    missing = [f.name for f in schema.fields if f.name not in src.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    stamp = F.date_format(load_time(at), "yyyy-MM-dd HH:mm:ss")
    return src.select(
        *[_kept(src, f, f.name in rounding).alias(f.name) for f in schema.fields],
        stamp.alias("etl_time"),
        F.lit(bizdate).alias("pt"),
    )


def _kept(src: DataFrame, target: StructField, may_round: bool = False) -> Column:
    """The column as its declared type; a value that would be lost or changed raises."""
    value = F.col(target.name)
    source = src.schema[target.name].dataType
    if source == target.dataType:
        return value
    cast = value.try_cast(target.dataType)
    kind = target.dataType.simpleString()
    told = F.concat(
        F.lit(f"column {target.name} cannot hold as {kind} the value "),
        value.cast("string"),
    )
    lost = value.isNotNull() & cast.isNull()
    if not may_round:
        lost = lost | (value.isNotNull() & ~_same(value, cast, source, target.dataType))
    return F.when(lost, F.raise_error(told)).otherwise(cast)


def _same(value: Column, cast: Column, source: DataType, target: DataType) -> Column:
    """Whether the cast value equals the source value, compared in a type both reach."""
    if isinstance(source, StringType):
        if isinstance(target, NumericType):
            exact = "decimal(38,18)"
            return F.coalesce(value.try_cast(exact) == cast.try_cast(exact), F.lit(False))
        return F.lit(True)
    return F.coalesce(cast.try_cast(source) == value, F.lit(False))


def map_columns(src: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select and rename by a target -> source mapping."""
    return src.select(*[F.col(s).alias(t) for t, s in mapping.items()])
