"""Fact loads: surrogate keys looked up per dimension, unknowns kept and flagged."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from starflow.functions import audit_columns
from starflow.operators.dimensions import MissingDayError, of_day, scd2_current
from starflow.operators.keys import dense_key
from starflow.operators.sizes import join_side
from starflow.specs import DimSpec, FactSpec

# Fixed value: the surrogate key of a dimension row that was not found.
UNKNOWN_SK = -1


def load_fact(
    src: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: FactSpec,
    dim_specs: Mapping[str, DimSpec],
    bizdate: str,
    *,
    keep: tuple[str, ...] = (),
    event_date: str | None = None,
    surrogate: bool = True,
    at: datetime | None = None,
    allow_empty: bool = False,
) -> DataFrame:
    """One row per source row with its dimension keys, measures and ``is_valid``.

    The dimension's current version on ``bizdate`` is looked up. A key that is not
    found becomes ``UNKNOWN_SK`` and clears ``is_valid``; the row stays.
    ``keep`` adds source columns such as the order id. ``event_date`` restricts the
    load to rows whose date column falls on ``bizdate``, as a filter that reaches the
    files. Of a partitioned source only the day's rows are read. ``surrogate=False``
    leaves out the fact's own key. A partitioned source without rows of the day raises
    (``MissingDayError``) unless ``allow_empty``, so an absent day is never published
    as an empty one.

    Only (business key, surrogate key) of a dimension reaches the join. Whether it
    is broadcast is decided by its rows (:func:`join_side`); a large one is joined by
    shuffle, and a foreign key holding many rows is split by the adaptive
    skew-join rule, which applies to left joins.
    """
    rows = of_day(src, bizdate)
    if not allow_empty and "pt" in src.columns and rows.isEmpty():
        raise MissingDayError(f"the source has no rows of {bizdate}")
    if event_date is not None:
        rows = rows.where(_falls_on(rows, event_date, bizdate))
    rows = rows.select(*_source_columns(spec, keep))
    if surrogate:
        rows = dense_key(rows, spec.grain, spec.sk)

    sks = []
    for dim_name, fk in spec.lookups:
        dim = dim_specs[dim_name]
        keys = current_slice(dims[dim_name], bizdate).select(
            F.col(dim.key).alias(fk), dim.sk
        )
        rows = rows.join(join_side(keys), fk, "left")
        sks.append(dim.sk)

    found = reduce(lambda a, b: a & b, [F.col(sk).isNotNull() for sk in sks])
    return rows.select(
        spec.grain,
        *([spec.sk] if surrogate else []),
        *[F.coalesce(F.col(sk), F.lit(UNKNOWN_SK).cast("long")).alias(sk) for sk in sks],
        *keep,
        *spec.carried,
        *spec.measure_names,
        F.when(found, F.lit(1)).otherwise(F.lit(0)).alias("is_valid"),
        *audit_columns(at),
        F.lit(spec.source).alias("source_system"),
        F.lit(bizdate).alias("pt"),
    )


def _falls_on(rows: DataFrame, column: str, day: str) -> Column:
    """Whether a date, a timestamp or an ISO string is on a day."""
    kind, value = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        return value.startswith(day)
    begin = F.lit(day).cast("date")
    if isinstance(kind, DateType):
        return value == begin
    return (value >= begin.cast(kind)) & (value < F.date_add(begin, 1).cast(kind))


def current_slice(dim: DataFrame, bizdate: str) -> DataFrame:
    """One day's rows of a dimension, active versions only where it has versions."""
    if "is_active" in dim.columns:
        return scd2_current(dim, bizdate)
    return dim.where(F.col("pt") == bizdate)


def derive_difference(
    df: DataFrame, minuend: str, subtrahend: str, name: str
) -> DataFrame:
    """Set measure ``name`` to ``minuend - subtrahend`` instead of the source column."""
    kind = df.schema[minuend].dataType
    return df.withColumn(name, (F.col(minuend) - F.col(subtrahend)).cast(kind))


def _source_columns(spec: FactSpec, keep: tuple[str, ...]) -> list[str]:
    fks = [fk for _, fk in spec.lookups]
    return list(
        dict.fromkeys([spec.grain, *fks, *keep, *spec.carried, *spec.measure_names])
    )


def _day_number(value: Column) -> Column:
    return F.datediff(F.to_date(value), F.lit("1970-01-01").cast("date"))


def as_of_lookup(
    rows: DataFrame,
    versions: DataFrame,
    fk: str,
    day: str,
    key: str,
    sk: str,
    *,
    begin: str = "begin_date",
    end: str = "end_date",
    most_buckets: int = 64,
    hot_share: float = 1e-3,
    salts: int = 16,
) -> DataFrame:
    """``rows`` with ``sk`` of the version whose half-open [begin, end) holds the row's day.

    A point-in-time lookup, beside the current-version one of :func:`load_fact`: each
    row meets the version of its key that was valid on its own ``day``. It is an
    equi-join on (key, day bucket, salt) with the interval as a further condition, so
    no key meets all of its versions at once and nothing is crossed:

    - the rows' days span at most ``most_buckets`` buckets; a version is copied into
      the buckets it overlaps within that span, and versions outside it are dropped;
    - a key that holds at least ``hot_share`` of the rows (so at most 1 / hot_share
      keys, the bound of the list that reaches the driver) is split further: its rows
      are dealt to ``salts`` parts by a hash of the row, and its versions copied to
      each part.

    Rows whose key or day is NULL, or whose key has no version valid that day, get
    NULL. Versions of one key must not overlap (the history dimension guarantees it);
    otherwise a row would meet each.
    """
    d = _day_number(F.col(day))
    stats = rows.agg(F.min(d).alias("lo"), F.max(d).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, n = stats["lo"], stats["hi"], stats["n"]
    if lo is None:
        return rows.withColumn(sk, F.lit(None).cast(versions.schema[sk].dataType))
    width = max(1, -(-(hi - lo + 1) // most_buckets))
    per_key = rows.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    hot = [r[0] for r in per_key.where(F.col("__n") >= max(1.0, n * hot_share)).where(F.col(fk).isNotNull()).collect()]
    is_hot = F.col(fk).isin(hot) if hot else F.lit(False)

    def bucket(value: Column) -> Column:
        return F.floor((value - F.lit(lo)) / F.lit(width))

    salt = F.when(is_hot, F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts))).otherwise(0)
    tagged = rows.withColumns({"__d": d, "__b": bucket(d), "__s": salt})
    vb, ve = _day_number(F.col(begin)), _day_number(F.col(end))
    span = versions.select(F.col(key).alias("__k"), F.col(sk).alias("__sk"), vb.alias("__vb"), ve.alias("__ve"))
    span = span.where((F.col("__ve") > lo) & (F.col("__vb") <= hi))
    first = bucket(F.greatest(F.col("__vb"), F.lit(lo)))
    last = bucket(F.least(F.col("__ve") - 1, F.lit(hi)))
    hot_versions = F.col("__k").isin(hot) if hot else F.lit(False)
    copies = span.select(
        "*",
        F.explode(F.sequence(first, last)).alias("__vbk"),
    ).select(
        "*",
        F.explode(F.when(hot_versions, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("__vs"),
    )
    joined = tagged.join(
        copies,
        (F.col(fk) == F.col("__k"))
        & (F.col("__b") == F.col("__vbk"))
        & (F.col("__s") == F.col("__vs"))
        & (F.col("__vb") <= F.col("__d"))
        & (F.col("__d") < F.col("__ve")),
        "left",
    )
    return joined.select(*[tagged[c] for c in rows.columns], F.col("__sk").alias(sk))
