"""Dimension loads: overwrite in place, and full history with validity intervals.

A history dimension is one full copy per day. Its versions carry half-open
intervals ``[begin_date, end_date)``; the open one ends at ``OPEN_END`` and is
the only active one. A merge reads the latest earlier copy and today's snapshot:

* a new key opens a version,
* a changed key closes its active version and opens another,
* an unchanged key keeps its version, with untracked attributes refreshed,
* a key missing from the snapshot, and every closed version, is carried as it is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.functions import any_differs, audit_columns, load_time
from starflow.operators.keys import dense_key
from starflow.sources.storage import materialise
from starflow.specs import DimSpec

# Fixed value: the end date of a version that is still open.
OPEN_END = "9999-12-31"


class DuplicateKeyError(ValueError):
    """A snapshot holds more than one row for a business key."""


class MissingDayError(ValueError):
    """A load found no rows of its day in a partitioned source."""


class MissingKeyError(ValueError):
    """A snapshot holds rows without a business key."""


def scd1_load(
    src: DataFrame,
    spec: DimSpec,
    bizdate: str,
    at: datetime | None = None,
    *,
    leave_out_unkeyed: bool = False,
    allow_empty: bool = False,
) -> DataFrame:
    """Replace the dimension by today's snapshot, numbering keys afresh.

    As in a history merge, only the day's rows of a partitioned source are read, a
    repeated key is refused (it would multiply every fact row that refers to it), and
    so is a row without a key unless the caller chose to leave such rows out.
    """
    src = of_day(src, bizdate)
    require_one_row_per_key(src, spec.key, leave_out_unkeyed, day=_partitioned(src, bizdate, allow_empty))
    snapshot = _snapshot(src, spec)
    keyed = dense_key(snapshot, spec.key, spec.sk, unique=True)
    return keyed.select(
        spec.sk,
        spec.key,
        *spec.attributes,
        *audit_columns(at),
        F.lit(bizdate).alias("pt"),
    )


def scd2_merge(
    prev: DataFrame | None,
    src: DataFrame,
    spec: DimSpec,
    bizdate: str,
    *,
    overwrite_scd1: bool = True,
    at: datetime | None = None,
    leave_out_unkeyed: bool = False,
    allow_empty: bool = False,
) -> DataFrame:
    """Today's full copy of a history dimension.

    ``prev`` is the latest copy before ``bizdate`` (None on the first load), so
    loading a day twice gives the same result. Of a partitioned ``src`` the day's rows
    are read. More than one row for a key is refused, and so is a row without one,
    unless ``leave_out_unkeyed`` (see :func:`unkeyed_rows`).

    Three shuffles on the business key: counts of the keys for the check, key and
    tracked columns for finding what to open, and whole rows. In the last the numbered
    keys join the snapshot first, which keeps its partitioning for the full outer join
    with the active versions.
    """
    src = of_day(src, bizdate)
    require_one_row_per_key(src, spec.key, leave_out_unkeyed, day=_partitioned(src, bizdate, allow_empty))
    snapshot = _snapshot(src, spec)
    if prev is None:
        keyed = dense_key(snapshot, spec.key, spec.sk, unique=True)
        return _opened(keyed, spec, bizdate, at)

    prev = prev.select(*_version_columns(spec))
    active = scd2_active(prev)
    numbered = _numbered_openings(prev, snapshot, spec)

    new = snapshot.join(numbered.withColumnRenamed(spec.sk, "__new_sk"), spec.key, "left")
    old, new = active.alias("old"), new.alias("new")
    pairs = old.join(new, F.col(f"old.{spec.key}") == F.col(f"new.{spec.key}"), "full")

    versions = F.array(
        _old_version(spec, prev, bizdate, overwrite_scd1, at),
        _new_version(spec, bizdate, at),
    )
    # A pair without an old or an opened version leaves that one without a key.
    merged = pairs.select(F.inline(versions)).where(F.col(spec.sk).isNotNull())
    closed_before = prev.where(F.col("is_active") == 0)
    return merged.unionByName(closed_before).withColumn("pt", F.lit(bizdate))


def scd2_new(
    prev: DataFrame | None,
    src: DataFrame,
    spec: DimSpec,
    bizdate: str,
    at: datetime | None = None,
) -> DataFrame:
    """Only the versions that today's snapshot opens (new and changed keys)."""
    snapshot = _snapshot(of_day(src, bizdate), spec)
    if prev is None:
        keyed = dense_key(snapshot, spec.key, spec.sk, unique=True)
    else:
        keyed = snapshot.join(_numbered_openings(prev, snapshot, spec), spec.key)
    return _opened(keyed, spec, bizdate, at)


def scd2_changed(
    prev: DataFrame,
    src: DataFrame,
    spec: DimSpec,
    bizdate: str,
    at: datetime | None = None,
) -> DataFrame:
    """Only the versions that today's snapshot closes."""
    old = scd2_active(prev).alias("old")
    new = _snapshot(of_day(src, bizdate), spec).alias("new")
    changed = old.join(new, _same_key(spec) & _tracked_differ(spec, prev), "left_semi")
    return changed.select(
        spec.sk,
        spec.key,
        *spec.attributes,
        "begin_date",
        *_closing(bizdate),
        "etl_insert_time",
        load_time(at).alias("etl_update_time"),
        F.lit(bizdate).alias("pt"),
    )


def scd2_carry(
    prev: DataFrame, changed: DataFrame, spec: DimSpec, bizdate: str
) -> DataFrame:
    """All earlier versions but those just closed, matched by surrogate key."""
    kept = prev.join(changed.select(spec.sk), spec.sk, "left_anti")
    return kept.select(*_version_columns(spec)).withColumn("pt", F.lit(bizdate))


def scd2_active(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_active") == 1)


def scd2_current(dim: DataFrame, bizdate: str) -> DataFrame:
    """The active versions of one day's copy."""
    return dim.where((F.col("pt") == bizdate) & (F.col("is_active") == 1))


def scd2_as_of(dim: DataFrame, day: str) -> DataFrame:
    """The versions valid on ``day``, by the half-open interval."""
    return dim.where((F.col("begin_date") <= day) & (F.col("end_date") > day))


def unkeyed_rows(src: DataFrame, spec: DimSpec) -> DataFrame:
    """Source rows that have no business key."""
    return src.where(F.col(spec.key).isNull())


def of_day(src: DataFrame, bizdate: str) -> DataFrame:
    """The rows of one day, where the source has a partition column ``pt``."""
    return src.where(F.col("pt") == bizdate) if "pt" in src.columns else src


def _partitioned(src: DataFrame, bizdate: str, allow_empty: bool) -> str | None:
    """The day that must have rows: that of a partitioned source, unless allowed empty."""
    return None if allow_empty or "pt" not in src.columns else bizdate


def require_one_row_per_key(
    snapshot: DataFrame, key: str, leave_out_unkeyed: bool = False, *, day: str | None = None
) -> None:
    """Raise when a key occurs twice, or when rows without a key are not allowed.

    With ``day``, a snapshot without rows raises too (the source lacks that day). Reads
    the key only, and counts repeats map-side before the shuffle.
    """
    per_key = snapshot.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    given = F.col(key).isNotNull()
    most = F.max_by(F.struct(key, "__n"), F.when(given, F.col("__n")))
    unkeyed, worst, rows = per_key.agg(F.sum(F.when(~given, F.col("__n"))), most, F.sum("__n")).first()
    if day is not None and not rows:
        raise MissingDayError(f"the source has no rows of {day}")
    if unkeyed and not leave_out_unkeyed:
        raise MissingKeyError(f"{unkeyed} rows have no {key}")
    if worst is not None and worst[key] is not None and worst["__n"] > 1:
        raise DuplicateKeyError(f"{key} {worst[key]} has {worst['__n']} rows")


def _version_columns(spec: DimSpec) -> list[str]:
    return [
        spec.sk,
        spec.key,
        *spec.attributes,
        "begin_date",
        "end_date",
        "is_active",
        "etl_insert_time",
        "etl_update_time",
    ]


def _snapshot(src: DataFrame, spec: DimSpec) -> DataFrame:
    keyed = src.where(F.col(spec.key).isNotNull())
    return keyed.select(spec.key, *spec.attributes)


def _same_key(spec: DimSpec) -> Column:
    return F.col(f"old.{spec.key}") == F.col(f"new.{spec.key}")


def _tracked_differ(spec: DimSpec, prev: DataFrame) -> Column:
    return any_differs(
        spec.tracked,
        prev.schema,
        lambda c: F.col(f"old.{c}"),
        lambda c: F.col(f"new.{c}"),
    )


def _numbered_openings(
    prev: DataFrame, snapshot: DataFrame, spec: DimSpec
) -> DataFrame:
    """(key, surrogate key) of the versions to open, continuing prev's numbers.

    Works on the key and the tracked columns only. The keys found are written out
    once, since numbering reads them more than once.
    """
    narrow = [spec.key, *spec.tracked]
    old = scd2_active(prev).select(*narrow).alias("old")
    new = snapshot.select(*narrow).alias("new")
    unchanged = _same_key(spec) & ~_tracked_differ(spec, prev)
    to_open = materialise(new.join(old, unchanged, "left_anti").select(spec.key))
    highest = prev.agg(F.coalesce(F.max(spec.sk), F.lit(0))).first()[0]
    return dense_key(to_open, spec.key, spec.sk, start=highest)


def _closing(bizdate: str) -> list[Column]:
    return [F.lit(bizdate).alias("end_date"), F.lit(0).alias("is_active")]


def _opening(bizdate: str, at: datetime | None) -> list[Column]:
    return [
        F.lit(bizdate).alias("begin_date"),
        F.lit(OPEN_END).alias("end_date"),
        F.lit(1).alias("is_active"),
        *audit_columns(at),
    ]


def _opened(
    keyed: DataFrame, spec: DimSpec, bizdate: str, at: datetime | None
) -> DataFrame:
    return keyed.select(
        spec.sk,
        spec.key,
        *spec.attributes,
        *_opening(bizdate, at),
        F.lit(bizdate).alias("pt"),
    )


def _new_version(spec: DimSpec, bizdate: str, at: datetime | None) -> Column:
    return F.struct(
        F.col("new.__new_sk").alias(spec.sk),
        *[F.col(f"new.{c}").alias(c) for c in (spec.key, *spec.attributes)],
        *_opening(bizdate, at),
    )


def _old_version(
    spec: DimSpec,
    prev: DataFrame,
    bizdate: str,
    overwrite_scd1: bool,
    at: datetime | None,
) -> Column:
    """The active version after the merge: closed, refreshed or as it was."""
    closes = F.col("new.__new_sk").isNotNull()
    refreshed = spec.refreshed if overwrite_scd1 else ()
    stays_in_source = F.col(f"new.{spec.key}").isNotNull() & ~closes
    refreshes = stays_in_source & any_differs(
        refreshed,
        prev.schema,
        lambda c: F.col(f"old.{c}"),
        lambda c: F.col(f"new.{c}"),
    )

    def attribute(c: str) -> Column:
        old = F.col(f"old.{c}")
        if c not in refreshed:
            return old.alias(c)
        return F.when(stays_in_source, F.col(f"new.{c}")).otherwise(old).alias(c)

    end_date, inactive = _closing(bizdate)
    return F.struct(
        F.col(f"old.{spec.sk}").alias(spec.sk),
        F.col(f"old.{spec.key}").alias(spec.key),
        *[attribute(c) for c in spec.attributes],
        F.col("old.begin_date").alias("begin_date"),
        F.when(closes, end_date).otherwise(F.col("old.end_date")).alias("end_date"),
        F.when(closes, inactive).otherwise(F.lit(1)).alias("is_active"),
        F.col("old.etl_insert_time").alias("etl_insert_time"),
        F.when(closes | refreshes, load_time(at))
        .otherwise(F.col("old.etl_update_time"))
        .alias("etl_update_time"),
    )
