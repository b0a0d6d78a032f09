"""Changes between two published copies of a table: what a cumulative extract adds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, CHANGED, GONE = "inserted", "changed", "gone"


def copy_changes(
    before: DataFrame,
    after: DataFrame,
    key: str,
    *,
    columns: Sequence[str] | None = None,
    ignore: Sequence[str] = ("pt",),
) -> DataFrame:
    """One row (``key``, ``change``) per key inserted, changed or gone from ``before`` to ``after``.

    Only the key and a SHA-256 digest of the other columns (as JSON, so NULL and ''
    differ) cross the shuffle of the full outer join; unchanged keys give no row.
    The compared columns are ``columns``, by default those of ``after`` but the key and
    ``ignore`` (give the source's own columns where copies carry load stamps);
    ``before`` must have them all. Keys are unique in each copy (landing refuses repeats); rows
    with a NULL key cannot be matched and are left out (``unkeyed_rows`` gives them).
    """
    names = after.columns if columns is None else columns
    compared = [c for c in names if c != key and c not in ignore]
    missing = [c for c in compared if c not in before.columns]
    if missing:
        raise ValueError(f"the earlier copy lacks {missing}")

    def digested(df: DataFrame, name: str) -> DataFrame:
        body = F.sha2(F.to_json(F.struct(*[F.col(c) for c in compared])), 256)
        return df.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), body.alias(name))

    joined = digested(before, "__old").join(digested(after, "__new"), "__k", "full")
    change = (
        F.when(F.col("__old").isNull(), F.lit(INSERTED))
        .when(F.col("__new").isNull(), F.lit(GONE))
        .when(F.col("__old") != F.col("__new"), F.lit(CHANGED))
    )
    return joined.select(F.col("__k").alias(key), change.alias("change")).where("change IS NOT NULL")
