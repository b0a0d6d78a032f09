"""Dense surrogate keys: ``row_number() over (order by key)`` without one global sort.

A window with no partition puts every row into one task. Here rows are dealt to key
ranges by Spark's range partitioning and sorted inside them, whatever the size of the
table; adaptive execution merges small ranges up to its advisory size in bytes. The
result is written once with each row's range and place in it, so that numbers cannot
change when the work of a lost executor is redone. Counts of the ranges then give the
offsets to add.

Rows with equal keys are ordered by a hash of the row, which also splits a key that
holds many rows. When a sample shows that whole-row copies are what is hot, copies are
collapsed to (row, count) before the shuffle, numbered by running count and spread out
again afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.sources.storage import materialise

COPIES_PER_TASK = 1 << 20
SAMPLED_SHARE = 0.01
HOT_SHARE = 0.02
HOT_ROWS = 1_000

_TIE = "__tie"
_COPIES = "__copies"
_PLACE = "__place"
_RANGE = "__range"
_FIRST = "__first"

# monotonically_increasing_id() is the task number and, in this many low bits, the row.
_ROW_BITS = 33


def dense_key(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str,
    start: int = 0,
    *,
    unique: bool = False,
    ranges: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Append ``name``: ``start`` + the 1-based rank of the row by ``order_by``.

    Rows with equal keys get consecutive numbers, in no order to rely on. ``unique``
    says that no two rows share a key, which saves hashing the other columns.
    ``ranges`` sets the number of ranges instead of the shuffle settings. The written
    rows go below ``folder`` (see :func:`materialise`).
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    everything = df.columns
    tie = F.xxhash64(*everything)
    # Rows that agree in every column are copies, which a hash cannot tell apart.
    tied = not unique and not set(everything) <= set(order)
    hot = not unique and has_hot_copies(df.select(tie.alias(_TIE)))
    rows = df.groupBy(*everything).agg(F.count(F.lit(1)).alias(_COPIES)) if hot else df

    # The hash is computed where rows are compared; it does not travel with them.
    settled = [*[F.col(c) for c in order], *([tie] if tied else [])]
    ranged = (
        rows.repartitionByRange(*([] if ranges is None else [ranges]), *settled)
        .sortWithinPartitions(*settled)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    placed = materialise(ranged, folder).withColumn(
        _RANGE, F.shiftright(_PLACE, _ROW_BITS).cast("int")
    )
    size = F.sum(_COPIES) if hot else F.count(F.lit(1))
    # One row for each range, so this window reads as many rows as there were tasks.
    before = F.sum("__n").over(
        Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(_RANGE)
        .agg(size.alias("__n"))
        .select(_RANGE, F.coalesce(before, F.lit(0)).alias("__before"))
    )
    inside = _running_copies() if hot else F.col(_PLACE).bitwiseAND((1 << _ROW_BITS) - 1)
    number = inside + F.col("__before") + F.lit(start + 1).cast("long")
    # One row for each range here too; unless told, Spark shuffles the rows to find out.
    numbered = placed.join(F.broadcast(offsets), _RANGE).withColumn(_FIRST if hot else name, number)
    if hot:
        numbered = _spread_copies(numbered, name)
    return numbered.select(*everything, name)


def has_hot_copies(tied: DataFrame) -> bool:
    """Whether a sample is full of copies of one row. Either answer gives the same
    numbers; it only decides how copies travel."""
    counts = tied.select(_TIE).sample(fraction=SAMPLED_SHARE, seed=7).groupBy(_TIE).count()
    most, total = counts.agg(F.max("count"), F.sum("count")).first()
    return bool(total) and most * SAMPLED_SHARE**-1 >= HOT_ROWS and most >= HOT_SHARE * total


def _running_copies() -> Column:
    """Copies before a row of its range."""
    earlier = Window.partitionBy(_RANGE).orderBy(_PLACE)
    before = F.sum(_COPIES).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(before, F.lit(0))


def _spread_copies(firsts: DataFrame, name: str) -> DataFrame:
    """One row per copy again: cut each count into blocks, deal them out, then expand."""
    block = F.lit(COPIES_PER_TASK).cast("long")
    last = F.col(_FIRST) + F.col(_COPIES) - F.lit(1)
    blocks = firsts.withColumn(
        "__from", F.explode(F.sequence(F.col(_FIRST), last, block))
    ).withColumn("__to", F.least(F.col("__from") + block - F.lit(1), last))
    tasks = int(firsts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number is given: by their bytes, adaptive execution would merge the blocks.
    spread = blocks.repartition(tasks, F.col("__from"))
    return spread.withColumn(name, F.explode(F.sequence("__from", "__to")))
