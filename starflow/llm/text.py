"""Helpers shared by the text operators.

A word is ``[^\\x20\\x09-\\x0D]+`` everywhere in this package. ``bytes.split()`` cuts
at exactly these six ASCII characters, so Python tasks split encoded text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# glibc has this, other C libraries may not.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(pieces, lambda w: w != "")


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, under the names ``doc_id`` and ``text``."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def tidy() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` of a function on one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out
        tidy()

    return df.mapInArrow(run, schema)
