"""Change predicates used by the history merge and the attribute checks.

Strings treat NULL and '' as equal, all other types compare null-safely, so a
numeric NULL that becomes a value (or the reverse) counts as a change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType


def differs(old: Column, new: Column, dtype: DataType) -> Column:
    if isinstance(dtype, StringType):
        return F.coalesce(old, F.lit("")) != F.coalesce(new, F.lit(""))
    return ~old.eqNullSafe(new)


def any_differs(
    columns: Iterable[str],
    schema: StructType,
    old: Callable[[str], Column],
    new: Callable[[str], Column],
) -> Column:
    """OR over ``columns``; ``old(name)`` and ``new(name)`` give the two sides."""
    tests = [differs(old(c), new(c), schema[c].dataType) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
