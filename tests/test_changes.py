"""Changes between two copies: inserted, changed, gone; NULL and '' differ."""

import pytest

from starflow.operators.changes import copy_changes

SCHEMA = "id long, a string, b int, pt string"


def test_changes_of_each_kind(spark):
    before = spark.createDataFrame(
        [(1, "x", 1, "d1"), (2, "y", None, "d1"), (3, None, 3, "d1"), (4, "z", 4, "d1"), (None, "n", 0, "d1")], SCHEMA
    )
    after = spark.createDataFrame(
        [(1, "x", 1, "d2"), (2, "y", 2, "d2"), (3, "", 3, "d2"), (5, "w", 5, "d2"), (None, "m", 0, "d2")], SCHEMA
    )
    got = sorted(tuple(r) for r in copy_changes(before, after, "id").collect())
    assert got == [(2, "changed"), (3, "changed"), (4, "gone"), (5, "inserted")]
    assert copy_changes(before.limit(0), after.limit(0), "id").collect() == []
    with pytest.raises(ValueError):
        copy_changes(before.drop("b"), after, "id")
