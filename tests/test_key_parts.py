"""Column sets are refuted in parts of the rows that a column's hash cuts out, exactly."""

import random

import pytest

from starflow.operators import profiling
from starflow.operators.profiling import minimal_keys
from tests.test_key_search import plain_minimal_keys


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(profiling, "_WITNESS_VALUES", 8)
    monkeypatch.setattr(profiling, "_WITNESS_ROUNDS", (1, 4))
    monkeypatch.setattr(profiling, "_PART_VALUES", 2)


@pytest.mark.parametrize("seed", range(3))
def test_keys_equal_a_search_of_all_sets_when_parts_are_searched(spark, small, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "e"]
    hot = [rng.choice([0, rng.randint(1, 60)]) for _ in range(300)]
    rows = [(hot[i], i % 50, rng.randint(0, 9), f"t{rng.randint(0, 40)}", float(i // 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c bigint, d string, e double")
    got = sorted(r.key_columns for r in minimal_keys(df, "t", most=3).collect())
    assert got == plain_minimal_keys(rows, names, 3) and "b, e" in got


def test_a_set_is_searched_in_a_part_cut_by_one_column(spark, small, monkeypatch):
    """Rows outside a part are hashed once a column; before, once for every set."""
    plans, plain = [], profiling.union_all

    def seen(frames):
        plans.extend(f._jdf.queryExecution().optimizedPlan().toString() for f in frames if "v" in f.columns)
        return plain(frames)

    monkeypatch.setattr(profiling, "union_all", seen)
    df = spark.range(4000).selectExpr("id div 2 AS a", "id % 2 AS b", "id div 2 % 700 AS c", "id % 900 AS d")
    assert "a, b" in [r.key_columns for r in minimal_keys(df, "t").collect()]
    assert plans
    for plan in plans:
        below = plan[plan.index("Generate") :]
        assert "Filter" in below and "xxhash64" in below[below.index("Filter") :]


def test_a_part_of_a_frequent_value_is_thinned(spark, small):
    """Most rows hold one value of the column that cuts the parts, in the part that is read."""
    shown = [n for n in range(400) if spark.range(1).selectExpr(f"pmod(xxhash64({n}L), 8) AS p").first().p == 0][:1]
    df = spark.range(4000).selectExpr(f"if(id % 4 = 0, id + 1000, {shown[0]}) AS a", "id % 4 AS b", "id div 4 AS c")
    assert [r.key_columns for r in minimal_keys(df, "t").collect()] == ["b, c"]
