"""Minimal keys of several columns and references found without a list."""

import itertools
import random
from decimal import Decimal

from starflow.operators.profiling import find_references, minimal_keys


def plain_minimal_keys(rows, names, most):
    keys = []
    for k in range(1, most + 1):
        for s in itertools.combinations(range(len(names)), k):
            if any(set(x) <= set(s) for x in keys):
                continue
            values = [tuple(r[i] for i in s) for r in rows]
            if rows and all(None not in v for v in values) and len(set(values)) == len(values):
                keys.append(s)
    return sorted(", ".join(names[i] for i in s) for s in keys)


def test_minimal_keys_equal_a_search_of_all_sets(spark):
    rng = random.Random(4)
    names = ["a", "b", "c", "d", "e"]
    rows = [(i // 10, i % 10, rng.randint(0, 3), rng.choice([None, 1]), i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    got = sorted(r.key_columns for r in minimal_keys(df, "t", most=3).collect())
    assert got == plain_minimal_keys(rows, names, 3)
    assert "a, b" in got and not any("d" in k for k in got)


def test_a_table_without_key_says_so(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    assert [tuple(r) for r in minimal_keys(df, "t").collect()] == [("t", None, 0, 2)]
    assert [tuple(r) for r in minimal_keys(df.limit(0), "t").collect()] == [("t", None, 0, 0)]


def test_references_compare_values_across_types(spark):
    parent = spark.createDataFrame([(Decimal(i), f"k{i}") for i in range(10)], "id decimal(38,10), code string")
    child = spark.createDataFrame(
        [(i % 10, f"k{i % 3}", None if i % 4 else 3) for i in range(30)] + [(None, None, None)],
        "ref bigint, code_ref string, sparse int",
    )
    other = spark.createDataFrame([(i, i + 100) for i in range(5)], "n int, far int")
    got = {tuple(r)[:4]: r.distinct_keys for r in find_references({"p": parent, "c": child, "o": other}).collect()}
    assert got[("c", "ref", "p", "id")] == 10
    assert got[("c", "code_ref", "p", "code")] == 3
    assert got[("c", "sparse", "p", "id")] == 1
    assert got[("o", "n", "p", "id")] == 5
    assert ("o", "far", "p", "id") not in got  # out of range
    assert ("p", "id", "o", "n") not in got  # 5..9 missing


def test_references_have_recall_one_against_all_pairs(spark):
    rng = random.Random(9)
    tables, plain = {}, {}
    for t in range(4):
        rows = [(i, rng.randint(0, 40), rng.randint(0, 400), rng.choice([None, rng.randint(0, 20)])) for i in range(60)]
        plain[f"t{t}"] = rows
        tables[f"t{t}"] = spark.createDataFrame(rows, "id int, x int, y bigint, z int")
    got = {tuple(r)[:4] for r in find_references(tables).collect()}
    want = set()
    cols = ["id", "x", "y", "z"]
    for pt, prow in plain.items():
        for pi, pc in enumerate(cols):
            pv = [r[pi] for r in prow]
            if None in pv or len(set(pv)) != len(pv):
                continue
            for ct, crow in plain.items():
                for ci, cc in enumerate(cols):
                    cv = {r[ci] for r in crow} - {None}
                    if (ct, cc) != (pt, pc) and cv and cv <= set(pv):
                        want.add((ct, cc, pt, pc))
    assert got == want and want


def test_reference_matches_meet_across_number_types(spark):
    from starflow.operators.profiling import reference_matches

    child = spark.createDataFrame([(i,) for i in range(10)], "fk bigint")
    parent = spark.createDataFrame([(Decimal(i),) for i in range(10)], "k decimal(38,10)")
    (r,) = reference_matches({"c": child}, {"p": (parent, "k")}, [("c", "fk", "p")]).collect()
    assert (r.matched_rows, r.unmatched_keys) == (10, 0)


def test_keys_refuted_by_a_witness_move_no_rows(spark, monkeypatch):
    """A set with repeats is refuted in a part of its hash space; only the rest is counted whole."""
    from starflow.operators import profiling

    monkeypatch.setattr(profiling, "_WITNESS_VALUES", 64)
    whole, plain = [], profiling._set_rows

    def seen(df, sets, share=1):
        if share == 1:
            whole.extend(sets)
        return plain(df, sets, share)

    monkeypatch.setattr(profiling, "_set_rows", seen)
    # (a, c): 2,000 pairs for 4,000 rows, each held twice; (a, b) is the key.
    df = spark.range(4000).selectExpr("id div 2 AS a", "id % 2 AS b", "id div 2 % 7 AS c")
    assert [r.key_columns for r in minimal_keys(df, "t").collect()] == ["a, b"]
    assert ("a", "b") in whole and ("a", "c") not in whole and ("a",) not in whole


def test_references_read_a_table_once_a_step(spark, monkeypatch):
    """A column's values are taken once, whatever the number of columns and of parents."""
    from starflow.operators import profiling

    stacked, plain = [], profiling.union_all

    def seen(frames):
        stacked.append(len(frames))
        return plain(frames)

    monkeypatch.setattr(profiling, "union_all", seen)
    a = spark.range(20).selectExpr("id AS k", "id AS same", "id % 5 AS few", "id % 3 AS less")
    b = spark.range(50).selectExpr("id AS k", "id % 20 AS a_k", "date'2026-01-01' AS day")
    got = {tuple(r)[:4]: r.distinct_keys for r in find_references({"a": a, "b": b}).collect()}
    assert got[("b", "a_k", "a", "k")] == got[("b", "a_k", "a", "same")] == 20
    assert got[("a", "few", "b", "k")] == 5 and ("b", "k", "a", "k") not in got
    assert max(stacked) <= 2


def test_whole_numbers_are_matched_without_decimals(spark):
    from starflow.operators.profiling import reference_matches

    child = spark.sql("SELECT * FROM VALUES (1, 7), (-2, 7), (NULL, 8), (5, NULL) AS t(a, b)")
    parent = spark.createDataFrame([(1,), (-2,), (7,)], "k bigint")
    got = reference_matches({"c": child}, {"p": (parent, "k")}, [("c", "a", "p"), ("c", "b", "p")])
    assert "decimal(38,10)" not in got._jdf.queryExecution().toString()
    rows = {r.reference: (r.child_rows, r.null_rows, r.matched_rows, r.unmatched_keys) for r in got.collect()}
    assert rows == {"c.a": (4, 1, 2, 1), "c.b": (4, 1, 2, 1)}
