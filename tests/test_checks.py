from decimal import Decimal

from starflow.operators import checks, profiling


def test_grain(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1)], "a int, b int")
    row = checks.grain_unique(df, ["a", "b"], "f").first()
    assert (row.row_count, row.distinct_keys) == (4, 3)
    assert (row.repeated_keys, row.surplus_rows) == (1, 1)
    assert [tuple(r) for r in checks.repeated_grain(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_grain_of_nothing(spark):
    row = checks.grain_unique(spark.createDataFrame([], "a int"), ["a"], "f").first()
    assert (row.row_count, row.distinct_keys, row.surplus_rows) == (0, 0, 0)


def test_join_miss_and_matrix(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1,), (3,)], "id bigint")
    miss = checks.join_miss(fact, "k", dim, "id", "f", "d")
    row = miss.first()
    assert (row.fact_rows, row.missed_rows, row.miss_rate) == (4, 2, Decimal("0.5"))
    matrix = checks.coverage_matrix(miss, ["d", "e"]).first()
    assert matrix.asDict() == {"fact_name": "f", "d": Decimal("0.5"), "e": None}


def test_conformed_attribute(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (9, "z")], "k int, n string")
    dim = spark.createDataFrame([(1, "a"), (2, "")], "id int, m string")
    row = checks.conformed_attribute(fact, "k", "n", dim, "id", "m").first()
    assert (row.agreeing_rows, row.disagreeing_rows, row.unmatched_rows) == (2, 1, 1)


def test_one_to_one(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    row = checks.one_to_one(left, "k", right, "k", "m").first()
    assert (row.source_rows, row.target_rows) == (4, 3)
    assert (row.source_only_keys, row.target_only_keys, row.repeated_keys) == (1, 1, 1)


def test_broken_histories_are_counted(spark):
    end = "9999-12-31"
    rows = [
        (1, "2026-01-01", "2026-01-03", 0),
        (1, "2026-01-02", end, 1),  # overlaps the first
        (2, "2026-01-01", "2026-01-02", 0),
        (2, "2026-01-03", end, 1),  # gap before it
        (3, "2026-01-01", "2026-01-02", 0),  # no active version
        (4, "2026-01-01", end, 1),
        (4, "2026-01-01", end, 1),  # a copy
        (5, "2026-01-01", end, 0),  # open but not active
        (6, "2026-01-02", "2026-01-02", 0),
        (6, "2026-01-02", end, 1),  # empty interval before it
    ]
    dim = spark.createDataFrame(
        rows, "id int, begin_date string, end_date string, is_active int"
    )
    row = checks.scd2_intervals(dim, "id", "d").first()
    assert (row.versions, row["keys"]) == (10, 6)
    assert row.keys_not_one_active == 3
    assert (row.overlaps, row.gaps) == (2, 1)
    assert (row.open_mismatches, row.empty_intervals) == (1, 1)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a bigint, b string")
    got = [tuple(r) for r in profiling.column_profile(df, "t").orderBy("position").collect()]
    assert got == [
        ("t", "a", 1, "bigint", 3, 0, Decimal("0.000000")),
        ("t", "b", 2, "string", 3, 2, Decimal("0.666667")),
    ]
    assert profiling.row_counts({"t": df}).first().asDict() == {
        "table_name": "t",
        "row_count": 3,
    }


def test_empty_table_profile(spark):
    df = spark.createDataFrame([], "a bigint")
    row = profiling.null_rates(df, "t").first()
    assert (row.row_count, row.null_rate) == (0, None)
    assert profiling.candidate_keys(df, "t").first().is_key is False


def test_candidate_keys(spark):
    df = spark.range(5000).selectExpr(
        "id AS unique",
        "if(id = 17, 16, id) AS nearly",
        "if(id = 17, null, id) AS with_null",
        "id % 7 AS few",
        "cast(id AS string) AS text",
    )
    got = {r.column_name: r.is_key for r in profiling.candidate_keys(df, "t").collect()}
    assert got == {
        "unique": True,
        "nearly": False,
        "with_null": False,
        "few": False,
        "text": True,
    }


def test_reference_match(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (5,)], "id int")
    row = profiling.reference_match(child, "fk", parent, "id", "r").first()
    assert (row.child_rows, row.null_rows, row.matched_rows) == (4, 1, 2)
    assert (row.distinct_keys, row.unmatched_keys) == (2, 1)
    assert row.match_rate == Decimal("0.666667")


def test_references_together_equal_references_alone(spark):
    child = spark.createDataFrame([(1, 5), (1, None), (2, 9), (None, 5)], "a int, b int")
    parent = spark.createDataFrame([(1,), (1,), (5,)], "id int")
    other = spark.createDataFrame([(9,)], "id int")
    references = (("c", "a", "p"), ("c", "b", "p"), ("c2", "b", "o"))
    got = profiling.reference_matches(
        {"c": child, "c2": child}, {"p": (parent, "id"), "o": (other, "id")}, references
    )
    want = [
        profiling.reference_match(child, fk, {"p": parent, "o": other}[p], "id", f"{c}.{fk}").first()
        for c, fk, p in references
    ]
    assert sorted(map(tuple, got.collect())) == sorted(
        tuple(r[c] for c in got.columns) for r in want
    )


def test_failed_lookups_of_a_loaded_fact(spark):
    fact = spark.createDataFrame([(1, -1), (-1, -1), (2, 3)], "user_sk long, shop_sk long")
    rows = checks.lookup_miss(fact, "f", {"user": "user_sk", "shop": "shop_sk"}).collect()
    assert {(r.dim_name, r.fact_rows, r.missed_rows, r.miss_rate) for r in rows} == {
        ("user", 3, 1, Decimal("0.333333")),
        ("shop", 3, 2, Decimal("0.666667")),
    }


def test_nested_intervals_overlap_each_time(spark):
    history = spark.createDataFrame(
        [
            (1, "2026-01-01", "9999-12-31", 1),
            (1, "2026-02-01", "2026-02-05", 0),
            (1, "2026-03-01", "2026-03-05", 0),
            (2, "2026-01-01", "2026-01-10", 0),
            (2, "2026-01-12", "9999-12-31", 1),
        ],
        "id int, begin_date string, end_date string, is_active int",
    )
    row = checks.scd2_intervals(history, "id", "d").first()
    assert (row.overlaps, row.gaps) == (2, 1)
