import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starflow.operators import keys
from starflow.operators.keys import dense_key


def ranges(df, order, name="sk", **options):
    return dense_key(df, order, name, **{"ranges": 20, **options})


def rows_by_range(keyed):
    """Rows of each range that was written."""
    spark = keyed.sparkSession
    return [spark.read.parquet(f).count() for f in set(keyed.inputFiles())]


def assert_dense_in_order(rows, order, start=0):
    rows = sorted(rows, key=lambda r: r["sk"])
    assert [r["sk"] for r in rows] == list(range(start + 1, start + len(rows) + 1))
    values = [tuple((r[c] is not None, r[c]) for c in order) for r in rows]
    assert values == sorted(values)


def test_small_input(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k bigint")
    got = {r.k: r.sk for r in dense_key(df, "k", "sk", start=10).collect()}
    assert got == {1: 11, 2: 12, 3: 13}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k bigint")
    assert dense_key(df, "k", "sk").collect() == []


def test_ranges_equal_the_global_window(spark):
    values = random.Random(1).sample(range(10**12), 3000)
    df = spark.createDataFrame([(v,) for v in values], "k bigint").repartition(7)
    got = {r.k: r.sk for r in ranges(df, "k", start=5).collect()}
    assert got == {v: i + 6 for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("kind", ["string", "double", "date", "decimal(12,2)", "timestamp"])
def test_key_types(spark, kind):
    df = spark.range(1000).select(
        {
            "string": F.concat(F.lit("k'\""), F.hex("id")),
            "double": F.sqrt("id"),
            "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
            "decimal(12,2)": (F.col("id") / 7).cast("decimal(12,2)"),
            "timestamp": F.timestamp_seconds(F.col("id") * 1000.000001),
        }[kind].alias("k")
    )
    assert df.schema["k"].dataType.simpleString() == kind
    assert_dense_in_order(ranges(df, "k").collect(), ["k"])


def test_null_keys_come_first(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("k"))
    rows = ranges(df, "k").collect()
    assert_dense_in_order(rows, ["k"])
    assert max(r.sk for r in rows if r.k is None) == 250


def test_several_order_columns(spark):
    rnd = random.Random(2)
    data = [
        (rnd.randrange(20), rnd.choice("abc"), datetime(2020, 1, rnd.randrange(1, 28)))
        for _ in range(2000)
    ]
    df = spark.createDataFrame(data, "a bigint, b string, c timestamp")
    assert_dense_in_order(ranges(df, ["a", "b", "c"]).collect(), ["a", "b", "c"])


def test_hot_key_is_split_between_ranges(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("payload"),
    )
    keyed = ranges(df, "k")
    rows = keyed.collect()
    assert_dense_in_order(rows, ["k"])
    assert len({r.payload for r in rows}) == 6000
    assert max(rows_by_range(keyed)) < 6000 / 8


def test_long_decimals_spread_over_all_ranges(spark):
    """26 digits and microseconds: more than a double or a millisecond can tell apart."""
    df = spark.range(2000).select(
        (F.col("id").cast("decimal(38,10)") / F.lit(10**9).cast("decimal(12,0)")
         + F.lit(Decimal("1234567890123456.0"))).cast("decimal(38,10)").alias("k"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id")).alias("t"),
    )
    for column in ("k", "t"):
        keyed = ranges(df, column)
        assert_dense_in_order(keyed.collect(), [column])
        sizes = rows_by_range(keyed)
        assert len(sizes) >= 18 and max(sizes) < 300


def test_hot_copies_are_collapsed_and_spread(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_TASK", 100)
    monkeypatch.setattr(keys, "SAMPLED_SHARE", 0.5)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.hex("id")).alias("v"),
    )
    monkeypatch.setattr(keys, "HOT_ROWS", 500)
    assert keys.has_hot_copies(df.withColumn("__tie", F.xxhash64("k", "v")))
    keyed = ranges(df, "k")
    assert keyed.columns == ["k", "v", "sk"]
    rows = keyed.withColumn("task", F.spark_partition_id()).collect()
    assert_dense_in_order(rows, ["k"])
    assert sorted((r.k, r.v) for r in rows) == sorted(map(tuple, df.collect()))
    hot = [r.task for r in rows if r.k == 77]
    assert max(hot.count(t) for t in set(hot)) < 1000


def test_all_rows_alike(spark):
    df = spark.range(500).select(F.lit(Decimal("1.50")).alias("k"))
    assert_dense_in_order(ranges(df, "k").collect(), ["k"])


def test_numbers_are_fixed_once_written(spark):
    keyed = ranges(spark.range(2000), "id")
    plan = keyed._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan[plan.index("== Physical Plan ==") :]
    assert keyed.collect() == keyed.collect()


def test_equal_keys_are_numbered_the_same_way_again(spark):
    df = spark.range(2000).selectExpr("id % 50 AS k", "hex(id) AS v")
    numbered = []
    for parts in (3, 11):
        keyed = ranges(df.repartition(parts), "k")
        assert keyed.columns == ["k", "v", "sk"]
        numbered.append({r.v: r.sk for r in keyed.collect()})
    assert numbered[0] == numbered[1]


def test_many_rows_make_few_files(spark):
    keyed = dense_key(spark.range(300_000), "id", "sk", unique=True)
    assert len(keyed.inputFiles()) <= 8


def test_rows_move_once_and_without_their_hash(spark):
    """The counts of the ranges go to the rows, and the hash of a row is not written."""
    off = {f"spark.sql.{a}autoBroadcastJoinThreshold": "-1" for a in ("", "adaptive.")}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        df = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
        keyed = ranges(df, "k")
        assert "SortMergeJoin" not in keyed._jdf.queryExecution().executedPlan().toString()
        assert spark.read.parquet(*keyed.inputFiles()).columns == ["k", "v", "__place"]
        assert_dense_in_order(keyed.collect(), ["k"])
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
