"""Joins are planned by the rows of their sides: files of few bytes may hold many rows."""

import pytest
from pyspark.sql import functions as F

from starflow.operators.facts import load_fact
from starflow.operators.sizes import join_side
from starflow.operators.summaries import summarise
from starflow.plans.bindings import Bindings
from starflow.plans.model import DIMS, FACTS, SUMMARIES
from starflow.plans.tables import table_schema
from starflow.sources.storage import publish, read_partition

DAY = "2026-07-07"
ROWS = 40_000  # 960,000 bytes as (key, surrogate key) rows, a few thousand in a file


@pytest.fixture
def threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def published(spark, root, name, rows):
    """A dimension of ``rows`` sequential keys and NULL attributes, read back from its files."""
    schema = table_schema(DIMS[name].table)
    known = {DIMS[name].key: "id", DIMS[name].sk: "id + 1", "is_active": "1", "pt": f"'{DAY}'"}
    columns = [f"CAST({known.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    publish(spark.range(0, rows, 1, 1).selectExpr(*columns), f"{root}/{name}", DAY)
    return read_partition(spark, f"{root}/{name}", DAY, schema=schema)


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def payments(spark):
    return spark.range(50).selectExpr(
        "id AS pay_id", "id * 1000 AS user_id", "'x' AS pay_type", "1 AS pay_status", "'d' AS pay_time",
        "CAST(id AS decimal(16,2)) AS pay_amount",
    )


def test_a_fact_shuffles_a_dimension_of_many_rows_in_small_files(spark, tmp_path, threshold):
    users = published(spark, tmp_path, "user", ROWS)
    fact = load_fact(payments(spark), {"user": users}, FACTS["payment"], DIMS, DAY, surrogate=False)
    assert "Broadcast" not in plan(fact) and "SortMergeJoin" in plan(fact)
    got = sorted((r.pay_id, r.user_sk, r.is_valid) for r in fact.collect())
    assert got == [(i, *((i * 1000 + 1, 1) if i < 40 else (-1, 0))) for i in range(50)]


def test_a_fact_still_broadcasts_a_small_dimension(spark, tmp_path, threshold):
    users = published(spark, tmp_path, "user", 1_000)
    fact = load_fact(payments(spark), {"user": users}, FACTS["payment"], DIMS, DAY, surrogate=False)
    assert "BroadcastHashJoin" in plan(fact)


def test_a_summary_shuffles_a_dimension_of_many_rows_in_small_files(spark, tmp_path, threshold):
    spec = SUMMARIES["inv_shop_sku"]
    dims = {d: published(spark, tmp_path, d, ROWS) for d in spec.grain}
    fact = spark.range(10).select(
        *[F.col("id").alias(DIMS[d].sk) for d in spec.grain],
        *[F.lit(1).alias(c) for c in dict.fromkeys(m.column for m in spec.metrics)],
        F.lit(1).alias("is_valid"),
        F.lit(DAY).alias("pt"),
    )
    total = summarise({f: fact for f in spec.facts}, dims, spec, DIMS, DAY, FACTS)
    assert "Broadcast" not in plan(total) and plan(total).count("SortMergeJoin") == len(dims)
    got = sorted((r.shop_id, r.sku_id) for r in total.where("shop_id IS NOT NULL").collect())
    assert got == [(i, i) for i in range(9)]


def test_order_lines_shuffle_parts_of_many_rows_in_small_files(spark, tmp_path, threshold):
    spark.range(0, ROWS, 1, 1).selectExpr("id AS p_partkey", "'the same name' AS p_name").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    lines = spark.range(30).selectExpr(
        "id AS l_orderkey", "CAST(1 AS int) AS l_linenumber", "id * 2000 AS l_partkey", "id AS l_suppkey",
        "timestamp'1998-01-01' AS l_shipdate", "1.0D AS l_quantity", "2.0D AS l_extendedprice", "0.1D AS l_discount",
        "0.0D AS l_tax", "'R' AS l_returnflag", "'F' AS l_linestatus",
    )
    # Texts that no codec shortens, so that the lines are the larger side by their files too.
    lines.crossJoin(spark.range(400)).drop("id").withColumn("noise", F.sha2(F.rand(3).cast("string"), 512)).write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    items = Bindings(spark, str(tmp_path), f"{tmp_path}/scratch").order_item()
    joins = [x for x in plan(items).splitlines() if "Join" in x and "l_partkey" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert items.count() == 20 * 400


def test_a_join_side_is_counted_only_where_its_files_are_small(spark, tmp_path, threshold):
    spark.range(0, ROWS, 1, 1).selectExpr("id", "sha2(CAST(id AS string), 512) AS t").write.parquet(f"{tmp_path}/large")
    large = spark.read.parquet(f"{tmp_path}/large")
    assert join_side(large) is large
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert join_side(large.select("id")) is not None and "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
