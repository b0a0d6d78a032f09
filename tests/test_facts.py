from datetime import datetime
from decimal import Decimal

import pytest

from starflow.operators.dimensions import MissingDayError
from pyspark.sql import functions as F

from starflow.operators.dimensions import scd1_load, scd2_merge
from starflow.operators.facts import derive_difference, load_fact
from starflow.operators.quality import quality_summary
from starflow.operators.summaries import daily_average, period_end, summarise
from starflow.plans.model import DIMS, FACTS, SUMMARIES
from starflow.plans.schemas import SOURCES
from starflow.specs import FactSpec, Measure, Metric, SummarySpec

DAY = "2026-01-01"


def table(spark, name, *rows):
    """Rows given as dicts; columns left out are NULL."""
    schema = SOURCES[name]
    return spark.createDataFrame(
        [tuple(r.get(c) for c in schema.names) for r in rows], schema
    )


@pytest.fixture(scope="module")
def dims(spark):
    users = table(
        spark,
        "user_info",
        {"user_id": 10, "gender": "1", "register_channel": "app"},
        {"user_id": 20, "gender": "2", "register_channel": "web"},
    )
    shops = table(spark, "shop_info", {"shop_id": 5, "shop_name": "s5"})
    skus = table(spark, "sku_info", {"sku_id": 7, "sku_name": "n7"})
    coupons = table(spark, "coupon_info", {"coupon_id": 3, "coupon_name": "c3"})
    return {
        "user": scd2_merge(None, users, DIMS["user"], DAY),
        "shop": scd1_load(shops, DIMS["shop"], DAY),
        "sku": scd2_merge(None, skus, DIMS["sku"], DAY),
        "coupon": scd1_load(coupons, DIMS["coupon"], DAY),
    }


def orders(spark):
    return table(
        spark,
        "order_info",
        *[
            {
                "order_id": i,
                "user_id": user,
                "shop_id": shop,
                "total_amount": Decimal(100 + i),
                "pay_amount": Decimal(90),
                "discount_amount": Decimal(10),
                "order_time": f"2026-01-0{1 + i % 2} 10:00:00",
            }
            for i, (user, shop) in enumerate([(10, 5), (99, 5), (20, None), (10, 5)])
        ],
    )


def test_unknown_members_stay_with_flag(spark, dims):
    fact = load_fact(orders(spark), dims, FACTS["place_order"], DIMS, DAY)
    got = [
        (r.order_id, r.place_order_sk, r.user_sk, r.shop_sk, r.is_valid)
        for r in fact.orderBy("order_id").collect()
    ]
    assert got == [(0, 1, 1, 1, 1), (1, 2, -1, 1, 0), (2, 3, 2, -1, 0), (3, 4, 1, 1, 1)]


def test_column_order_and_source(spark, dims):
    fact = load_fact(orders(spark), dims, FACTS["place_order"], DIMS, DAY)
    assert fact.columns == [
        "order_id",
        "place_order_sk",
        "user_sk",
        "shop_sk",
        "order_status",
        "order_time",
        "pay_time",
        "total_amount",
        "pay_amount",
        "discount_amount",
        "is_valid",
        "etl_insert_time",
        "etl_update_time",
        "source_system",
        "pt",
    ]
    assert fact.first().source_system == "ods_mall_oltp_order_info_df"


def test_closed_versions_and_other_days_are_not_looked_up(spark, dims):
    closed = dims["user"].withColumn("is_active", F.lit(0)).withColumn(
        "user_sk", F.col("user_sk") + 100
    )
    older = dims["user"].withColumn("pt", F.lit("2025-12-31"))
    mixed = dims | {"user": dims["user"].unionByName(closed).unionByName(older)}
    fact = load_fact(orders(spark), mixed, FACTS["place_order"], DIMS, DAY)
    assert fact.count() == 4
    assert {r.user_sk for r in fact.collect()} == {1, 2, -1}


def test_event_date_and_kept_columns(spark, dims):
    fact = load_fact(
        orders(spark),
        dims,
        FACTS["place_order"],
        DIMS,
        DAY,
        event_date="order_time",
        keep=("user_id",),
        at=datetime(2026, 1, 1),
    )
    assert {(r.order_id, r.user_id) for r in fact.collect()} == {(0, 10), (2, 20)}
    assert fact.first().etl_insert_time == datetime(2026, 1, 1)


def test_event_date_reaches_the_files(spark, dims, tmp_path):
    spec = FactSpec("thing", "dwd_thing", "app", "id", (("user", "user_id"),))
    for kind, pushed in (
        ("string", "StringStartsWith(at,2026-01-01)"),
        ("date", "EqualTo(at,2026-01-01)"),
        ("timestamp", "LessThan(at,2026-01-02"),
    ):
        path = str(tmp_path / kind)
        days = ["2025-12-31 23:59:59", "2026-01-01 00:00:00", "2026-01-01 23:59:59", "2026-01-02 00:00:00"]
        rows = spark.createDataFrame([(i, 10, d) for i, d in enumerate(days)], "id long, user_id long, at string")
        rows.withColumn("at", F.col("at").cast(kind)).write.parquet(path)
        src = spark.read.parquet(path)
        fact = load_fact(src, dims, spec, DIMS, DAY, event_date="at", surrogate=False)
        assert {r.id for r in fact.collect()} == {1, 2}
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan.replace("[", "(").replace(", ", ",") or pushed in plan


def test_only_the_day_of_a_partitioned_source_is_loaded(spark, dims):
    today = orders(spark).withColumn("pt", F.lit(DAY))
    both = today.unionByName(orders(spark).withColumn("pt", F.lit("2025-12-31")))
    fact = load_fact(both, dims, FACTS["place_order"], DIMS, DAY)
    assert fact.count() == orders(spark).count()
    users = table(spark, "user_info", {"user_id": 1}).withColumn("pt", F.lit("2025-12-31"))
    assert scd1_load(users, DIMS["user"], DAY, allow_empty=True).count() == 0
    with pytest.raises(MissingDayError):
        scd1_load(users, DIMS["user"], DAY)


def test_wrong_user_specs_are_refused_at_use(spark, dims):
    spec = SummarySpec(
        "bad", "dws_bad", ("sku",), (Metric("m", "inventory_snapshot", "stock_num", "sum", "bigint"),)
    )
    with pytest.raises(ValueError, match="must not be summed"):
        summarise({}, dims, spec, DIMS, DAY, FACTS)


def test_derived_difference(spark):
    got = derive_difference(orders(spark), "total_amount", "pay_amount", "d").collect()
    assert [r.d for r in got] == [Decimal(10 + i) for i in range(4)]


def test_quality_row(spark, dims):
    fact = load_fact(orders(spark), dims, FACTS["place_order"], DIMS, DAY)
    row = quality_summary(fact, FACTS["place_order"], DAY).first()
    assert (row.table_name, row.pt) == ("dwd_trd_place_order_df", DAY)
    assert (row.total_records, row.valid_records) == (4, 2)
    assert (row.total_amount_min, row.total_amount_max) == (100, 103)
    empty = quality_summary(fact, FACTS["place_order"], "2026-02-02").first()
    assert empty.total_records == 0
    assert empty.valid_records is None and empty.pay_amount_max is None


def test_factless_fact(spark, dims):
    uses = table(
        spark,
        "user_coupon",
        {"id": 1, "user_id": 10, "coupon_id": 3},
        {"id": 2, "user_id": 10, "coupon_id": 3},
        {"id": 3, "user_id": 10, "coupon_id": 4},
    )
    fact = load_fact(uses, dims, FACTS["coupon_usage"], DIMS, DAY)
    row = quality_summary(fact, FACTS["coupon_usage"], DAY).first()
    assert row.asDict() == {
        "table_name": "dwd_mkt_coupon_usage_df",
        "pt": DAY,
        "total_records": 3,
        "valid_records": 2,
    }
    got = summarise({"coupon_usage": fact}, dims, SUMMARIES["mkt_coupon"], DIMS, DAY, FACTS)
    assert [(r.coupon_id, r.coupon_name, r.coupon_use_cnt) for r in got.collect()] == [
        (3, "c3", 2)
    ]


def test_drill_across_with_a_missing_fact(spark, dims):
    payments = table(
        spark,
        "payment_info",
        {"pay_id": 1, "user_id": 20, "pay_amount": Decimal("3.50")},
        {"pay_id": 2, "user_id": 20, "pay_amount": None},
    )
    sources = {
        "place_order": orders(spark),
        "payment": payments,
        "refund": table(spark, "refund_info"),
    }
    facts = {
        f: load_fact(s, dims, FACTS[f], DIMS, DAY) for f, s in sources.items()
    }
    got = summarise(facts, dims, SUMMARIES["trd_user"], DIMS, DAY, FACTS)
    rows = {r.user_id: r for r in got.collect()}
    assert set(rows) == {10, 20}
    assert (rows[10].order_cnt, rows[10].total_amount_sum) == (2, 203)
    assert (rows[10].payment_cnt, rows[10].payment_amount_sum) == (0, None)
    assert (rows[20].order_cnt, rows[20].total_amount_sum) == (0, None)
    assert (rows[20].payment_cnt, rows[20].payment_amount_sum) == (2, Decimal("3.50"))
    assert rows[20].refund_cnt == 0 and rows[20].refund_amount_sum is None
    assert (rows[20].gender, rows[20].register_channel) == ("2", "web")


def test_summary_total_equals_valid_fact_total(spark, dims):
    fact = load_fact(orders(spark), dims, FACTS["place_order"], DIMS, DAY)
    got = summarise({"place_order": fact}, dims, SUMMARIES["trd_shop"], DIMS, DAY, FACTS)
    total = fact.where("is_valid = 1").agg(F.sum("total_amount")).first()[0]
    assert got.agg(F.sum("total_amount_sum")).first()[0] == total


def test_summary_joins_after_one_shuffle(spark, dims):
    fact = load_fact(orders(spark), dims, FACTS["place_order"], DIMS, DAY, surrogate=False)
    loaded = spark.createDataFrame(fact.collect(), fact.schema)
    shops = spark.createDataFrame(dims["shop"].collect(), dims["shop"].schema)
    got = summarise(
        {"place_order": loaded}, {"shop": shops}, SUMMARIES["trd_shop"], DIMS, DAY, FACTS
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_semi_additive_over_time(spark):
    stock = spark.createDataFrame(
        [(1, "d1", 1, 4), (1, "d1", 2, 6), (1, "d2", 3, 1), (2, "d1", 4, 8)],
        "sku bigint, day string, id bigint, stock_num int",
    )
    last = period_end(stock, ["sku"], "stock_num", ["day", "id"])
    assert {(r.sku, r.stock_num_end) for r in last.collect()} == {(1, 1), (2, 8)}
    mean = daily_average(stock, ["sku"], "stock_num", "day")
    got = {(r.sku, r.stock_num_daily_avg) for r in mean.collect()}
    assert got == {(1, Decimal("5.50")), (2, Decimal("8.00"))}


def test_specs_refuse_wrong_aggregates():
    stock = FactSpec("f", "t", "s", "id", (), measures=(Measure("n", "semi_additive"),))
    summed = SummarySpec("x", "t", (), (Metric("m", "f", "n", "sum", "bigint"),))
    with pytest.raises(ValueError, match="must not be summed"):
        summed.check({"f": stock})
    money = FactSpec("f", "t", "s", "id", (), measures=(Measure("n"),))
    mean = SummarySpec("x", "t", (), (Metric("m", "f", "n", "avg", "bigint"),))
    with pytest.raises(ValueError, match="only semi-additive"):
        mean.check({"f": money})
    with pytest.raises(ValueError, match="not an atomic aggregate"):
        Metric("m", "f", "n", "stddev", "double")


def test_hot_foreign_key_is_split(spark, tmp_path):
    """Dimension too large to broadcast, a third of the fact on one user."""
    spec = FACTS["payment"]
    src = spark.range(300_000).selectExpr(
        "id AS pay_id",
        "if(id % 3 = 0, 5, id % 50000) AS user_id",
        "hex(xxhash64(id)) AS pay_type",
        "cast(1 AS tinyint) AS pay_status",
        "'2026-01-01' AS pay_time",
        "cast(id AS decimal(16,2)) AS pay_amount",
    )
    src.write.parquet(str(tmp_path / "src"))
    users = spark.range(50_000).selectExpr(
        "id AS user_id", "id + 1 AS user_sk", f"'{DAY}' AS pt", "1 AS is_active"
    )
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = spark.read.parquet(str(tmp_path / "src")).repartition(8)
        fact = load_fact(rows, {"user": users}, spec, DIMS, DAY, surrogate=False)
        looked_up = fact.select("pay_type", "user_sk", "is_valid")
        pairs = looked_up.collect()
        assert sum(r.user_sk == 6 for r in pairs) >= 100_000
        assert len(pairs) == 300_000 and all(r.is_valid == 1 for r in pairs)
        plan = looked_up._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lines_are_numbered_once_for_all_tables(spark, tmp_path, monkeypatch):
    """Every table of lines gets the numbers that its rows alone would get, from one numbering."""
    from starflow.plans import bindings

    rows = [(k // 3, k % 7, k % 2, k % 3, float(k), float(k), (k % 4) / 100, 0.0, "RN"[k % 2], "F") for k in range(60)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    names += "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    lines = spark.createDataFrame(rows, names).selectExpr("*", "timestamp'1998-01-01' AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(20).selectExpr("id AS o_orderkey", "id AS o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    wide, plain = [], bindings.dense_key

    def seen(df, order_by, *args, **options):
        wide.append(order_by == bindings.LINE_ORDER)
        return plain(df, order_by, *args, **options)

    monkeypatch.setattr(bindings, "dense_key", seen)
    alone = {t: bindings.Bindings(spark, str(tmp_path)).source(t) for t in ("refund_info", "user_coupon")}
    wide.clear()
    together = bindings.Bindings(spark, str(tmp_path))
    together.source("stock_info")
    for t, expected in alone.items():
        assert sorted(map(tuple, together.source(t).collect())) == sorted(map(tuple, expected.collect()))
    assert wide == [True, False, False]


def test_lines_of_a_condition_move_with_their_own_columns(spark, tmp_path, monkeypatch):
    from starflow.plans import bindings

    lines = spark.range(30).selectExpr(
        "id div 3 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(id % 3 AS int) AS l_linenumber",
        "1D AS l_quantity", "2D AS l_extendedprice", "(id % 4) / 100D AS l_discount", "0D AS l_tax",
        "if(id % 2 = 0, 'R', 'N') AS l_returnflag", "'F' AS l_linestatus", "timestamp'1998-01-01' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(10).selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    moved, plain = [], bindings.dense_key

    def seen(df, *args, **options):
        moved.append(set(df.columns))
        return plain(df, *args, **options)

    monkeypatch.setattr(bindings, "dense_key", seen)
    source = bindings.Bindings(spark, str(tmp_path))
    source.source("stock_info")
    assert source.source("refund_info").count() == 15 and source.source("user_coupon").count() == 22
    day = {"__line", "l_orderkey", "l_shipdate"}
    assert moved[1:] == [day | {"l_partkey", "l_extendedprice"}, day | {"l_discount"}]
