from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starflow.plans.schemas import KEYS, SOURCES
from starflow.sources.jdbc import Database, databases, hash_predicates, range_options, read_jdbc
from starflow.sources.landing import land_snapshot, map_columns
from starflow.sources.storage import (
    discard_runs,
    materialise,
    partitions,
    publish,
    read_partition,
    read_previous,
    read_table,
    shared_folder,
)


def test_publish_replaces_one_day(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01")
    publish(spark.range(7), root, "2026-01-02", stripe_bytes=1 << 20)
    publish(spark.range(3), root, "2026-01-02")
    assert partitions(spark, root) == ["2026-01-01", "2026-01-02"]
    assert read_partition(spark, root, "2026-01-01").count() == 5
    assert read_partition(spark, root, "2026-01-02").count() == 3


def test_empty_result_clears_the_day(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01")
    publish(spark.range(5).where("id > 9"), root, "2026-01-01")
    assert read_partition(spark, root, "2026-01-01").collect() == []


def test_failed_write_leaves_the_old_day_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01")
    failing = spark.range(5).select(F.raise_error(F.lit("half way")).cast("long").alias("id"))
    for day in ("2026-01-01", "2026-01-02"):
        with pytest.raises(PySparkException, match="half way"):
            publish(failing, root, day)
    assert partitions(spark, root) == ["2026-01-01"]
    assert read_partition(spark, root, "2026-01-01").count() == 5
    assert read_previous(spark, root, "2026-01-03").count() == 5
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["pt=2026-01-01"]


def test_unfinished_days_do_not_count(spark, tmp_path):
    root = tmp_path / "t"
    publish(spark.range(5), str(root), "2026-01-01")
    (root / "pt=2026-01-02").mkdir()
    assert partitions(spark, str(root)) == ["2026-01-01"]
    assert read_previous(spark, str(root), "2026-01-03").count() == 5


def test_a_swap_cut_off_midway_is_put_back(spark, tmp_path):
    root = tmp_path / "t"
    publish(spark.range(5), str(root), "2026-01-01")
    (root / "pt=2026-01-01").rename(root / ".old-pt=2026-01-01")
    assert partitions(spark, str(root)) == ["2026-01-01"]
    assert read_partition(spark, str(root), "2026-01-01").count() == 5


def test_every_reader_puts_a_cut_off_swap_back(spark, tmp_path):
    root = tmp_path / "t"
    publish(spark.range(5), str(root), "2026-01-01")
    (root / "pt=2026-01-01").rename(root / ".old-pt=2026-01-01")
    assert read_partition(spark, str(root), "2026-01-01").count() == 5
    (root / "pt=2026-01-01").rename(root / ".old-pt=2026-01-01")
    assert read_table(spark, str(root), StructType.fromDDL("id bigint, pt string")).count() == 5


def test_run_folders_can_be_discarded(spark):
    kept = materialise(spark.range(3)).inputFiles()[0]
    discard_runs(spark)
    assert not Path(kept.removeprefix("file:")).exists()


def test_a_day_may_be_built_from_earlier_days(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01")
    for _ in range(2):
        prev = read_previous(spark, root, "2026-01-02")
        publish(prev.union(prev), root, "2026-01-02")
    assert read_partition(spark, root, "2026-01-02").count() == 10


def test_previous_is_strictly_earlier(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_previous(spark, root, "2026-01-01") is None
    publish(spark.range(1), root, "2026-01-01")
    publish(spark.range(2), root, "2026-01-03")
    assert read_previous(spark, root, "2026-01-01") is None
    assert read_previous(spark, root, "2026-01-03").count() == 1
    assert read_previous(spark, root, "2026-01-09").count() == 2


def test_day_stays_a_string_and_prunes(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01", column="dt", fmt="parquet")
    publish(spark.range(6), root, "2026-01-02", column="dt", fmt="parquet")
    day = read_partition(spark, root, "2026-01-01", column="dt", fmt="parquet")
    assert day.schema["dt"].dataType.simpleString() == "string"
    schema = StructType.fromDDL("id bigint, dt string")
    table = read_table(spark, root, schema, fmt="parquet").where("dt = '2026-01-02'")
    assert table.count() == 6
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_read_with_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.range(5), root, "2026-01-01")
    schema = StructType.fromDDL("id bigint, added string, pt string")
    day = read_partition(spark, root, "2026-01-01", schema=schema)
    assert day.columns == ["id", "added", "pt"]
    assert day.where("added IS NULL").count() == 5


def test_materialise_reads_back_from_the_shared_folder(spark):
    df = materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90
    assert shared_folder(spark) in df.inputFiles()[0]


def test_landing_casts_and_stamps(spark):
    schema = SOURCES["stock_info"]
    src = spark.createDataFrame(
        [("1", 2, 3, "4", datetime(2026, 1, 1, 5), "extra")],
        "id string, sku_id int, shop_id int, stock_num string, update_time timestamp, x string",
    )
    landed = land_snapshot(src, schema, "2026-01-01", at=datetime(2026, 1, 2, 3, 4, 5))
    assert landed.columns == [*schema.names, "etl_time", "pt"]
    row = landed.first()
    assert (row.id, row.stock_num, row.update_time) == (1, 4, "2026-01-01 05:00:00")
    assert (row.etl_time, row.pt) == ("2026-01-02 03:04:05", "2026-01-01")


def test_landing_keeps_cents(spark):
    money = StructType([SOURCES["order_info"]["pay_amount"]])
    src = spark.createDataFrame([("12.34",)], "pay_amount string")
    assert str(land_snapshot(src, money, "d").first().pay_amount) == "12.34"


def test_landing_refuses_missing_columns_and_bad_values(spark):
    schema = SOURCES["stock_info"]
    with pytest.raises(ValueError, match="stock_num"):
        land_snapshot(spark.range(1), schema, "d")
    src = spark.createDataFrame([("x",)], "stock_num string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(PySparkException, match="stock_num cannot hold as int"):
                land_snapshot(src, StructType([schema["stock_num"]]), "d").collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_mapping(spark):
    got = map_columns(spark.range(2).withColumn("b", F.lit("x")), {"key": "id", "v": "b"})
    assert got.columns == ["key", "v"]


def test_schemas_have_their_keys():
    assert set(KEYS) == set(SOURCES)
    assert all(k in SOURCES[t].names for t, k in KEYS.items())


@pytest.mark.parametrize(
    "entry, url",
    [
        (
            {"type": "mysql", "host": "h", "port": 3307, "dbname": "m"},
            "jdbc:mysql://h:3307/m",
        ),
        ({"type": "postgresql", "host": "h", "dbname": "m"}, "jdbc:postgresql://h:5432/m"),
        ({"type": "sqlite", "database": "./data.db"}, "jdbc:sqlite:./data.db"),
        (
            {"type": "oracle", "host": "h", "service_name": "ORCL"},
            "jdbc:oracle:thin:@//h:1521/ORCL",
        ),
        (
            {"type": "sqlserver", "host": "h", "dbname": "m"},
            "jdbc:sqlserver://h:1433;databaseName=m",
        ),
    ],
)
def test_database_urls(entry, url):
    assert Database.from_config(entry).url == url


def test_database_configuration():
    config = {"database": {"a": {"type": "mysql", "dbname": "m", "user": "u"}}}
    options = databases(config)["a"].options()
    assert options["user"] == "u" and "password" not in options
    assert options["driver"].startswith("com.mysql")
    with pytest.raises(ValueError, match="unknown database type"):
        Database.from_config({"type": "other", "dbname": "m"})
    with pytest.raises(ValueError, match="needs one of"):
        Database.from_config({"type": "mysql"})


def test_splits_by_date_hash_and_choice(spark):
    got = range_options("t", "d", date(2026, 1, 1), date(2026, 2, 1), 4)
    assert (got["lowerBound"], got["upperBound"]) == ("2026-01-01", "2026-02-02")
    got = range_options("t", "d", datetime(2026, 1, 1, 5), datetime(2026, 1, 2), 4)
    assert (got["lowerBound"], got["upperBound"]) == ("2026-01-01 05:00:00", "2026-01-02 00:00:01")
    with pytest.raises(TypeError, match="hash_predicates"):
        range_options("t", "s", "a", "z", 4)
    assert hash_predicates("mysql", "code", 2) == [
        "MOD(CRC32(code), 2) = 0 OR code IS NULL",
        "MOD(CRC32(code), 2) = 1",
    ]
    with pytest.raises(ValueError, match="sqlite"):
        hash_predicates("sqlite", "code", 2)
    db = Database.from_config({"type": "mysql", "dbname": "m"})
    with pytest.raises(ValueError, match="unsplit"):
        read_jdbc(spark, db, "t")


def test_range_options_cover_the_last_key():
    got = range_options("t", "id", 3, 9, 4)
    assert got["lowerBound"] == "3" and got["upperBound"] == "10"
    assert got["numPartitions"] == "4" and got["partitionColumn"] == "id"


def test_landing_refuses_values_a_cast_would_change(spark):
    cases = [
        ("v double", (1.7,), "v int"),
        ("v decimal(10,3)", (Decimal("12.345"),), "v decimal(16,2)"),
        ("v timestamp", (datetime(2026, 1, 1, 5, 0),), "v date"),
        ("v string", ("1.7",), "v int"),
    ]
    for given, row, wanted in cases:
        src = spark.createDataFrame([row], given)
        with pytest.raises(PySparkException, match="cannot hold"):
            land_snapshot(src, StructType.fromDDL(wanted), "d").collect()
    src = spark.createDataFrame([(1.7,)], "v double")
    assert land_snapshot(src, StructType.fromDDL("v int"), "d", rounding=("v",)).first().v == 1
    kept = spark.createDataFrame([(2.0, Decimal("12.300"), "12.340")], "a double, b decimal(10,3), c string")
    row = land_snapshot(kept, StructType.fromDDL("a int, b decimal(16,2), c decimal(16,2)"), "d").first()
    assert (row.a, str(row.b), str(row.c)) == (2, "12.30", "12.34")
