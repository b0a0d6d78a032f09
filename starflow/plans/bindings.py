"""Retail source tables derived from the star-schema test tables.

``day`` 1, 2 and 3 give successive snapshots of users and articles, with new,
changed and missing rows. All else is the same every day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators.keys import dense_key
from starflow.operators.sizes import join_side
from starflow.plans.schemas import MONEY

DAYS = {1: "2026-07-07", 2: "2026-07-08", 3: "2026-07-09"}

LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


class Bindings:
    """Source tables over one test-data folder, built when asked for.

    Row numbers stand in for missing line ids; ``scratch`` is where they are written.
    """

    def __init__(self, spark: SparkSession, folder: str, scratch: str | None = None):
        self.spark = spark
        self.folder = folder
        self.scratch = scratch
        self._tables: dict[str, DataFrame] = {}
        self._all_lines: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.folder}/{name}.parquet"
            self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def source(self, name: str, day: int = 1) -> DataFrame:
        if name in ("user_info", "sku_info"):
            return getattr(self, name)(day)
        return getattr(self, name)()

    def user_info(self, day: int = 1) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        moved = {1: 0, 2: 1, 3: 2}[day]
        nation = F.when(
            k % 10 == 3, (F.col("c_nationkey") + F.lit(moved)) % 25
        ).otherwise(F.col("c_nationkey"))
        name, phone = F.col("c_name"), F.when(k % 5 != 0, F.col("c_name"))
        if day > 1:
            name = F.when(k % 10 == 4, F.concat(name, F.lit("*"))).otherwise(name)
            phone = (
                F.when(k % 15 == 0, F.lit(""))
                .when(k % 35 == 5, F.lit("p"))
                .otherwise(phone)
            )
        left_out = 19 if day == 1 else 18
        cities = self.table("nation").select(
            F.col("n_nationkey").alias("home"), F.col("n_name").alias("city_name")
        )
        return (
            c.where(k % 20 != left_out)
            .withColumn("home", nation)
            .join(cities, "home")
            .select(
                k.alias("user_id"),
                name.alias("user_name"),
                F.when(k % 2 == 0, "1").otherwise("2").alias("gender"),
                phone.alias("phone"),
                _none("register_time"),
                F.col("c_mktsegment").alias("register_channel"),
                "city_name",
                F.lit(0).cast("tinyint").alias("is_deleted"),
                _none("create_time"),
                _none("update_time"),
            )
        )

    def shop_info(self) -> DataFrame:
        cities = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city_name")
        )
        return (
            self.table("supplier")
            .join(cities, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("shop_id"),
                F.col("s_name").alias("shop_name"),
                F.col("s_nationkey").cast("bigint").alias("city_id"),
                "city_name",
                _none("manager_name"),
                (F.col("s_acctbal") >= 0).cast("tinyint").alias("is_open"),
                _none("create_time"),
                _none("update_time"),
            )
        )

    def sku_info(self, day: int = 1) -> DataFrame:
        k = F.col("p_partkey")
        cost = F.lit(None).cast(MONEY)
        price = F.col("p_retailprice").cast(MONEY)
        on_sale = F.lit(1)
        if day > 1:
            cost = F.when(k % 7 == 0, F.lit(1)).cast(MONEY)
            price = F.when(k % 9 == 0, price + F.lit(1)).otherwise(price).cast(MONEY)
            on_sale = F.when(k % 11 == 0, 0).otherwise(1)
        return self.table("part").select(
            k.alias("sku_id"),
            F.expr("p_partkey div 10").alias("spu_id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_size").cast("bigint").alias("category_id"),
            F.col("p_type").alias("category_name"),
            (k % 10).alias("shop_id"),
            cost.alias("cost_price"),
            price.alias("sale_price"),
            on_sale.cast("tinyint").alias("is_on_sale"),
            F.lit(0).cast("tinyint").alias("is_deleted"),
            _none("create_time"),
            _none("update_time"),
        )

    def coupon_info(self) -> DataFrame:
        rates = self.table("lineitem").where("l_discount > 0").select("l_discount")
        return rates.distinct().select(
            _coupon_id().alias("coupon_id"),
            F.concat(F.lit("C"), _coupon_id().cast("string")).alias("coupon_name"),
            F.lit(2).cast("tinyint").alias("discount_type"),
            F.lit(0).cast(MONEY).alias("min_amount"),
            F.col("l_discount").cast(MONEY).alias("discount_amount"),
            _none("start_time"),
            _none("end_time"),
        )

    def order_info(self) -> DataFrame:
        total = F.col("o_totalprice").cast(MONEY)
        paid = (total * F.lit("0.90").cast("decimal(3,2)")).cast(MONEY)
        status = F.when(F.col("o_orderstatus") == "F", 4)
        status = status.when(F.col("o_orderstatus") == "O", 2)
        status = status.when(F.col("o_orderstatus") == "P", 1)
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            (F.col("o_orderkey") % 10).alias("shop_id"),
            status.cast("tinyint").alias("order_status"),
            total.alias("total_amount"),
            paid.alias("pay_amount"),
            (total - paid).cast(MONEY).alias("discount_amount"),
            _day("o_orderdate").alias("order_time"),
            _none("pay_time"),
            F.lit(0).cast("tinyint").alias("is_deleted"),
            _none("create_time"),
            _none("update_time"),
        )

    def order_item(self) -> DataFrame:
        original = F.col("l_extendedprice").cast(MONEY)
        rate = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
        names = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("sku_name")
        )
        return (
            self._lines("id")
            .join(join_side(names), "l_partkey")
            .select(
                "id",
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("sku_id"),
                "sku_name",
                F.col("l_quantity").cast("int").alias("quantity"),
                original.alias("original_amount"),
                (original * rate).cast(MONEY).alias("split_amount"),
                _none("create_time"),
            )
        )

    def payment_info(self) -> DataFrame:
        return (
            self.table("events")
            .where("event_type = 'purchase'")
            .select(
                F.col("event_id").alias("pay_id"),
                F.lit(None).cast("bigint").alias("order_id"),
                "user_id",
                F.col("event_type").alias("pay_type"),
                F.col("value").cast(MONEY).alias("pay_amount"),
                F.lit(1).cast("tinyint").alias("pay_status"),
                _day("ts").alias("pay_time"),
                _none("create_time"),
            )
        )

    def refund_info(self) -> DataFrame:
        return self._with_buyer(
            self._lines("refund_id", "l_returnflag = 'R'", ("l_partkey", "l_extendedprice"))
        ).select(
            "refund_id",
            F.col("l_orderkey").alias("order_id"),
            "user_id",
            F.col("l_partkey").alias("sku_id"),
            F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
            F.lit(1).cast("tinyint").alias("refund_status"),
            _day("l_shipdate").alias("refund_time"),
            _none("create_time"),
        )

    def stock_info(self) -> DataFrame:
        return self._lines("id").select(
            "id",
            F.col("l_partkey").alias("sku_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("l_quantity").cast("int").alias("stock_num"),
            _day("l_shipdate").alias("update_time"),
        )

    def user_coupon(self) -> DataFrame:
        return self._with_buyer(self._lines("id", "l_discount > 0", ("l_discount",))).select(
            "id",
            "user_id",
            _coupon_id().alias("coupon_id"),
            F.col("l_orderkey").alias("order_id"),
            F.lit(1).cast("tinyint").alias("use_status"),
            _none("create_time"),
            _day("l_shipdate").alias("use_time"),
        )

    def _lines(
        self, id_name: str, condition: str | None = None, shown: tuple[str, ...] = ()
    ) -> DataFrame:
        """Lines by number in ``LINE_ORDER``, those under ``condition`` counted alone.

        All lines are numbered once for the tables that use them. When they are, the
        lines of a condition are numbered in that order, by one column, not eleven, and
        move with their order, their day and the columns ``shown``.
        """
        if condition is None:
            if self._all_lines is None:
                lines = self.table("lineitem")
                self._all_lines = dense_key(lines, LINE_ORDER, "__line", folder=self.scratch)
            return self._all_lines.withColumnRenamed("__line", id_name)
        if self._all_lines is None:
            lines = self.table("lineitem").where(condition)
            return dense_key(lines, LINE_ORDER, id_name, folder=self.scratch)
        lines = self._all_lines.where(condition)
        lines = lines.select("__line", "l_orderkey", "l_shipdate", *shown)
        return dense_key(lines, "__line", id_name, unique=True, folder=self.scratch).drop("__line")

    def _with_buyer(self, lines: DataFrame) -> DataFrame:
        buyers = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
        )
        return lines.join(join_side(buyers), "l_orderkey")


def _none(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def _coupon_id() -> Column:
    return F.round(F.col("l_discount") * 100).cast("bigint")
