"""Queries over a folder of test tables: the model's jobs and each operator.

Audit timestamps are left out of the results so that they can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.operators import checks, profiling
from starflow.operators.changes import copy_changes
from starflow.operators.dimensions import (
    scd1_load,
    scd2_as_of,
    scd2_carry,
    scd2_changed,
    scd2_current,
    scd2_merge,
    scd2_new,
)
from starflow.operators.facts import UNKNOWN_SK, as_of_lookup, current_slice, derive_difference, load_fact
from starflow.operators.keys import dense_key
from starflow.operators.quality import quality_summary
from starflow.operators.summaries import carried_daily, daily_average, period_end, summarise
from starflow.plans.bindings import DAYS, LINE_ORDER, Bindings
from starflow.plans.model import DIMS, FACTS, SUMMARIES
from starflow.plans.schemas import KEYS, SOURCES, landed_name
from starflow.plans.tables import table_schema
from starflow.sources.catalog import add_partition, create_table
from starflow.sources.landing import land_snapshot, map_columns
from starflow.sources.storage import (
    FACT_STRIPE_BYTES,
    publish,
    read_partition,
    read_previous,
    read_table,
    run_folder,
)

Query = Callable[[SparkSession, str], DataFrame]

AUDIT = ("etl_time", "etl_insert_time", "etl_update_time")

# Which landed table each dimension and fact is loaded from.
DIM_SOURCE = {
    "coupon": "coupon_info",
    "shop": "shop_info",
    "sku": "sku_info",
    "user": "user_info",
}
FACT_SOURCE = {
    "place_order": "order_info",
    "order_detail": "order_item",
    "payment": "payment_info",
    "refund": "refund_info",
    "inventory_snapshot": "stock_info",
    "coupon_usage": "user_coupon",
}


class Retail:
    """The model's tables over one folder as a daily run leaves them, up to one day.

    Every table is published and read back: landed snapshots, dimensions, facts and
    summaries, each once, below the run's own folder.
    """

    def __init__(self, spark: SparkSession, folder: str, day: int = 1):
        self.spark = spark
        self.root = run_folder(spark)
        self.bindings = Bindings(spark, folder, f"{self.root}/numbered")
        self.day = day
        self.bizdate = DAYS[day]
        self._read: dict[tuple, DataFrame] = {}

    def _stored(
        self,
        table: str,
        day: int,
        build: Callable[[], DataFrame],
        column: str = "pt",
        **options,
    ) -> DataFrame:
        """One day's partition of a table, built and published when first asked for."""
        known = (table, day)
        if known not in self._read:
            root = f"{self.root}/{table}"
            publish(build(), root, DAYS[day], column=column, **options)
            self._read[known] = read_partition(
                self.spark, root, DAYS[day], column=column, schema=table_schema(table)
            )
        return self._read[known]

    def landed(self, table: str, day: int | None = None) -> DataFrame:
        """A landed table as a load reads it."""
        day = day or self.day

        def land() -> DataFrame:
            rows = self.bindings.source(table, day)
            return land_snapshot(rows, SOURCES[table], DAYS[day])

        return self._stored(landed_name(table), day, land)

    def dim(self, name: str, day: int | None = None) -> DataFrame:
        """A dimension after the loads of day 1 up to ``day``."""
        day = day or self.day
        return self._stored(DIMS[name].table, day, lambda: self.loaded_dim(name, day))

    def loaded_dim(self, name: str, day: int, **options) -> DataFrame:
        """What a day's load of a dimension gives, before it is published."""
        spec = DIMS[name]
        src = self.landed(DIM_SOURCE[name], day)
        if not spec.tracked:
            return scd1_load(src, spec, DAYS[day], **options)
        return scd2_merge(self.previous(name, day), src, spec, DAYS[day], **options)

    def previous(self, name: str, day: int | None = None) -> DataFrame | None:
        """The published copy of a history dimension from before ``day``."""
        day, table = day or self.day, DIMS[name].table
        if day > 1:
            self.dim(name, day - 1)
        root = f"{self.root}/{table}"
        return read_previous(self.spark, root, DAYS[day], schema=table_schema(table))

    def loaded_fact(self, name: str, **options) -> DataFrame:
        """What the day's load of a fact gives, before it is published."""
        spec = FACTS[name]
        dims = {d: self.dim(d) for d, _ in spec.lookups}
        src = self.landed(FACT_SOURCE[name])
        return load_fact(src, dims, spec, DIMS, self.bizdate, **options)

    def fact(self, name: str) -> DataFrame:
        return self._stored(
            FACTS[name].table,
            self.day,
            lambda: self.loaded_fact(name),
            stripe_bytes=FACT_STRIPE_BYTES,
        )

    def summary(self, name: str) -> DataFrame:
        spec = SUMMARIES[name]

        def build() -> DataFrame:
            facts = {f: self.fact(f) for f in spec.facts}
            dims = {d: self.dim(d) for d in spec.grain}
            return summarise(facts, dims, spec, DIMS, self.bizdate, FACTS)

        return self._stored(spec.table, self.day, build, column="dt")


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT)


def _land(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return _plain(Retail(spark, folder).landed(table))


def _dim(name: str, day: int, spark: SparkSession, folder: str) -> DataFrame:
    return _plain(Retail(spark, folder, day).dim(name))


def _fact(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return _plain(Retail(spark, folder).fact(name))


def _quality(name: str, spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return quality_summary(retail.fact(name), FACTS[name], retail.bizdate)


def _summary(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).summary(name)


def land_all_counts(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return profiling.row_counts({t: retail.landed(t) for t in SOURCES})


def map_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = Bindings(spark, folder).table("orders")
    return map_columns(orders, {"order_id": "o_orderkey", "user_id": "o_custkey"})


def dense_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = Bindings(spark, folder).table("orders")
    return dense_key(orders.select("o_orderkey"), "o_orderkey", "order_sk")


def dense_key_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The range path whatever the table's size, on a many-column order."""
    lines = Bindings(spark, folder).table("lineitem").select(*LINE_ORDER)
    keyed = dense_key(lines, LINE_ORDER, "line_sk")
    return keyed.select("line_sk", "l_orderkey", "l_linenumber", "l_partkey")


def dense_key_appended(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers that continue after the highest key already given."""
    parts = Bindings(spark, folder).table("part").select("p_partkey")
    return dense_key(parts, "p_partkey", "part_sk", start=1000)


def scd2_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """Without the refresh of untracked attributes on unchanged versions."""
    day2 = Retail(spark, folder, 2)
    return _plain(day2.loaded_dim("user", 2, overwrite_scd1=False))


def scd2_closed_rows(spark: SparkSession, folder: str) -> DataFrame:
    day2 = Retail(spark, folder, 2)
    src = day2.landed("user_info")
    return _plain(scd2_changed(day2.previous("user"), src, DIMS["user"], day2.bizdate))


def scd2_opened_rows(spark: SparkSession, folder: str) -> DataFrame:
    day2 = Retail(spark, folder, 2)
    src = day2.landed("user_info")
    return _plain(scd2_new(day2.previous("user"), src, DIMS["user"], day2.bizdate))


def scd2_carried_rows(spark: SparkSession, folder: str) -> DataFrame:
    day2 = Retail(spark, folder, 2)
    prev, src = day2.previous("user"), day2.landed("user_info")
    closed = scd2_changed(prev, src, DIMS["user"], day2.bizdate)
    return _plain(scd2_carry(prev, closed, DIMS["user"], day2.bizdate))


def scd2_current_slice(spark: SparkSession, folder: str) -> DataFrame:
    day2 = Retail(spark, folder, 2)
    return _plain(scd2_current(day2.dim("user"), day2.bizdate))


def scd2_valid_on_day1(spark: SparkSession, folder: str) -> DataFrame:
    """Versions valid on day 1, taken from the history after day 3."""
    return _plain(scd2_as_of(Retail(spark, folder, 3).dim("user"), DAYS[1]))


def fact_order_detail_with_order(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(Retail(spark, folder).loaded_fact("order_detail", keep=("order_id",)))


def unknown_member(spark: SparkSession, folder: str) -> DataFrame:
    fact = Retail(spark, folder).fact("place_order")
    return fact.where("is_valid = 0").select("order_id", "user_sk", "shop_sk", "is_valid")


def derived_discount(spark: SparkSession, folder: str) -> DataFrame:
    fact = Retail(spark, folder).fact("place_order")
    derived = derive_difference(fact, "total_amount", "pay_amount", "derived")
    agrees = (F.col("derived") == F.col("discount_amount")).cast("int")
    return derived.select("order_id", "discount_amount", "derived", agrees.alias("agrees"))


def fact_orders_point_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, each on a day of the three, against the user version valid that day.

    The history is the one after day 3; an order's day is day 1, 2 or 3 by its id.
    """
    retail = Retail(spark, folder, 3)
    days = F.element_at(F.array(*[F.lit(DAYS[d]) for d in (1, 2, 3)]), (F.col("order_id") % 3 + 1).cast("int"))
    orders = retail.landed("order_info").select("order_id", "user_id", days.alias("event_day"))
    found = as_of_lookup(orders, retail.dim("user"), "user_id", "event_day", "user_id", "user_sk")
    return found.withColumn("user_sk", F.coalesce("user_sk", F.lit(UNKNOWN_SK).cast("long")))


def extract_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What changed in the published landed users and SKUs from day to day, 1 to 3."""
    retail = Retail(spark, folder, 3)
    parts = []
    for table in ("user_info", "sku_info"):
        for day in (1, 2):
            found = copy_changes(
                retail.landed(table, day), retail.landed(table, day + 1), KEYS[table], columns=SOURCES[table].names
            )
            parts.append(
                found.select(
                    F.lit(table).alias("table_name"),
                    F.lit(DAYS[day]).alias("from_day"),
                    F.lit(DAYS[day + 1]).alias("to_day"),
                    F.col(KEYS[table]).alias("key"),
                    "change",
                )
            )
    return checks.union_all(parts)


def stock_period_end(spark: SparkSession, folder: str) -> DataFrame:
    stock = Retail(spark, folder).landed("stock_info")
    return period_end(stock, ["shop_id", "sku_id"], "stock_num", ["update_time", "id"])


STOCK_PERIOD = ("1998-06-01", "1998-06-07")


def stock_carried_week(spark: SparkSession, folder: str) -> DataFrame:
    """Stock per shop and SKU on every day of a week, empty days carrying the last level."""
    stock = Retail(spark, folder).landed("stock_info")
    return carried_daily(stock, ["shop_id", "sku_id"], "stock_num", "update_time", *STOCK_PERIOD)


def stock_daily_average(spark: SparkSession, folder: str) -> DataFrame:
    stock = Retail(spark, folder).landed("stock_info")
    return daily_average(stock, ["shop_id", "sku_id"], "stock_num", "update_time")


def _sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    bindings = Bindings(spark, folder)
    return {t: bindings.source(t, 2) for t in SOURCES}


def profile_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    bindings = Bindings(spark, folder)
    names = (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split()
    return profiling.row_counts({n: bindings.table(n) for n in names})


def profile_null_rate(spark: SparkSession, folder: str) -> DataFrame:
    sources = _sources(spark, folder)
    return checks.union_all([profiling.null_rates(d, t) for t, d in sources.items()])


def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    sources = _sources(spark, folder)
    return checks.union_all(
        [profiling.column_profile(d, t) for t, d in sources.items()]
    ).select("table_name", "column_name", "position", "data_type", "null_count")


def profile_candidate_key(spark: SparkSession, folder: str) -> DataFrame:
    bindings = Bindings(spark, folder)
    names = (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split()
    return checks.union_all(
        [profiling.candidate_keys(bindings.table(n), n) for n in names]
    )


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def profile_minimal_keys(spark: SparkSession, folder: str) -> DataFrame:
    bindings = Bindings(spark, folder)
    return checks.union_all([profiling.minimal_keys(bindings.table(n), n, most=3) for n in TABLES])


def profile_references(spark: SparkSession, folder: str) -> DataFrame:
    bindings = Bindings(spark, folder)
    return profiling.find_references({n: bindings.table(n) for n in TABLES})


def profile_fk_inclusion(spark: SparkSession, folder: str) -> DataFrame:
    s = _sources(spark, folder)
    references = (
        ("order_info", "user_id", "user_info"),
        ("order_info", "shop_id", "shop_info"),
        ("order_item", "order_id", "order_info"),
        ("order_item", "sku_id", "sku_info"),
        ("payment_info", "user_id", "user_info"),
        ("payment_info", "order_id", "order_info"),
        ("refund_info", "user_id", "user_info"),
        ("refund_info", "sku_id", "sku_info"),
        ("stock_info", "shop_id", "shop_info"),
        ("user_coupon", "user_id", "user_info"),
        ("user_coupon", "coupon_id", "coupon_info"),
    )
    parents = {p: (s[p], KEYS[p]) for _, _, p in references}
    return profiling.reference_matches(s, parents, references)


def check_grain_unique(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    loaded = [
        checks.grain_unique(retail.fact(f.name), [f.grain], f.name)
        for f in FACTS.values()
    ]
    lines = retail.bindings.table("lineitem")
    declared = ["l_orderkey", "l_linenumber"]
    return checks.union_all([*loaded, checks.grain_unique(lines, declared, "lineitem")])


def check_repeated_grain(spark: SparkSession, folder: str) -> DataFrame:
    lines = Bindings(spark, folder).table("lineitem")
    return checks.repeated_grain(lines, ["l_orderkey", "l_linenumber"])


def check_join_miss(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return checks.union_all(
        [
            checks.lookup_miss(
                retail.fact(f.name), f.name, {d: DIMS[d].sk for d, _ in f.lookups}
            )
            for f in FACTS.values()
        ]
    )


def coverage_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return checks.coverage_matrix(check_join_miss(spark, folder), list(DIMS))


def check_conformed_attr(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    fact = retail.fact("order_detail")
    dim = current_slice(retail.dim("sku"), retail.bizdate)
    return checks.conformed_attribute(
        fact, "sku_sk", "sku_name", dim, "sku_sk", "sku_name"
    )


def check_one_to_one(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    tables = [
        (d.table, DIM_SOURCE[d.name], current_slice(retail.dim(d.name), retail.bizdate))
        for d in DIMS.values()
    ] + [
        (f.table, FACT_SOURCE[f.name], retail.fact(f.name))
        for f in FACTS.values()
    ]
    return checks.union_all(
        [
            checks.one_to_one(retail.landed(src), KEYS[src], target, KEYS[src], name)
            for name, src, target in tables
        ]
    )


def check_scd2_intervals(spark: SparkSession, folder: str) -> DataFrame:
    users = Retail(spark, folder, 3).dim("user")
    articles = Retail(spark, folder, 2).dim("sku")
    return checks.union_all(
        [
            checks.scd2_intervals(users, "user_id", "dim_user"),
            checks.scd2_intervals(articles, "sku_id", "dim_sku"),
        ]
    )


def published_fact(spark: SparkSession, folder: str) -> DataFrame:
    """A fact written twice for one day and read back: a rerun replaces the day."""
    retail = Retail(spark, folder)
    root = f"{retail.root}/place_order"
    for _ in range(2):
        fact = retail.loaded_fact("place_order")
        publish(fact, root, retail.bizdate, stripe_bytes=FACT_STRIPE_BYTES)
    return _plain(read_partition(spark, root, retail.bizdate))


def published_ods(spark: SparkSession, folder: str) -> DataFrame:
    """A landed table over three days, read back as one partitioned table."""
    retail = Retail(spark, folder)
    for day in DAYS:
        retail.landed("user_info", day)
    name = landed_name("user_info")
    return _plain(read_table(spark, f"{retail.root}/{name}", table_schema(name)))


def published_dim(spark: SparkSession, folder: str) -> DataFrame:
    """A history dimension over three daily copies, read back as one table."""
    retail = Retail(spark, folder, 3)
    retail.dim("user")
    name = DIMS["user"].table
    return _plain(read_table(spark, f"{retail.root}/{name}", table_schema(name)))


def published_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A summary read back from its table by the day column ``dt``."""
    retail = Retail(spark, folder)
    retail.summary("trd_user")
    name = SUMMARIES["trd_user"].table
    table = read_table(spark, f"{retail.root}/{name}", table_schema(name))
    return table.where(F.col("dt") == retail.bizdate)


def fact_from_many_days(spark: SparkSession, folder: str) -> DataFrame:
    """A load from a source table that holds the day before as well."""
    retail = Retail(spark, folder, 2)
    for day in (1, 2):
        retail.landed("payment_info", day)
    name = landed_name("payment_info")
    src = read_table(spark, f"{retail.root}/{name}", table_schema(name))
    dims = {"user": retail.dim("user")}
    return _plain(load_fact(src, dims, FACTS["payment"], DIMS, retail.bizdate))


def fact_for_event_day(spark: SparkSession, folder: str) -> DataFrame:
    """Only the orders placed on one day, of a cumulative source."""
    retail = Retail(spark, folder)
    src = retail.landed("order_info")
    day = src.agg(F.min("order_time")).first()[0][:10]
    events = src.withColumn("pt", F.lit(day))
    dims = {d: retail.dim(d).withColumn("pt", F.lit(day)) for d in ("user", "shop")}
    fact = load_fact(
        events, dims, FACTS["place_order"], DIMS, day, event_date="order_time"
    )
    return _plain(fact)


def catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    """A published dimension asked for as a catalog table."""
    retail = Retail(spark, folder)
    retail.dim("shop")
    table = DIMS["shop"].table
    name = f"starflow_{uuid.uuid4().hex}"
    create_table(spark, name, table_schema(table), f"{retail.root}/{table}")
    add_partition(spark, name, retail.bizdate)
    return _plain(spark.sql(f"SELECT * FROM {name} WHERE pt = '{retail.bizdate}'"))


def scd2_audit_times(spark: SparkSession, folder: str) -> DataFrame:
    """When each version of day 2 was inserted and last changed, for fixed load times."""
    retail = Retail(spark, folder, 2)
    spec, root = DIMS["user"], f"{retail.root}/audited"
    for day, at in ((1, datetime(2026, 7, 7, 3)), (2, datetime(2026, 7, 8, 3))):
        prev = read_previous(spark, root, DAYS[day], schema=table_schema(spec.table))
        merged = scd2_merge(prev, retail.landed("user_info", day), spec, DAYS[day], at=at)
        publish(merged, root, DAYS[day])
    rows = read_partition(spark, root, DAYS[2])
    times = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        for c in ("etl_insert_time", "etl_update_time")
    ]
    return rows.select("user_sk", "user_id", "is_active", *times)


def dense_key_decimal(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers by a decimal key that no double can hold."""
    lines = Bindings(spark, folder).table("lineitem")
    long = (
        F.col("l_orderkey").cast("decimal(38,0)") * F.lit(10**9) * F.lit(10**9)
        + F.col("l_partkey") * F.lit(1000)
        + F.col("l_linenumber")
    ).cast("decimal(38,0)")
    return dense_key(lines.select(long.alias("k")).distinct(), "k", "sk", unique=True)


def check_broken_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """The interval rules over a history with nested, touching and missing stretches."""
    orders = Bindings(spark, folder).table("orders")
    begin = F.col("o_orderdate").cast("date")
    nested = F.when(F.col("o_orderkey") % 7 == 0, 400).otherwise(F.col("o_orderkey") % 40)
    history = orders.select(
        F.col("o_custkey").alias("user_id"),
        begin.cast("string").alias("begin_date"),
        F.date_add(begin, nested.cast("int")).cast("string").alias("end_date"),
        (F.col("o_orderkey") % 3 == 0).cast("int").alias("is_active"),
    ).distinct()
    return checks.scd2_intervals(history, "user_id", "broken")


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {"land_all_counts": land_all_counts}
    found |= {f"land_{t}": partial(_land, t) for t in SOURCES}
    found |= {
        "map_orders": map_orders,
        "dense_surrogate_key": dense_surrogate_key,
        "dense_key_by_ranges": dense_key_by_ranges,
        "dense_key_appended": dense_key_appended,
        "scd1_dim_shop": partial(_dim, "shop", 1),
        "scd1_dim_coupon": partial(_dim, "coupon", 1),
        "scd2_dim_user_day1": partial(_dim, "user", 1),
        "scd2_dim_user_day2": partial(_dim, "user", 2),
        "scd2_dim_user_day3": partial(_dim, "user", 3),
        "scd2_dim_sku_day1": partial(_dim, "sku", 1),
        "scd2_dim_sku_day2": partial(_dim, "sku", 2),
        "scd2_as_written": scd2_as_written,
        "scd2_closed_rows": scd2_closed_rows,
        "scd2_opened_rows": scd2_opened_rows,
        "scd2_carried_rows": scd2_carried_rows,
        "scd2_current_slice": scd2_current_slice,
        "scd2_valid_on_day1": scd2_valid_on_day1,
        "scd2_audit_times": scd2_audit_times,
        "dense_key_decimal": dense_key_decimal,
    }
    found |= {f"fact_{f}": partial(_fact, f) for f in FACTS}
    found |= {
        "fact_order_detail_with_order": fact_order_detail_with_order,
        "published_fact": published_fact,
        "published_ods": published_ods,
        "published_dim": published_dim,
        "published_summary": published_summary,
        "fact_from_many_days": fact_from_many_days,
        "fact_for_event_day": fact_for_event_day,
        "catalog_table": catalog_table,
        "unknown_member": unknown_member,
        "derived_discount": derived_discount,
    }
    found |= {f"dq_{f}": partial(_quality, f) for f in FACTS}
    found |= {f"dws_{s}": partial(_summary, s) for s in SUMMARIES}
    found |= {
        "stock_period_end": stock_period_end,
        "stock_daily_average": stock_daily_average,
        "profile_row_counts": profile_row_counts,
        "profile_null_rate": profile_null_rate,
        "profile_columns": profile_columns,
        "profile_candidate_key": profile_candidate_key,
        "profile_fk_inclusion": profile_fk_inclusion,
        "fact_orders_point_in_time": fact_orders_point_in_time,
        "extract_changes": extract_changes,
        "stock_carried_week": stock_carried_week,
        "profile_minimal_keys": profile_minimal_keys,
        "profile_references": profile_references,
        "check_grain_unique": check_grain_unique,
        "check_repeated_grain": check_repeated_grain,
        "check_join_miss": check_join_miss,
        "check_conformed_attr": check_conformed_attr,
        "check_one_to_one": check_one_to_one,
        "check_scd2_intervals": check_scd2_intervals,
        "check_broken_intervals": check_broken_intervals,
        "coverage_matrix": coverage_matrix,
    }
    return found
