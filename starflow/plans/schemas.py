"""Schemas of the landed source tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(16, 2)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "tinyint": ByteType(),
    "money": MONEY,
    "string": StringType(),
}

# Columns and types of the ten landed tables.
_COLUMNS = {
    "coupon_info": """
        coupon_id bigint, coupon_name string, discount_type tinyint,
        min_amount money, discount_amount money, start_time string,
        end_time string""",
    "order_info": """
        order_id bigint, user_id bigint, shop_id bigint, order_status tinyint,
        total_amount money, pay_amount money, discount_amount money,
        order_time string, pay_time string, is_deleted tinyint,
        create_time string, update_time string""",
    "order_item": """
        id bigint, order_id bigint, sku_id bigint, sku_name string, quantity int,
        original_amount money, split_amount money, create_time string""",
    "payment_info": """
        pay_id bigint, order_id bigint, user_id bigint, pay_type string,
        pay_amount money, pay_status tinyint, pay_time string,
        create_time string""",
    "refund_info": """
        refund_id bigint, order_id bigint, user_id bigint, sku_id bigint,
        refund_amount money, refund_status tinyint, refund_time string,
        create_time string""",
    "shop_info": """
        shop_id bigint, shop_name string, city_id bigint, city_name string,
        manager_name string, is_open tinyint, create_time string,
        update_time string""",
    "sku_info": """
        sku_id bigint, spu_id bigint, sku_name string, category_id bigint,
        category_name string, shop_id bigint, cost_price money,
        sale_price money, is_on_sale tinyint, is_deleted tinyint,
        create_time string, update_time string""",
    "stock_info": """
        id bigint, sku_id bigint, shop_id bigint, stock_num int,
        update_time string""",
    "user_coupon": """
        id bigint, user_id bigint, coupon_id bigint, order_id bigint,
        use_status tinyint, create_time string, use_time string""",
    "user_info": """
        user_id bigint, user_name string, gender string, phone string,
        register_time string, register_channel string, city_name string,
        is_deleted tinyint, create_time string, update_time string""",
}

# Key column of each landed table.
KEYS = {
    "coupon_info": "coupon_id",
    "order_info": "order_id",
    "order_item": "id",
    "payment_info": "pay_id",
    "refund_info": "refund_id",
    "shop_info": "shop_id",
    "sku_info": "sku_id",
    "stock_info": "id",
    "user_coupon": "id",
    "user_info": "user_id",
}


def _struct(columns: str) -> StructType:
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCES: dict[str, StructType] = {t: _struct(c) for t, c in _COLUMNS.items()}


def landed_name(table: str) -> str:
    return f"ods_mall_oltp_{table}_df"
