"""The retail star schema: four dimensions, six facts, six summaries.

All names, column lists and aggregate choices here are fixed values of the model.
"""

from __future__ import annotations

from starflow.plans.schemas import landed_name
from starflow.specs import SEMI_ADDITIVE, DimSpec, FactSpec, Measure, Metric, SummarySpec

AMOUNT = "decimal(18,2)"
COUNT = "bigint"

DIMS = {
    d.name: d
    for d in (
        DimSpec(
            name="coupon",
            source=landed_name("coupon_info"),
            key="coupon_id",
            attributes=(
                "coupon_name",
                "discount_type",
                "min_amount",
                "discount_amount",
                "start_time",
                "end_time",
            ),
        ),
        DimSpec(
            name="shop",
            source=landed_name("shop_info"),
            key="shop_id",
            attributes=("shop_name", "city_id", "city_name", "manager_name", "is_open"),
        ),
        DimSpec(
            name="sku",
            source=landed_name("sku_info"),
            key="sku_id",
            attributes=(
                "spu_id",
                "sku_name",
                "category_id",
                "category_name",
                "shop_id",
                "cost_price",
                "sale_price",
                "is_on_sale",
            ),
            tracked=("cost_price", "sale_price", "is_on_sale"),
        ),
        DimSpec(
            name="user",
            source=landed_name("user_info"),
            key="user_id",
            attributes=(
                "user_name",
                "gender",
                "phone",
                "register_time",
                "register_channel",
                "city_name",
            ),
            tracked=("phone", "city_name"),
            fixed=("register_time", "register_channel"),
        ),
    )
}

FACTS = {
    f.name: f
    for f in (
        FactSpec(
            name="place_order",
            table="dwd_trd_place_order_df",
            source=landed_name("order_info"),
            grain="order_id",
            lookups=(("user", "user_id"), ("shop", "shop_id")),
            carried=("order_status", "order_time", "pay_time"),
            measures=(
                Measure("total_amount"),
                Measure("pay_amount"),
                Measure("discount_amount"),
            ),
        ),
        FactSpec(
            name="order_detail",
            table="dwd_trd_order_detail_df",
            source=landed_name("order_item"),
            grain="id",
            lookups=(("sku", "sku_id"),),
            carried=("sku_name",),
            measures=(
                Measure("quantity"),
                Measure("original_amount"),
                Measure("split_amount"),
            ),
        ),
        FactSpec(
            name="payment",
            table="dwd_trd_payment_df",
            source=landed_name("payment_info"),
            grain="pay_id",
            lookups=(("user", "user_id"),),
            carried=("pay_type", "pay_status", "pay_time"),
            measures=(Measure("pay_amount"),),
        ),
        FactSpec(
            name="refund",
            table="dwd_trd_refund_df",
            source=landed_name("refund_info"),
            grain="refund_id",
            lookups=(("user", "user_id"), ("sku", "sku_id")),
            carried=("refund_status", "refund_time"),
            measures=(Measure("refund_amount"),),
        ),
        FactSpec(
            name="inventory_snapshot",
            table="dwd_inv_inventory_snapshot_df",
            source=landed_name("stock_info"),
            grain="id",
            lookups=(("sku", "sku_id"), ("shop", "shop_id")),
            measures=(Measure("stock_num", SEMI_ADDITIVE),),
        ),
        FactSpec(
            name="coupon_usage",
            table="dwd_mkt_coupon_usage_df",
            source=landed_name("user_coupon"),
            grain="id",
            lookups=(("user", "user_id"), ("coupon", "coupon_id")),
            carried=("use_status", "use_time"),
        ),
    )
}

SUMMARIES = {
    s.name: s
    for s in (
        SummarySpec(
            name="trd_user",
            table="dws_trd_user_df",
            grain=("user",),
            attributes={"user": ("gender", "register_channel")},
            metrics=(
                Metric("order_cnt", "place_order", "order_id", "count", COUNT),
                Metric("total_amount_sum", "place_order", "total_amount", "sum", AMOUNT),
                Metric("pay_amount_sum", "place_order", "pay_amount", "sum", AMOUNT),
                Metric(
                    "discount_amount_sum", "place_order", "discount_amount", "sum", AMOUNT
                ),
                Metric("payment_cnt", "payment", "pay_id", "count", COUNT),
                Metric("payment_amount_sum", "payment", "pay_amount", "sum", AMOUNT),
                Metric("refund_cnt", "refund", "refund_id", "count", COUNT),
                Metric("refund_amount_sum", "refund", "refund_amount", "sum", AMOUNT),
            ),
        ),
        SummarySpec(
            name="trd_sku",
            table="dws_trd_sku_df",
            grain=("sku",),
            attributes={"sku": ("sku_name", "category_name")},
            metrics=(
                Metric("order_quantity_sum", "order_detail", "quantity", "sum", COUNT),
                Metric(
                    "original_amount_sum",
                    "order_detail",
                    "original_amount",
                    "sum",
                    AMOUNT,
                ),
                Metric("split_amount_sum", "order_detail", "split_amount", "sum", AMOUNT),
                Metric("refund_cnt", "refund", "refund_id", "count", COUNT),
                Metric("refund_amount_sum", "refund", "refund_amount", "sum", AMOUNT),
            ),
        ),
        SummarySpec(
            name="trd_shop",
            table="dws_trd_shop_df",
            grain=("shop",),
            attributes={"shop": ("shop_name", "city_name")},
            metrics=(
                Metric("order_cnt", "place_order", "order_id", "count", COUNT),
                Metric("total_amount_sum", "place_order", "total_amount", "sum", AMOUNT),
                Metric("pay_amount_sum", "place_order", "pay_amount", "sum", AMOUNT),
                Metric(
                    "discount_amount_sum", "place_order", "discount_amount", "sum", AMOUNT
                ),
            ),
        ),
        SummarySpec(
            name="inv_shop_sku",
            table="dws_inv_shop_sku_df",
            grain=("shop", "sku"),
            attributes={"shop": ("shop_name",), "sku": ("sku_name",)},
            metrics=(
                Metric("stock_num_avg", "inventory_snapshot", "stock_num", "avg", AMOUNT),
                Metric("stock_num_max", "inventory_snapshot", "stock_num", "max", COUNT),
                Metric("stock_num_min", "inventory_snapshot", "stock_num", "min", COUNT),
            ),
        ),
        SummarySpec(
            name="mkt_user",
            table="dws_mkt_user_df",
            grain=("user",),
            attributes={"user": ("gender", "register_channel")},
            metrics=(Metric("coupon_use_cnt", "coupon_usage", "id", "count", COUNT),),
        ),
        SummarySpec(
            name="mkt_coupon",
            table="dws_mkt_coupon_df",
            grain=("coupon",),
            attributes={"coupon": ("coupon_name", "discount_type")},
            metrics=(Metric("coupon_use_cnt", "coupon_usage", "id", "count", COUNT),),
        ),
    )
}

for _summary in SUMMARIES.values():
    _summary.check(FACTS)
