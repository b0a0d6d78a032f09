"""The model's specs written out, apart from the SQL that is generated from them."""

from starflow.plans.model import DIMS, FACTS, SUMMARIES


def test_tracked_and_fixed_attributes():
    assert {d.name: (d.key, set(d.tracked), set(d.fixed)) for d in DIMS.values()} == {
        "coupon": ("coupon_id", set(), set()),
        "shop": ("shop_id", set(), set()),
        "sku": ("sku_id", {"cost_price", "sale_price", "is_on_sale"}, set()),
        "user": ("user_id", {"phone", "city_name"}, {"register_time", "register_channel"}),
    }


def test_fact_grains_lookups_and_measures():
    found = {
        f.name: (f.grain, dict(f.lookups), {m.name: m.additivity for m in f.measures})
        for f in FACTS.values()
    }
    user, shop, sku = {"user": "user_id"}, {"shop": "shop_id"}, {"sku": "sku_id"}
    assert found == {
        "place_order": (
            "order_id",
            user | shop,
            dict.fromkeys(("total_amount", "pay_amount", "discount_amount"), "additive"),
        ),
        "order_detail": (
            "id",
            sku,
            dict.fromkeys(("quantity", "original_amount", "split_amount"), "additive"),
        ),
        "payment": ("pay_id", user, {"pay_amount": "additive"}),
        "refund": ("refund_id", user | sku, {"refund_amount": "additive"}),
        "inventory_snapshot": ("id", sku | shop, {"stock_num": "semi_additive"}),
        "coupon_usage": ("id", user | {"coupon": "coupon_id"}, {}),
    }


def test_summary_grains_and_metrics():
    found = {
        s.name: (s.grain, {m.name: (m.fact, m.column, m.agg) for m in s.metrics})
        for s in SUMMARIES.values()
    }
    orders = {
        "order_cnt": ("place_order", "order_id", "count"),
        "total_amount_sum": ("place_order", "total_amount", "sum"),
        "pay_amount_sum": ("place_order", "pay_amount", "sum"),
        "discount_amount_sum": ("place_order", "discount_amount", "sum"),
    }
    refunds = {
        "refund_cnt": ("refund", "refund_id", "count"),
        "refund_amount_sum": ("refund", "refund_amount", "sum"),
    }
    coupons = {"coupon_use_cnt": ("coupon_usage", "id", "count")}
    assert found == {
        "trd_user": (
            ("user",),
            orders
            | refunds
            | {
                "payment_cnt": ("payment", "pay_id", "count"),
                "payment_amount_sum": ("payment", "pay_amount", "sum"),
            },
        ),
        "trd_sku": (
            ("sku",),
            refunds
            | {
                "order_quantity_sum": ("order_detail", "quantity", "sum"),
                "original_amount_sum": ("order_detail", "original_amount", "sum"),
                "split_amount_sum": ("order_detail", "split_amount", "sum"),
            },
        ),
        "trd_shop": (("shop",), orders),
        "inv_shop_sku": (
            ("shop", "sku"),
            {
                f"stock_num_{a}": ("inventory_snapshot", "stock_num", a)
                for a in ("avg", "max", "min")
            },
        ),
        "mkt_user": (("user",), coupons),
        "mkt_coupon": (("coupon",), coupons),
    }
