"""The queries of :mod:`starflow.plans.queries` as SQL for DuckDB.

Each query names the common table expressions it needs; ``_sql`` puts them and
what they need in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

from starflow.plans.bindings import DAYS, LINE_ORDER
from starflow.plans.model import DIMS, FACTS, SUMMARIES
from starflow.plans.schemas import KEYS, SOURCES

D1, D2, D3 = DAYS[1], DAYS[2], DAYS[3]
MONEY = "DECIMAL(16,2)"
_LINES = ", ".join(LINE_ORDER)
_NONE = "CAST(NULL AS VARCHAR)"

# Landed source tables, by day where they change.
CTES: dict[str, str] = {
    "user_info_1": f"""
        SELECT c_custkey AS user_id, c_name AS user_name,
               CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS gender,
               CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS phone,
               {_NONE} AS register_time, c_mktsegment AS register_channel,
               n_name AS city_name, CAST(0 AS TINYINT) AS is_deleted,
               {_NONE} AS create_time, {_NONE} AS update_time
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        WHERE c_custkey % 20 <> 19""",
    "shop_info": f"""
        SELECT s_suppkey AS shop_id, s_name AS shop_name,
               CAST(s_nationkey AS BIGINT) AS city_id, n_name AS city_name,
               {_NONE} AS manager_name, CAST(s_acctbal >= 0 AS TINYINT) AS is_open,
               {_NONE} AS create_time, {_NONE} AS update_time
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "sku_info_1": f"""
        SELECT p_partkey AS sku_id, p_partkey // 10 AS spu_id, p_name AS sku_name,
               CAST(p_size AS BIGINT) AS category_id, p_type AS category_name,
               p_partkey % 10 AS shop_id, CAST(NULL AS {MONEY}) AS cost_price,
               CAST(p_retailprice AS {MONEY}) AS sale_price,
               CAST(1 AS TINYINT) AS is_on_sale, CAST(0 AS TINYINT) AS is_deleted,
               {_NONE} AS create_time, {_NONE} AS update_time
        FROM part""",
    "sku_info_2": f"""
        SELECT * REPLACE (
            CASE WHEN sku_id % 7 = 0 THEN CAST(1 AS {MONEY}) END AS cost_price,
            CAST(sale_price + CASE WHEN sku_id % 9 = 0 THEN 1 ELSE 0 END AS {MONEY})
                AS sale_price,
            CAST(CASE WHEN sku_id % 11 = 0 THEN 0 ELSE 1 END AS TINYINT) AS is_on_sale)
        FROM sku_info_1""",
    "coupon_info": f"""
        SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS coupon_id,
               'C' || CAST(round(l_discount * 100) AS BIGINT) AS coupon_name,
               CAST(2 AS TINYINT) AS discount_type, CAST(0 AS {MONEY}) AS min_amount,
               CAST(l_discount AS {MONEY}) AS discount_amount,
               {_NONE} AS start_time, {_NONE} AS end_time
        FROM lineitem WHERE l_discount > 0""",
    "order_info": f"""
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               o_orderkey % 10 AS shop_id,
               CAST(CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 2
                    WHEN 'P' THEN 1 END AS TINYINT) AS order_status,
               total AS total_amount, paid AS pay_amount,
               CAST(total - paid AS {MONEY}) AS discount_amount,
               strftime(o_orderdate, '%Y-%m-%d') AS order_time,
               {_NONE} AS pay_time, CAST(0 AS TINYINT) AS is_deleted,
               {_NONE} AS create_time, {_NONE} AS update_time
        FROM (SELECT *, CAST(total * 0.90 AS {MONEY}) AS paid
              FROM (SELECT *, CAST(o_totalprice AS {MONEY}) AS total FROM orders))""",
    "order_item": f"""
        SELECT id, l_orderkey AS order_id, l_partkey AS sku_id, p_name AS sku_name,
               CAST(l_quantity AS INTEGER) AS quantity, price AS original_amount,
               CAST(price * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {MONEY})
                   AS split_amount,
               {_NONE} AS create_time
        FROM (SELECT *, CAST(l_extendedprice AS {MONEY}) AS price,
                     row_number() OVER (ORDER BY {_LINES}) AS id FROM lineitem)
        JOIN part ON p_partkey = l_partkey""",
    "payment_info": f"""
        SELECT event_id AS pay_id, CAST(NULL AS BIGINT) AS order_id, user_id,
               event_type AS pay_type, CAST(value AS {MONEY}) AS pay_amount,
               CAST(1 AS TINYINT) AS pay_status,
               strftime(ts, '%Y-%m-%d') AS pay_time, {_NONE} AS create_time
        FROM events WHERE event_type = 'purchase'""",
    "refund_info": f"""
        SELECT refund_id, l_orderkey AS order_id, o_custkey AS user_id,
               l_partkey AS sku_id, CAST(l_extendedprice AS {MONEY}) AS refund_amount,
               CAST(1 AS TINYINT) AS refund_status,
               strftime(l_shipdate, '%Y-%m-%d') AS refund_time,
               {_NONE} AS create_time
        FROM (SELECT *, row_number() OVER (ORDER BY {_LINES}) AS refund_id
              FROM lineitem WHERE l_returnflag = 'R')
        JOIN orders ON o_orderkey = l_orderkey""",
    "stock_info": f"""
        SELECT row_number() OVER (ORDER BY {_LINES}) AS id, l_partkey AS sku_id,
               l_suppkey AS shop_id, CAST(l_quantity AS INTEGER) AS stock_num,
               strftime(l_shipdate, '%Y-%m-%d') AS update_time
        FROM lineitem""",
    "user_coupon": f"""
        SELECT id, o_custkey AS user_id,
               CAST(round(l_discount * 100) AS BIGINT) AS coupon_id,
               l_orderkey AS order_id, CAST(1 AS TINYINT) AS use_status,
               {_NONE} AS create_time, strftime(l_shipdate, '%Y-%m-%d') AS use_time
        FROM (SELECT *, row_number() OVER (ORDER BY {_LINES}) AS id
              FROM lineitem WHERE l_discount > 0)
        JOIN orders ON o_orderkey = l_orderkey""",
}
for _day, _shift in ((2, 1), (3, 2)):
    CTES[f"user_info_{_day}"] = f"""
        SELECT c_custkey AS user_id,
               CASE WHEN c_custkey % 10 = 4 THEN c_name || '*' ELSE c_name END
                   AS user_name,
               CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS gender,
               CASE WHEN c_custkey % 15 = 0 THEN ''
                    WHEN c_custkey % 35 = 5 THEN 'p'
                    WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS phone,
               {_NONE} AS register_time, c_mktsegment AS register_channel,
               n_name AS city_name, CAST(0 AS TINYINT) AS is_deleted,
               {_NONE} AS create_time, {_NONE} AS update_time
        FROM customer JOIN nation ON n_nationkey =
             CASE WHEN c_custkey % 10 = 3 THEN (c_nationkey + {_shift}) % 25
                  ELSE c_nationkey END
        WHERE c_custkey % 20 <> 18"""


def _landed(table: str, day: int = 1) -> str:
    if table == "user_info":
        return f"user_info_{day}"
    if table == "sku_info":
        return f"sku_info_{min(day, 2)}"
    return table


def _overwritten(name: str, source: str) -> str:
    d = DIMS[name]
    return f"""
        SELECT row_number() OVER (ORDER BY {d.key}) AS {d.sk}, {d.key},
               {", ".join(d.attributes)}, '{D1}' AS pt
        FROM {source}"""


def _first_history(name: str, source: str) -> str:
    d = DIMS[name]
    return f"""
        SELECT row_number() OVER (ORDER BY {d.key}) AS {d.sk}, {d.key},
               {", ".join(d.attributes)}, '{D1}' AS begin_date,
               '9999-12-31' AS end_date, 1 AS is_active, '{D1}' AS pt
        FROM {source}"""


def _next_history(
    name: str, before: str, source: str, date: str, refresh: bool = True
) -> dict[str, str]:
    """The steps of one merge, each as its own expression."""
    d = DIMS[name]
    text = SOURCES[source.rsplit("_", 1)[0]]
    differs = " OR ".join(
        f"coalesce(o.{c}, '') <> coalesce(n.{c}, '')"
        if text[c].dataType.simpleString() == "string"
        else f"o.{c} IS DISTINCT FROM n.{c}"
        for c in d.tracked
    )
    tag = f"{name}_{date[-2:]}_{'r' if refresh else 'k'}"
    new = ", ".join(f"n.{c}" for c in d.attributes)
    old = ", ".join(f"o.{c}" for c in d.attributes)
    kept = ", ".join(
        f"CASE WHEN n.{d.key} IS NOT NULL AND o.is_active = 1 THEN n.{c} "
        f"ELSE o.{c} END AS {c}"
        if refresh and c in d.refreshed
        else f"o.{c}"
        for c in d.attributes
    )
    return {
        f"closed_{tag}": f"""
            SELECT o.{d.sk}, o.{d.key}, {old}, o.begin_date, '{date}' AS end_date,
                   0 AS is_active, '{date}' AS pt
            FROM {before} o JOIN {source} n ON o.{d.key} = n.{d.key}
            WHERE o.is_active = 1 AND ({differs})""",
        f"opened_{tag}": f"""
            SELECT (SELECT max({d.sk}) FROM {before})
                   + row_number() OVER (ORDER BY n.{d.key}) AS {d.sk},
                   n.{d.key}, {new}, '{date}' AS begin_date,
                   '9999-12-31' AS end_date, 1 AS is_active, '{date}' AS pt
            FROM {source} n
            WHERE n.{d.key} NOT IN (SELECT {d.key} FROM {before} WHERE is_active = 1)
               OR n.{d.key} IN (SELECT {d.key} FROM closed_{tag})""",
        f"carried_{tag}": f"""
            SELECT o.{d.sk}, o.{d.key}, {kept}, o.begin_date, o.end_date,
                   o.is_active, '{date}' AS pt
            FROM {before} o LEFT JOIN {source} n ON o.{d.key} = n.{d.key}
            WHERE o.{d.sk} NOT IN (SELECT {d.sk} FROM closed_{tag})""",
        f"merged_{tag}": f"""
            SELECT * FROM closed_{tag} UNION ALL SELECT * FROM opened_{tag}
            UNION ALL SELECT * FROM carried_{tag}""",
    }


CTES["dim_shop"] = _overwritten("shop", "shop_info")
CTES["dim_coupon"] = _overwritten("coupon", "coupon_info")
CTES["dim_sku"] = _first_history("sku", "sku_info_1")
CTES["dim_user"] = _first_history("user", "user_info_1")
CTES |= _next_history("user", "dim_user", "user_info_2", D2)
CTES |= _next_history("user", "dim_user", "user_info_2", D2, refresh=False)
CTES |= _next_history("user", "merged_user_08_r", "user_info_3", D3)
CTES |= _next_history("sku", "dim_sku", "sku_info_2", D2)

# Facts, all on day 1.
_FACT_SOURCE = {
    "place_order": "order_info",
    "order_detail": "order_item",
    "payment": "payment_info",
    "refund": "refund_info",
    "inventory_snapshot": "stock_info",
    "coupon_usage": "user_coupon",
}
_ACTIVE = {"user": " AND {a}.is_active = 1", "sku": " AND {a}.is_active = 1"}


def _fact(name: str, keep: tuple[str, ...] = ()) -> str:
    f = FACTS[name]
    joins = "".join(
        f"\n        LEFT JOIN dim_{d} {d} ON s.{fk} = {d}.{DIMS[d].key}"
        + _ACTIVE.get(d, "").format(a=d)
        for d, fk in f.lookups
    )
    sks = [f"coalesce({d}.{DIMS[d].sk}, -1) AS {DIMS[d].sk}" for d, _ in f.lookups]
    found = " AND ".join(f"{d}.{DIMS[d].sk} IS NOT NULL" for d, _ in f.lookups)
    columns = [
        f"s.{f.grain}",
        f"row_number() OVER (ORDER BY s.{f.grain}) AS {f.sk}",
        *sks,
        *[f"s.{c}" for c in (*keep, *f.carried, *f.measure_names)],
        f"CASE WHEN {found} THEN 1 ELSE 0 END AS is_valid",
        f"'{f.source}' AS source_system",
        f"'{D1}' AS pt",
    ]
    return f"SELECT {', '.join(columns)} FROM {_FACT_SOURCE[name]} s{joins}"


for _name in FACTS:
    CTES[f"fact_{_name}"] = _fact(_name)


def _quality(name: str) -> str:
    f = FACTS[name]
    ranges = "".join(
        f", min({m}) AS {m}_min, max({m}) AS {m}_max" for m in f.measure_names
    )
    return f"""
        SELECT '{f.table}' AS table_name, '{D1}' AS pt, count(*) AS total_records,
               CAST(sum(CASE WHEN is_valid = 1 THEN 1 ELSE 0 END) AS BIGINT)
                   AS valid_records{ranges}
        FROM fact_{name}"""


def _summary(name: str) -> str:
    """One aggregate per fact, outer-joined on the grain, then the attributes."""
    s = SUMMARIES[name]
    sks = [DIMS[d].sk for d in s.grain]
    using = ", ".join(sks)
    parts = []
    for fact in s.facts:
        metrics = ", ".join(
            f"CAST({m.agg}({m.column}) AS {m.dtype}) AS {m.name}"
            for m in s.metrics
            if m.fact == fact
        )
        parts.append(
            f"(SELECT {using}, {metrics} FROM fact_{fact} WHERE is_valid = 1 "
            f"GROUP BY {using})"
        )
    joined = parts[0] + " a0"
    for i, part in enumerate(parts[1:], start=1):
        joined += f" FULL JOIN {part} a{i} USING ({using})"
    dims = "".join(
        f" LEFT JOIN dim_{d} ON dim_{d}.{DIMS[d].sk} = totals.{DIMS[d].sk}"
        for d in s.grain
    )
    columns = [
        f"'{D1}' AS dt",
        *[f"dim_{d}.{DIMS[d].key}" for d in s.grain],
        *[f"dim_{d}.{a}" for d in s.grain for a in s.attributes.get(d, ())],
        *[
            f"coalesce({m.name}, 0) AS {m.name}" if m.agg == "count" else m.name
            for m in s.metrics
        ],
    ]
    return f"""
        SELECT {", ".join(columns)}
        FROM (SELECT * FROM {joined}) totals{dims}"""


def _land(table: str, schema: StructType) -> str:
    return f"SELECT {', '.join(schema.names)}, '{D1}' AS pt FROM {_landed(table)}"


def _stacked(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


def _columns_profile(*extra: str) -> str:
    """Per landed column of day 2: the row and null counts, and ``extra``."""
    selects = []
    for table, schema in SOURCES.items():
        for i, f in enumerate(schema.fields, start=1):
            kind = f.dataType.simpleString()
            values = {
                "position": f"{i} AS position",
                "data_type": f"'{kind}' AS data_type",
                "row_count": "count(*) AS row_count",
                "null_rate": f"CAST((count(*) - count({f.name})) / count(*) "
                "AS DECIMAL(9,6)) AS null_rate",
            }
            wanted = "".join(f", {values[e]}" for e in extra)
            selects.append(
                f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, "
                f"count(*) - count({f.name}) AS null_count{wanted} "
                f"FROM {_landed(table, 2)}"
            )
    return _stacked(selects)


# The columns of the test tables and the class their values compare in
# across tables (exact numbers, strings, timestamps; '-' for none).
_CLASSED = {
    "region": "r_regionkey:exact r_name:string",
    "nation": "n_nationkey:exact n_name:string n_regionkey:exact",
    "customer": "c_custkey:exact c_name:string c_nationkey:exact c_acctbal:- c_mktsegment:string",
    "supplier": "s_suppkey:exact s_name:string s_nationkey:exact s_acctbal:-",
    "part": "p_partkey:exact p_name:string p_brand:string p_type:string p_size:exact p_retailprice:-",
    "orders": "o_orderkey:exact o_custkey:exact o_orderstatus:string o_totalprice:- "
    "o_orderdate:timestamp o_orderpriority:string",
    "lineitem": "l_orderkey:exact l_partkey:exact l_suppkey:exact l_linenumber:exact l_quantity:- "
    "l_extendedprice:- l_discount:- l_tax:- l_returnflag:string l_linestatus:string l_shipdate:timestamp",
    "events": "event_id:exact ts:timestamp user_id:exact event_type:string value:- props:string",
    "documents": "doc_id:exact text:string lang:string source:string n_chars:exact",
    "embeddings": "vec_id:exact embedding:- label:exact",
    "pages": "page_id:exact url:string html:string",
    "benchmark": "item_id:exact text:string",
    "labels": "doc_id:exact quality:exact toxic:exact",
    "conversations": "conv_id:exact turn:exact role:string text:string",
}
_MEET = {"exact": "DECIMAL(38,10)", "string": "VARCHAR", "timestamp": "TIMESTAMP"}


def _columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in _CLASSED[table].split()]


def _is_key(table: str, columns: tuple[str, ...]) -> str:
    filled = " AND ".join(f"count({c}) = count(*)" for c in columns)
    listed = ", ".join(columns)
    return (
        f"(SELECT count(*) > 0 AND {filled} AND count(*) = "
        f"(SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table})) FROM {table})"
    )


def _minimal_keys_sql(most: int = 3) -> str:
    """Every set of up to ``most`` columns tested; a key is listed when no subset is one."""
    from itertools import combinations

    selects = []
    for table in _CLASSED:
        names = [c for c, _ in _columns_of(table)]
        sets = [s for k in range(1, most + 1) for s in combinations(names, k)]
        flag = {s: f"k{i}" for i, s in enumerate(sets)}
        flags = ", ".join(f"{_is_key(table, s)} AS {flag[s]}" for s in sets)
        rows = f"(SELECT count(*) FROM {table})"
        for s in sets:
            smaller = [flag[x] for k in range(1, len(s)) for x in combinations(s, k)]
            lesser = "".join(f" AND NOT {f}" for f in smaller)
            selects.append(
                f"SELECT '{table}' AS table_name, '{', '.join(s)}' AS key_columns, {len(s)} AS n_columns, "
                f"{rows} AS row_count FROM flags_{table} WHERE {flag[s]}{lesser}"
            )
        selects.append(
            f"SELECT '{table}' AS table_name, NULL AS key_columns, 0 AS n_columns, {rows} AS row_count "
            f"FROM flags_{table} WHERE NOT ({' OR '.join(flag.values())})"
        )
        selects[-len(sets) - 1] = f"SELECT * FROM (WITH flags_{table} AS MATERIALIZED (SELECT {flags}) " + selects[-len(sets) - 1]
        selects[-1] += ")"
    return _stacked(selects)


def _references_sql() -> str:
    """Every pair of columns of one class where the parent is a key holding all child values."""
    parents = [(t, c, k) for t in _CLASSED for c, k in _columns_of(t) if k != "-"]
    flags = ", ".join(f"{_is_key(t, (c,))} AS key_{t}_{c}" for t, c, _ in parents)
    selects = []
    for pt, pc, kind in parents:
        for ct, cc, other in parents:
            if kind != other or (ct, cc) == (pt, pc):
                continue
            meet = _MEET[kind]
            selects.append(
                f"SELECT '{ct}' AS child_table, '{cc}' AS child_column, '{pt}' AS parent_table, "
                f"'{pc}' AS parent_column, (SELECT count(DISTINCT CAST({cc} AS {meet})) FROM {ct}) AS distinct_keys "
                f"FROM keys WHERE key_{pt}_{pc} AND (SELECT count({cc}) FROM {ct}) > 0 AND NOT EXISTS "
                f"(SELECT CAST({cc} AS {meet}) FROM {ct} WHERE {cc} IS NOT NULL "
                f"EXCEPT SELECT CAST({pc} AS {meet}) FROM {pt})"
            )
    return f"WITH keys AS (SELECT {flags})\n" + _stacked(selects)


def _changes_sql() -> str:
    """Changes of landed users and SKUs between consecutive days, column by column."""
    selects = []
    for table, key in (("user_info", "user_id"), ("sku_info", "sku_id")):
        others = [c for c in SOURCES[table].names if c != key]
        for day in (1, 2):
            old, new = _landed(table, day), _landed(table, day + 1)
            differs = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in others)
            selects.append(
                f"SELECT '{table}' AS table_name, '{DAYS[day]}' AS from_day, '{DAYS[day + 1]}' AS to_day, "
                f"coalesce(a.{key}, b.{key}) AS key, CASE WHEN a.{key} IS NULL THEN 'inserted' "
                f"WHEN b.{key} IS NULL THEN 'gone' ELSE 'changed' END AS change "
                f"FROM {old} a FULL JOIN {new} b ON a.{key} = b.{key} "
                f"WHERE a.{key} IS NULL OR b.{key} IS NULL OR {differs}"
            )
    return _stacked(selects)


def _carried_week_sql(first: str = "1998-06-01", last: str = "1998-06-07") -> str:
    """Every day of the week per (shop, SKU), valued by its last total on or before it."""
    daily = f"""(SELECT shop_id, sku_id, update_time AS d, sum(stock_num) AS total
        FROM stock_info WHERE update_time <= '{last}' GROUP BY ALL)"""
    return f"""
        SELECT shop_id, sku_id, CAST(avg(v) AS DECIMAL(18,2)) AS stock_num_mean,
               CAST(max(CASE WHEN d = '{last}' THEN v END) AS BIGINT) AS stock_num_at_end
        FROM (
          SELECT g.shop_id, g.sku_id, g.d,
            (SELECT total FROM {daily} x WHERE x.shop_id = g.shop_id AND x.sku_id = g.sku_id
               AND x.d <= g.d ORDER BY x.d DESC LIMIT 1) AS v
          FROM (SELECT k.shop_id, k.sku_id, strftime(x, '%Y-%m-%d') AS d
                FROM (SELECT DISTINCT shop_id, sku_id FROM {daily}) k,
                     range(DATE '{first}', DATE '{last}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(x)) g
        ) GROUP BY shop_id, sku_id"""


# Columns of the test tables that the key profile covers.
_PROFILED = {
    "region": "r_regionkey r_name",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate "
    "o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity "
    "l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}

_REFERENCES = (
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


def _reference(child: str, fk: str, parent: str) -> str:
    c, p, key = _landed(child, 2), _landed(parent, 2), KEYS[parent]
    return f"""
        SELECT '{child}.{fk}' AS reference, count(*) AS child_rows,
               count(*) - count({fk}) AS null_rows,
               count(*) FILTER (WHERE found) AS matched_rows,
               count(DISTINCT {fk}) AS distinct_keys,
               count(DISTINCT {fk}) FILTER (WHERE NOT found) AS unmatched_keys,
               CAST(CASE WHEN count({fk}) > 0 THEN
                    count(*) FILTER (WHERE found) / count({fk}) END AS DECIMAL(9,6))
                    AS match_rate
        FROM (SELECT {fk}, {fk} IN (SELECT {key} FROM {p}) AS found FROM {c})"""


def _grain(name: str, source: str, grain: str) -> str:
    return f"""
        SELECT '{name}' AS fact_name, CAST(sum(n) AS BIGINT) AS row_count,
               count(*) AS distinct_keys,
               count(*) FILTER (WHERE n > 1) AS repeated_keys,
               CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM {source} GROUP BY {grain})"""


def _miss(fact: str, dim: str, fk: str) -> str:
    missed = f"count(*) FILTER (WHERE {fk} NOT IN (SELECT {DIMS[dim].key} FROM dim_{dim}))"
    return f"""
        SELECT '{fact}' AS fact_name, '{dim}' AS dim_name, count(*) AS fact_rows,
               {missed} AS missed_rows,
               CAST({missed} / count(*) AS DECIMAL(9,6)) AS miss_rate
        FROM {_landed(_FACT_SOURCE[fact])}"""


CTES["misses"] = _stacked(
    [_miss(f.name, d, fk) for f in FACTS.values() for d, fk in f.lookups]
)


def _one_to_one(name: str, source: str, target: str, key: str) -> str:
    return f"""
        SELECT '{name}' AS mapping, CAST(sum(s) AS BIGINT) AS source_rows,
               CAST(sum(t) AS BIGINT) AS target_rows,
               count(*) FILTER (WHERE t = 0) AS source_only_keys,
               count(*) FILTER (WHERE s = 0) AS target_only_keys,
               count(*) FILTER (WHERE s > 1 OR t > 1) AS repeated_keys
        FROM (SELECT sum(s) AS s, sum(t) AS t FROM
              (SELECT {key} AS k, 1 AS s, 0 AS t FROM {source}
               UNION ALL SELECT {key}, 0, 1 FROM {target}) GROUP BY k)"""


def _intervals(name: str, source: str, key: str) -> str:
    return f"""
        SELECT '{name}' AS dim_name, count(*) AS versions,
               count(DISTINCT {key}) AS keys,
               count(DISTINCT {key}) FILTER (WHERE actives <> 1)
                   AS keys_not_one_active,
               count(*) FILTER (WHERE reaching > 0) AS overlaps,
               count(*) FILTER (WHERE earlier > 0 AND touching = 0) AS gaps,
               count(*) FILTER (WHERE (end_date = '9999-12-31') <> (is_active = 1))
                   AS open_mismatches,
               count(*) FILTER (WHERE begin_date >= end_date) AS empty_intervals
        FROM (SELECT a.place, a.{key}, a.begin_date, a.end_date, a.is_active, a.actives,
                     count(b.place) AS earlier,
                     count(*) FILTER (WHERE b.end_date > a.begin_date) AS reaching,
                     count(*) FILTER (WHERE b.end_date >= a.begin_date) AS touching
              FROM (SELECT *, row_number() OVER placed AS place,
                           sum(is_active) OVER (PARTITION BY {key}) AS actives
                    FROM {source} WINDOW placed AS (PARTITION BY {key}
                         ORDER BY begin_date, end_date, is_active)) a
              LEFT JOIN (SELECT {key}, end_date, row_number() OVER (PARTITION BY {key}
                         ORDER BY begin_date, end_date, is_active) AS place
                         FROM {source}) b
              ON a.{key} = b.{key} AND b.place < a.place
              GROUP BY ALL)"""


CTES["broken_history"] = """
    SELECT DISTINCT o_custkey AS user_id,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS begin_date,
           CAST(CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 7 = 0 THEN 400
                ELSE o_orderkey % 40 END AS INTEGER) AS VARCHAR) AS end_date,
           CAST(o_orderkey % 3 = 0 AS INTEGER) AS is_active
    FROM orders"""


def _refreshed(name: str) -> str:
    """Whether an untracked attribute of version m is not what d had."""
    spec = DIMS[name]
    return " OR ".join(f"coalesce(m.{c}, '') <> coalesce(d.{c}, '')" for c in spec.refreshed)


def _matrix() -> str:
    cells = ", ".join(
        f"max(CASE WHEN dim_name = '{d}' THEN CAST(1 - miss_rate AS DECIMAL(9,6)) END) "
        f"AS {d}"
        for d in DIMS
    )
    return f"SELECT fact_name, {cells} FROM misses GROUP BY fact_name"


def _one_to_ones() -> str:
    sources = {"coupon": "coupon_info", "shop": "shop_info"}
    sources |= {"sku": "sku_info", "user": "user_info"}
    dims = [
        _one_to_one(d.table, _landed(sources[d.name]), d.table, d.key)
        for d in DIMS.values()
    ]
    facts = [
        _one_to_one(
            f.table, _landed(_FACT_SOURCE[f.name]), f"fact_{f.name}", f.grain
        )
        for f in FACTS.values()
    ]
    return _stacked(dims + facts)


def _bodies() -> dict[str, str]:
    tables = (
        "region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations"
    ).split()
    sql = {
        "land_all_counts": _stacked(
            [
                f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_landed(t)}"
                for t in SOURCES
            ]
        )
    }
    sql |= {f"land_{t}": _land(t, schema) for t, schema in SOURCES.items()}
    sql |= {
        "map_orders": "SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders",
        "dense_surrogate_key": """
            SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS order_sk
            FROM orders""",
        "dense_key_by_ranges": f"""
            SELECT row_number() OVER (ORDER BY {_LINES}) AS line_sk, l_orderkey,
                   l_linenumber, l_partkey
            FROM lineitem""",
        "dense_key_appended": """
            SELECT p_partkey, 1000 + row_number() OVER (ORDER BY p_partkey) AS part_sk
            FROM part""",
        "scd1_dim_shop": "SELECT * FROM dim_shop",
        "scd1_dim_coupon": "SELECT * FROM dim_coupon",
        "scd2_dim_user_day1": "SELECT * FROM dim_user",
        "scd2_dim_user_day2": "SELECT * FROM merged_user_08_r",
        "scd2_dim_user_day3": "SELECT * FROM merged_user_09_r",
        "scd2_dim_sku_day1": "SELECT * FROM dim_sku",
        "scd2_dim_sku_day2": "SELECT * FROM merged_sku_08_r",
        "scd2_as_written": "SELECT * FROM merged_user_08_k",
        "scd2_closed_rows": "SELECT * FROM closed_user_08_k",
        "scd2_opened_rows": "SELECT * FROM opened_user_08_k",
        "scd2_carried_rows": "SELECT * FROM carried_user_08_k",
        "scd2_audit_times": f"""
            SELECT m.user_sk, m.user_id, m.is_active,
                   CASE WHEN d.user_sk IS NULL THEN '{D2} 03:00:00'
                        ELSE '{D1} 03:00:00' END AS etl_insert_time,
                   CASE WHEN d.user_sk IS NULL OR m.is_active = 0 OR {_refreshed('user')}
                        THEN '{D2} 03:00:00' ELSE '{D1} 03:00:00' END AS etl_update_time
            FROM merged_user_08_r m LEFT JOIN dim_user d ON m.user_sk = d.user_sk""",
        "dense_key_decimal": """
            SELECT k, row_number() OVER (ORDER BY k) AS sk FROM (SELECT DISTINCT
                CAST(CAST(l_orderkey AS HUGEINT) * 1000000000000000000
                     + l_partkey * 1000 + l_linenumber AS DECIMAL(38,0)) AS k
                FROM lineitem)""",
        "scd2_current_slice": "SELECT * FROM merged_user_08_r WHERE is_active = 1",
        "fact_orders_point_in_time": f"""
            SELECT o.order_id, o.user_id, o.event_day, coalesce(u.user_sk, -1) AS user_sk
            FROM (SELECT order_id, user_id,
                         CASE order_id % 3 WHEN 0 THEN '{D1}' WHEN 1 THEN '{D2}' ELSE '{D3}' END AS event_day
                  FROM order_info) o
            LEFT JOIN merged_user_09_r u
              ON o.user_id = u.user_id AND u.begin_date <= o.event_day AND o.event_day < u.end_date""",
        "scd2_valid_on_day1": f"""
            SELECT * FROM merged_user_09_r
            WHERE begin_date <= '{D1}' AND end_date > '{D1}'""",
    }
    sql |= {f"fact_{f}": f"SELECT * FROM fact_{f}" for f in FACTS}
    sql |= {
        "fact_order_detail_with_order": _fact("order_detail", ("order_id",)),
        "published_fact": "SELECT * FROM fact_place_order",
        "published_ods": " UNION ALL ".join(
            f"SELECT {', '.join(SOURCES['user_info'].names)}, '{d}' AS pt "
            f"FROM {_landed('user_info', k)}"
            for k, d in DAYS.items()
        ),
        "published_dim": """
            SELECT * FROM dim_user UNION ALL BY NAME SELECT * FROM merged_user_08_r
            UNION ALL BY NAME SELECT * FROM merged_user_09_r""",
        "published_summary": _summary("trd_user"),
        "fact_from_many_days": f"""
            SELECT f.* REPLACE ('{D2}' AS pt, coalesce(d.user_sk, -1) AS user_sk,
                   CAST(d.user_sk IS NOT NULL AS INTEGER) AS is_valid)
            FROM fact_payment f JOIN payment_info p ON f.pay_id = p.pay_id
            LEFT JOIN merged_user_08_r d ON p.user_id = d.user_id AND d.is_active = 1""",
        "fact_for_event_day": """
            SELECT * REPLACE (row_number() OVER (ORDER BY order_id) AS place_order_sk,
                   (SELECT min(order_time)[:10] FROM order_info) AS pt)
            FROM fact_place_order WHERE order_id IN
                 (SELECT order_id FROM order_info WHERE order_time[:10] =
                  (SELECT min(order_time)[:10] FROM order_info))""",
        "catalog_table": "SELECT * FROM dim_shop",
        "unknown_member": """
            SELECT order_id, user_sk, shop_sk, is_valid
            FROM fact_place_order WHERE is_valid = 0""",
        "derived_discount": f"""
            SELECT order_id, discount_amount,
                   CAST(total_amount - pay_amount AS {MONEY}) AS derived,
                   CAST(total_amount - pay_amount = discount_amount AS INTEGER)
                       AS agrees
            FROM fact_place_order""",
    }
    sql |= {f"dq_{f}": _quality(f) for f in FACTS}
    sql |= {f"dws_{s}": _summary(s) for s in SUMMARIES}
    sql |= {
        "stock_period_end": """
            SELECT shop_id, sku_id, CAST(stock_num AS BIGINT) AS stock_num_end
            FROM stock_info
            QUALIFY row_number() OVER (PARTITION BY shop_id, sku_id
                                       ORDER BY update_time DESC, id DESC) = 1""",
        "stock_daily_average": """
            SELECT shop_id, sku_id, CAST(avg(total) AS DECIMAL(18,2))
                   AS stock_num_daily_avg
            FROM (SELECT shop_id, sku_id, update_time, sum(stock_num) AS total
                  FROM stock_info GROUP BY ALL)
            GROUP BY shop_id, sku_id""",
        "profile_row_counts": _stacked(
            [
                f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                for t in tables
            ]
        ),
        "profile_null_rate": _columns_profile("row_count", "null_rate"),
        "profile_columns": _columns_profile("position", "data_type"),
        "profile_candidate_key": _stacked(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                f"count(*) AS row_count, count(*) - count({c}) AS null_count, "
                f"count(*) > 0 AND count(DISTINCT {c}) = count(*) AS is_key FROM {t}"
                for t, columns in _PROFILED.items()
                for c in columns.split()
            ]
        ),
        "profile_fk_inclusion": _stacked([_reference(*r) for r in _REFERENCES]),
        "profile_minimal_keys": _minimal_keys_sql(),
        "extract_changes": _changes_sql(),
        "stock_carried_week": _carried_week_sql(),
        "profile_references": _references_sql(),
        "check_grain_unique": _stacked(
            [_grain(f.name, f"fact_{f.name}", f.grain) for f in FACTS.values()]
            + [_grain("lineitem", "lineitem", "l_orderkey, l_linenumber")]
        ),
        "check_repeated_grain": """
            SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "check_join_miss": "SELECT * FROM misses",
        "check_conformed_attr": """
            SELECT 'sku_name' AS attribute,
                   count(*) FILTER (WHERE d.sku_sk IS NOT NULL AND
                       coalesce(f.sku_name, '') = coalesce(d.sku_name, ''))
                       AS agreeing_rows,
                   count(*) FILTER (WHERE d.sku_sk IS NOT NULL AND
                       coalesce(f.sku_name, '') <> coalesce(d.sku_name, ''))
                       AS disagreeing_rows,
                   count(*) FILTER (WHERE d.sku_sk IS NULL) AS unmatched_rows
            FROM fact_order_detail f LEFT JOIN dim_sku d ON f.sku_sk = d.sku_sk""",
        "check_one_to_one": _one_to_ones(),
        "check_scd2_intervals": _stacked(
            [
                _intervals("dim_user", "merged_user_09_r", "user_id"),
                _intervals("dim_sku", "merged_sku_08_r", "sku_id"),
            ]
        ),
        "check_broken_intervals": _intervals("broken", "broken_history", "user_id"),
        "coverage_matrix": _matrix(),
    }
    return sql


def _sql(body: str) -> str:
    """``body`` preceded by the expressions it names, in order of need."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed[word] = None

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {parts}\n{body}"


def all_oracles() -> dict[str, str]:
    return {name: _sql(body) for name, body in _bodies().items()}
