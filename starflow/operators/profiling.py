"""Profiles of source tables: sizes, columns, null rates, keys and references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from starflow.operators.checks import RATE, rate, union_all

# The margin is ten standard errors of the sketch, so a unique column is not ruled
# out; columns that merely come close are settled by the exact count.
_SKETCH_ERROR = 0.05
_SKETCH_MARGIN = 0.5
_WITNESS_VALUES = 1 << 16  # rows that are searched first for a repeat in a column set
_WITNESS_ROUNDS = (1, 16)  # times that many; the later only for the sets that are left
_LEAST_SHARE = 4  # below, a part of the rows saves too little
_PART_VALUES = 8  # values of a column that a part of it has at least, by the sketch
_SETS_PER_SCAN = 32


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def column_profile(df: DataFrame, name: str) -> DataFrame:
    """One row per column: position, type, rows, nulls and null rate, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(c)).alias(c) for c in df.columns],
    )
    described = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"),
            (F.col("__rows") - F.col(f.name)).alias("null_count"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    rows = counts.select(F.inline(F.array(*described)))
    return rows.withColumn("null_rate", rate("null_count", "row_count"))


def null_rates(df: DataFrame, name: str) -> DataFrame:
    return column_profile(df, name).select(
        "table_name", "column_name", "row_count", "null_count", "null_rate"
    )


def candidate_keys(df: DataFrame, name: str, *, exact: bool = False) -> DataFrame:
    """Which single columns are unique and never NULL.

    One pass with a distinct-count sketch per column rules out the clear misses (fewer
    distinct values than half the rows by a sketch of 5 % error); only the columns left
    are counted exactly, each by its own narrow shuffle. ``exact`` counts them all.
    """
    columns = df.columns
    sketch = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[
            F.approx_count_distinct(c, _SKETCH_ERROR).alias(f"d_{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    rows = sketch["rows"]

    def described(c: str, nulls: int):
        return [
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(rows).cast("long").alias("row_count"),
            F.lit(nulls).cast("long").alias("null_count"),
        ]

    ruled_out, counted = [], []
    for i, c in enumerate(columns):
        nulls = rows - sketch[f"n_{i}"]
        may_be_key = (
            rows > 0
            and nulls == 0
            and (exact or sketch[f"d_{i}"] >= rows * (1 - _SKETCH_MARGIN))
        )
        if may_be_key:
            per_value = df.groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
            counted.append(
                per_value.agg((F.max("__n") == 1).alias("is_key")).select(
                    *described(c, nulls), "is_key"
                )
            )
        else:
            ruled_out.append(
                F.struct(*described(c, nulls), F.lit(False).alias("is_key"))
            )

    if ruled_out:
        one_row = df.sparkSession.range(1)
        counted.append(one_row.select(F.inline(F.array(*ruled_out))))
    return union_all(counted)


def reference_matches(
    children: Mapping[str, DataFrame],
    parents: Mapping[str, tuple[DataFrame, str]],
    references: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """:func:`reference_match` of many references (child, foreign key, parent).

    Every table is read once: a child's foreign keys are counted together, and a
    parent's keys are made distinct once for all that refer to it.
    """
    counted, known = [], []
    # Numbers stand for the names while rows move.
    names = list(dict.fromkeys(f"{c}.{fk}" for c, fk, _ in references))
    place = {name: i for i, name in enumerate(dict.fromkeys(p for _, _, p in references))}
    for child in dict.fromkeys(c for c, _, _ in references):
        own = [(fk, p) for c, fk, p in references if c == child]
        each = [
            F.struct(
                F.lit(names.index(f"{child}.{fk}")).alias("reference"),
                F.lit(place[p]).alias("parent"),
                _comparable(children[child], fk).alias("k"),
            )
            for fk, p in own
        ]
        rows = children[child].select(F.inline(F.array(*each)))
        counted.append(rows.groupBy("reference", "parent", "k").agg(F.count(F.lit(1)).alias("__n")))
    for name, i in place.items():
        table, key = parents[name]
        keys = table.select(F.lit(i).alias("parent"), _comparable(table, key).alias("k"))
        known.append(keys.where("k IS NOT NULL").distinct())
    known_keys = union_all(known).withColumn("__found", F.lit(True))
    joined = union_all(counted).join(known_keys, ["parent", "k"], "left")
    given, found = F.col("k").isNotNull(), F.col("__found").isNotNull()
    totals = joined.groupBy("reference").agg(
        F.sum("__n").alias("child_rows"),
        F.coalesce(F.sum(F.when(~given, F.col("__n"))), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum(F.when(found, F.col("__n"))), F.lit(0)).alias("matched_rows"),
        F.count(F.when(given, 1)).alias("distinct_keys"),
        F.count(F.when(given & ~found, 1)).alias("unmatched_keys"),
    )
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("reference") + 1)
    return totals.withColumn("reference", named).withColumn("match_rate", _match_rate())


def _comparable(df: DataFrame, column: str) -> Column:
    """A key as text after a cast to its class's common type, so 7 and 7.0000000000 meet."""
    kind = df.schema[column].dataType
    known = type_class(kind)
    if isinstance(kind, IntegralType):  # as the cast writes it, without a decimal made
        return F.concat(F.col(column).cast("string"), F.lit(".0000000000"))
    value = F.col(column).cast(known[1]) if known else F.col(column)
    return value.cast("string")


def _match_rate() -> Column:
    asked = F.col("child_rows") - F.col("null_rows")
    share = F.col("matched_rows").cast("double") / asked.cast("double")
    return F.when(asked > 0, share).cast(RATE)


def reference_match(
    child: DataFrame, fk: str, parent: DataFrame, key: str, name: str
) -> DataFrame:
    """How far ``child.fk`` is contained in ``parent.key``; NULL keys are not misses."""
    per_key = child.groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    known = parent.select(F.col(key).alias("__key")).distinct()
    joined = per_key.join(known, per_key[fk] == known["__key"], "left")
    given = per_key[fk].isNotNull()
    found = F.col("__key").isNotNull()
    totals = joined.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(~given, F.col("__n"))), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum(F.when(found, F.col("__n"))), F.lit(0)).alias("matched_rows"),
        F.count(F.when(given, 1)).alias("distinct_keys"),
        F.count(F.when(given & ~found, 1)).alias("unmatched_keys"),
    )
    return totals.withColumn("match_rate", _match_rate()).select(
        F.lit(name).alias("reference"), "*"
    )


def _product(values) -> float:
    out = 1.0
    for v in values:
        out *= v
    return out


def minimal_keys(df: DataFrame, name: str, *, most: int = 3) -> DataFrame:
    """All minimal keys of up to ``most`` columns: sets unique over all rows, never NULL.

    The search goes level by level over column sets. A set is skipped when it holds a
    key already found (it would not be minimal) or a column with NULLs; it is ruled out
    when the sketched distinct counts of its columns (``_SKETCH_ERROR``, margin
    ``_SKETCH_MARGIN``) multiply to clearly fewer than the rows. The rest is settled
    exactly by :func:`_unique_sets`. One row per minimal key, its columns in table
    order; a table without one gives one row with ``key_columns`` NULL and 0 columns.
    """
    from itertools import combinations

    columns = df.columns
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c, _SKETCH_ERROR).alias(f"d_{i}") for i, c in enumerate(columns)],
    ).first()
    rows = first["rows"]
    usable = [c for i, c in enumerate(columns) if rows > 0 and first[f"n_{i}"] == rows]
    estimate = {c: first[f"d_{columns.index(c)}"] for c in usable}
    enough = rows * (1 - _SKETCH_MARGIN)
    found: list[tuple[str, ...]] = []
    for size in range(1, most + 1):
        sets = [
            s
            for s in combinations(usable, size)
            if not any(set(k) <= set(s) for k in found) and _product(estimate[c] for c in s) >= enough
        ]
        found += _unique_sets(df, sets, rows, estimate)
    described = [
        (name, ", ".join(k), len(k), rows) for k in sorted(found, key=lambda k: [columns.index(c) for c in k])
    ] or [(name, None, 0, rows)]
    return df.sparkSession.createDataFrame(
        described, "table_name string, key_columns string, n_columns int, row_count long"
    )


def _unique_sets(
    df: DataFrame, sets: list[tuple[str, ...]], rows: int, estimate: Mapping[str, int]
) -> list[tuple[str, ...]]:
    """The column sets that no two rows share values of; exact.

    Sets are first refuted by witnesses (:func:`_refuted`) among few rows, then those
    left among more. Sets without a witness are counted over all rows by their
    64-bit hash; a hash held once by each row proves a key, and one held by several rows
    is settled by the values themselves.
    """
    for times in _WITNESS_ROUNDS:
        share = rows // (_WITNESS_VALUES * times)
        if share >= _LEAST_SHARE and sets:
            refuted = _refuted(df, sets, share, estimate)
            sets = [s for s in sets if s not in refuted]
    if not sets:
        return []
    shared = (
        _set_rows(df, sets)
        .groupBy("i", "h")
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .groupBy("i")
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    )
    doubtful = {r["i"]: (r["lo"], r["hi"]) for r in shared.collect()}
    return [
        s
        for i, s in enumerate(sets)
        if i not in doubtful
        or not (
            _held_twice(df.where(F.xxhash64(*s).isin(*doubtful[i])), s) or _held_twice(df, s)
        )
    ]


def _refuted(
    df: DataFrame, sets: list[tuple[str, ...]], share: int, estimate: Mapping[str, int]
) -> set[tuple[str, ...]]:
    """Sets with values that two rows hold, found in one part of ``share`` of the rows.

    The part is cut by the hash of one column of the set, that of most values, so rows
    that agree in the set are in the part together or not at all, and the part of a
    column serves all its sets: each row is hashed once a column, not once a set. A
    part that a frequent value fills is thinned by the hash of the set itself.
    """
    by_column: dict[str, list[tuple[str, ...]]] = {}
    for s in sets:
        by_column.setdefault(max(s, key=lambda c: estimate[c]), []).append(s)
    inside = {
        c: F.pmod(F.xxhash64(c), F.lit(max(1, min(share, estimate[c] // _PART_VALUES)))) == 0 for c in by_column
    }
    held = df.agg(*[F.count(F.when(part, 1)).alias(f"n_{i}") for i, part in enumerate(inside.values())]).first()
    counted, numbered = [], []
    for i, (c, own) in enumerate(by_column.items()):
        thin = max(1, held[f"n_{i}"] // (_LEAST_SHARE * _WITNESS_VALUES * _WITNESS_ROUNDS[-1]))
        part = df.where(inside[c]).select(*dict.fromkeys(x for s in own for x in s))
        counted.append(_witness_rows(part, own, thin, len(numbered)))
        numbered += own
    twice = union_all(counted).groupBy("i", "h", "v").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return {numbered[r[0]] for r in twice.select("i").distinct().collect()}


def _held_twice(df: DataFrame, columns: tuple[str, ...]) -> bool:
    per_value = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return not per_value.where(F.col("__n") > 1).isEmpty()


def _set_rows(df: DataFrame, sets: list[tuple[str, ...]], share: int = 1) -> DataFrame:
    """Per row and column set ``i`` the hash ``h`` of its values; a set reads its columns only.

    With a ``share`` only the values in one part of that many of the hash space.
    """
    rows = union_all([df.select(F.lit(i).alias("i"), F.xxhash64(*s).alias("h")) for i, s in enumerate(sets)])
    return rows.where(F.pmod("h", F.lit(share)) == 0) if share > 1 else rows


def _witness_rows(part: DataFrame, sets: list[tuple[str, ...]], share: int, first: int) -> DataFrame:
    """As :func:`_set_rows`, in one scan, with the values as ``v``; sets are numbered from ``first``."""
    parts = []
    for at in range(0, len(sets), _SETS_PER_SCAN):
        each = []
        for i, s in enumerate(sets[at : at + _SETS_PER_SCAN], start=first + at):
            v = F.array(*[F.col(c).cast("string") for c in s])
            each.append(F.struct(F.lit(i).alias("i"), F.xxhash64(*s).alias("h"), v.alias("v")))
        rows = part.select(F.inline(F.array(*each)))
        parts.append(rows.where(F.pmod("h", F.lit(share)) == 0) if share > 1 else rows)
    return union_all(parts)


# Type classes whose values can be compared across tables, and the type they meet in.
_CLASSES = {
    "byte": ("exact", "decimal(38,10)"),
    "short": ("exact", "decimal(38,10)"),
    "int": ("exact", "decimal(38,10)"),
    "bigint": ("exact", "decimal(38,10)"),
    "string": ("string", "string"),
    "date": ("date", "date"),
    "timestamp": ("timestamp", "timestamp"),
}
BUCKETS = 1 << 20  # size of each parent's one-hash bitmap: a proven bound


def type_class(kind) -> tuple[str, str] | None:
    name = kind.simpleString()
    if name.startswith("decimal"):
        return ("exact", "decimal(38,10)")
    return _CLASSES.get(name)


def find_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column whose non-NULL values all lie in a single-column key of a table.

    Parents are the single-column keys (unique, never NULL) that :func:`minimal_keys`
    finds. A child is any other column of the same type class with a value. Pairs are
    ruled out, in this order, by the value range (child min and max inside the
    parent's), then by a one-hash Bloom filter: each parent's set of ``BUCKETS`` hash
    buckets, each child's likewise, and a child bucket that the parent lacks proves a
    missing value. Survivors are tested exactly: a child column's values are made
    distinct once, whatever the number of its parents, and joined with the list of
    parents that hold each value. Every table is read once in a step. Values meet in a
    common type per class, so an integer child and a decimal parent compare by value;
    the class of exact numbers meets as bigint when none of them is a decimal.
    """
    parents, columns = [], []
    for name, df in tables.items():
        keys = minimal_keys(df, name, most=1).where("n_columns = 1").collect()
        for k in keys:
            if type_class(df.schema[k["key_columns"]].dataType) is not None:
                parents.append((name, k["key_columns"]))
        for f in df.schema.fields:
            if type_class(f.dataType) is not None:
                columns.append((name, f.name))
    kinds = {(t, c): tables[t].schema[c].dataType for t, c in columns}
    decimals = any(isinstance(k, DecimalType) for k in kinds.values())

    def common(t: str, c: str) -> Column:
        kind, to = type_class(kinds[(t, c)])
        return F.col(c).cast("bigint" if kind == "exact" and not decimals else to)

    summaries = []
    for name, df in tables.items():
        own = [c for t, c in columns if t == name]
        if not own:
            continue
        classes = {c: type_class(kinds[(name, c)]) for c in own}
        summaries.append(
            df.agg(
                *[F.count(c).alias(f"n_{i}") for i, c in enumerate(own)],
                *[F.min(c).cast(classes[c][1]).cast("string").alias(f"lo_{i}") for i, c in enumerate(own)],
                *[F.max(c).cast(classes[c][1]).cast("string").alias(f"hi_{i}") for i, c in enumerate(own)],
            )
            .select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(name).alias("t"),
                                F.lit(c).alias("c"),
                                F.lit(classes[c][0]).alias("kind"),
                                F.col(f"n_{i}").alias("n"),
                                F.col(f"lo_{i}").alias("lo"),
                                F.col(f"hi_{i}").alias("hi"),
                            )
                            for i, c in enumerate(own)
                        ]
                    )
                )
            )
        )
    if not summaries or not parents:
        return _no_references(tables)
    facts = {(r["t"], r["c"]): r for r in union_all(summaries).collect()}  # one row a column
    pairs = []
    for pt, pc in parents:
        parent = facts[(pt, pc)]
        for ct, cc in columns:
            child = facts[(ct, cc)]
            if (ct, cc) == (pt, pc) or child["kind"] != parent["kind"] or child["n"] == 0:
                continue
            if _before(child["lo"], parent["lo"], child["kind"]) or _before(parent["hi"], child["hi"], child["kind"]):
                continue
            pairs.append((ct, cc, pt, pc))
    if not pairs:
        return _no_references(tables)
    spark = next(iter(tables.values())).sparkSession
    used = sorted({(t, c) for ct, cc, pt, pc in pairs for t, c in ((ct, cc), (pt, pc))})
    hashed = {k: F.pmod(F.xxhash64(common(*k)), F.lit(BUCKETS)) for k in used}
    each = [F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c in used]
    named = F.element_at(F.array(*each), F.col("i") + 1)
    buckets = _values(tables, used, hashed).select(named["t"].alias("t"), named["c"].alias("c"), F.col("v").alias("b"))
    candidates = spark.createDataFrame(pairs, "child_table string, child_column string, parent_table string, parent_column string")
    child_b = buckets.select(F.col("t").alias("child_table"), F.col("c").alias("child_column"), "b")
    parent_b = buckets.select(F.col("t").alias("parent_table"), F.col("c").alias("parent_column"), "b", F.lit(True).alias("_in"))
    misses = (
        candidates.join(child_b, ["child_table", "child_column"])
        .join(parent_b, ["parent_table", "parent_column", "b"], "left")
        .groupBy("child_table", "child_column", "parent_table", "parent_column")
        .agg(F.count(F.when(F.col("_in").isNull(), 1)).alias("missing"))
    )
    survivors = [tuple(r)[:4] for r in misses.where("missing = 0").collect()]
    found = []
    for kind in sorted({facts[s[:2]]["kind"] for s in survivors}):
        own = [s for s in survivors if facts[s[:2]]["kind"] == kind]
        children = sorted({s[:2] for s in own})
        held = sorted({s[2:] for s in own})
        values = _values(tables, children, {k: common(*k) for k in children})
        known = _values(tables, held, {k: common(*k) for k in held}).groupBy("v").agg(F.collect_list("i").alias("in"))
        has = [F.count(F.when(F.array_contains("in", j), 1)).alias(f"p_{j}") for j in range(len(held))]
        counted = values.join(known, "v", "left").groupBy("i").agg(F.count(F.lit(1)).alias("n"), *has)
        totals = {r["i"]: r for r in counted.collect()}  # one row a column
        for s in own:
            r = totals[children.index(s[:2])]
            if r[f"p_{held.index(s[2:])}"] == r["n"]:
                found.append((*s, r["n"]))
    return spark.createDataFrame(
        sorted(found),
        "child_table string, child_column string, parent_table string, parent_column string, distinct_keys long",
    )


def _no_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        [], "child_table string, child_column string, parent_table string, parent_column string, distinct_keys long"
    )


def _values(
    tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]], values: Mapping[tuple[str, str], Column]
) -> DataFrame:
    """The distinct ``v`` of each column ``i`` over its non-NULL values, one scan a table."""
    parts = []
    for name in dict.fromkeys(t for t, _ in columns):
        each = [
            F.struct(F.lit(i).alias("i"), F.when(F.col(c).isNotNull(), values[(t, c)]).alias("v"))
            for i, (t, c) in enumerate(columns)
            if t == name
        ]
        parts.append(tables[name].select(F.inline(F.array(*each))).where("v IS NOT NULL"))
    return union_all(parts).distinct()


def _before(a: str, b: str, kind: str) -> bool:
    """Whether value ``a`` sorts before ``b`` (both as written by a cast to string)."""
    if kind == "exact":
        from decimal import Decimal

        return Decimal(a) < Decimal(b)
    return a < b
