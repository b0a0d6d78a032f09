"""Merkle dataset manifest: a content-addressed tree of the rows, and a proof for each.

Each row becomes a leaf digest. Per group (by default ``source``) the leaves ascend by
key; every ``FAN`` consecutive nodes of a level become one node whose digest is that of
their digests written one after the other (the last run may hold fewer, even one),
until one node is left: the group's subroot. The subroots, in group order, form the
top tree whose last node is the root. All digests are lowercase hex SHA-256; a node
hashes the hex text of its children.

The tree is stored as digest-to-children records, one table a level. Proofs are found
by descent: starting at the root, each level's node is chosen by the next digit (base
``FAN``) of the rank, and the unselected children to its left and right are collected
as one path segment. A row's proof is its path segments reversed (leaf level first),
so the proof digest and the root folded up from a leaf are both plain Spark
expressions over that array.

Scale: ranks inside a group come from one sort and the row counts of its partitions
(one number a partition reaches the driver), and a group's first rank is joined back by
blocks of ``BLOCK`` ranks, so a group that holds a third of all rows is spread over
many tasks. Every later join is between a level and the one above it, at most ``FAN``
children to a key. Levels are written to the shared folder as they are made.

Defined cases: a null field is written ``-`` in the leaf; a null group sorts first and
is a group of its own; ties of key are ordered by leaf digest (equal rows give equal
leaves, so their order does not change any digest); a group of one row has that
leaf as its subroot, and a table of one group has that subroot as its root; an empty
table gives no rows; columns beyond the fields are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.scratch import saved

FAN = 16
BLOCK = 4096  # ranks whose rows meet one row of their group in a join
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOW = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in 33 bits
SEGMENTS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(df: DataFrame, fields: Sequence[str] = FIELDS, replaced: dict[str, Column] | None = None) -> Column:
    columns = {f: df[f] for f in fields} | (replaced or {})
    return digest(*[field(columns[f]) for f in fields])


def _group(value: Column) -> Column:
    """A non-null group key that sorts like the value, null first."""
    return F.coalesce(F.concat(F.lit("s"), value.cast("string")), F.lit("n"))


def ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``idx`` (rank from 0 inside its group, by ``order``) and ``size``."""
    spark = df.sparkSession
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    tagged = saved(df.orderBy(*keys).withColumn("_mid", F.monotonically_increasing_id()), "merkle-order")
    tagged = tagged.withColumns({"_pid": F.shiftright("_mid", 33), "_local": F.col("_mid").bitwiseAND(F.lit(_LOW))})
    counts = sorted(tuple(r) for r in tagged.groupBy("_pid").count().collect())  # one row a partition
    offsets, total = [], 0
    for pid, n in counts:
        offsets.append((pid, total))
        total += n
    table = spark.createDataFrame(offsets, "_pid long, _offset long")
    numbered = tagged.join(F.broadcast(table), "_pid").withColumn("_rank", F.col("_offset") + F.col("_local"))
    spans = numbered.groupBy(F.col(group).alias("_g")).agg(
        F.min("_rank").alias("_first"), F.max("_rank").alias("_last")
    )
    blocks = spans.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("_first") / BLOCK), F.floor(F.col("_last") / BLOCK)))
    )
    joined = numbered.withColumn("_lb", F.floor(F.col("_rank") / BLOCK)).join(
        blocks, numbered[group].eqNullSafe(blocks["_g"]) & (F.col("_lb") == blocks["_block"])
    )
    return joined.select(
        *[numbered[c] for c in df.columns],
        (F.col("_rank") - F.col("_first")).alias("idx"),
        (F.col("_last") - F.col("_first") + 1).alias("size"),
    )


def _depth(size: int) -> int:
    depth, width = 0, size
    while width > 1:
        width = -(-width // FAN)
        depth += 1
    return depth


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Level tables from level 0 (``g``, ``idx``, ``digest``, ``size`` and any others).

    Every level has ``children`` (null at level 0) and ``is_top``: the group's last node.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    width = lambda k: F.floor((F.col("size") + (FAN**k - 1)) / FAN**k)
    out = [saved(nodes.withColumns({"children": F.lit(None).cast("array<string>"), "is_top": width(0) == 1}), f"{name}-0")]
    for k in range(1, _depth(most) + 1):
        below = out[-1].where(~F.col("is_top"))
        runs = below.groupBy("g", F.floor(F.col("idx") / FAN).alias("idx")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("idx").alias("at"), F.col("digest")))).alias("_kids"),
            F.max("size").alias("size"),
        )
        kids = F.transform("_kids", lambda x: x["digest"])
        level = runs.select(
            "g", "idx", F.sha2(F.array_join(kids, ""), 256).alias("digest"), "size", kids.alias("children")
        ).withColumn("is_top", width(k) == 1)
        out.append(saved(level, f"{name}-{k}"))
    return out


def descend(tree: list[DataFrame], tops: DataFrame, carried: Sequence[str], name: str) -> DataFrame:
    """Level 0 with ``segments``: the unselected children from its group's top down.

    ``tops`` gives, per ``g``, the ``segments`` above the group's top node and the
    ``carried`` columns; a node below the top takes its parent's and adds one segment.
    """
    above = None
    for k in range(len(tree) - 1, -1, -1):
        level = tree[k]
        parts = [level.where("is_top").join(tops, "g")]
        if above is not None:
            parent = above.select(
                F.col("g").alias("_pg"),
                F.col("idx").alias("_pidx"),
                F.col("children").alias("_pkids"),
                F.col("segments").alias("_psegs"),
                *[F.col(c).alias(f"_p_{c}") for c in carried],
            )
            inner = level.where(~F.col("is_top")).join(
                parent, (F.col("g") == F.col("_pg")) & (F.floor(F.col("idx") / FAN) == F.col("_pidx"))
            )
            at = (F.col("idx") % FAN).cast("int")
            segment = F.struct(
                F.array_join(F.slice("_pkids", 1, at), "").alias("left"),
                F.array_join(F.slice("_pkids", at + 2, FAN), "").alias("right"),
            )
            inner = inner.select(
                *level.columns,
                F.concat("_psegs", F.array(segment)).alias("segments"),
                *[F.col(f"_p_{c}").alias(c) for c in carried],
            )
            parts.append(inner)
        current = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
        if k == 0:
            return current
        above = saved(current.select("g", "idx", "children", "segments", *carried), f"{name}-down-{k}")
    raise ValueError("a tree has at least level 0")


def manifest(
    df: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    tamper: Callable[[DataFrame], dict[str, Column]] | None = None,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``tamper`` gives replacement values of some fields (as Columns of ``df``); the
    folded root is recomputed from the leaf of the replaced values and the original
    siblings, and ``verified`` says whether it equals the root.
    """
    rows = df.select(
        F.col(key).alias("_key"),
        _group(F.col(group)).alias("_gkey"),
        leaf(df, fields).alias("_leaf"),
        leaf(df, fields, tamper(df) if tamper else None).alias("_tampered"),
    )
    leaves = ranked(rows, "_gkey", ["_key", "_leaf"]).select(
        F.col("_gkey").alias("g"), "idx", F.col("_leaf").alias("digest"), "size", "_key", "_tampered"
    )
    source_tree = levels(leaves, "merkle-source")
    subroots = _union_all([t.where("is_top").select("g", "digest") for t in source_tree])
    top_rows = ranked(subroots.select(F.lit(0).alias("_all"), F.col("g").alias("_src"), "digest"), "_all", ["_src"])
    top_tree = levels(top_rows.select(F.col("_all").alias("g"), "idx", "digest", "size", "_src"), "merkle-top")
    crown = top_tree[-1].where("is_top").select(
        "g", F.array().cast(SEGMENTS).alias("segments"), F.col("digest").alias("root")
    )
    per_source = descend(top_tree, crown, ["root"], "merkle-top").select(
        F.col("_src").alias("g"), "segments", "root", F.col("digest").alias("subroot")
    )
    down = descend(source_tree, per_source, ["root", "subroot"], "merkle-source")
    path = F.reverse("segments")
    return down.select(
        F.col("_key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        F.aggregate(path, F.col("_tampered"), lambda acc, s: digest(s["left"], acc, s["right"])).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
