"""SimHash near-duplicates found with vantage-point trees.

A tree over a bounded sample cuts Hamming space into shards. Each fingerprint is
stored in one shard and visits, as a query, every shard that the triangle bound does
not rule out; inside a shard the same rule prunes a local tree down to small blocks
that are compared exactly. The sample only shapes the tree: every fingerprint is
stored and queried, so no pair within the distance is lost. A shard hands on the
edges of local stars, not its pairs.

Defined cases: null and empty texts have fingerprint zero, linked like any other;
texts of fewer words than a shingle are one shingle; equal texts and repeated rows
share a fingerprint and so a component; rows with a null id get the least id of their
component, which is null if all are; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm.components import connected_components
from starflow.llm.scratch import saved
from starflow.llm.text import keyed_text, map_batches

BITS = 64
SAMPLE = 16_384
SHARD = 4_096
MOST_SHARDS = 4_096
BLOCK_PAIRS = 1 << 20
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, repeats included."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    width = min(shingle, len(found))
    count = len(found) - width + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, SHINGLES_AT_ONCE):
        own = found[at : min(at + SHINGLES_AT_ONCE, count) + width - 1]
        shingles = map(b" ".join, zip(*[own[k:] for k in range(width)], strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int = 3, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    return _with_fingerprint(keyed_text(documents, key, text), shingle, "doc_id long, fp long")


def _with_fingerprint(keyed: DataFrame, shingle: int, schema: str) -> DataFrame:
    """The rows with fp, the last column of ``schema``, in place of the text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
        signed = np.array(values, np.uint64).view(np.int64)
        names = [n for n in batch.schema.names if n != "text"]
        return pa.record_batch([*[batch.column(n) for n in names], pa.array(signed)], names=[*names, "fp"])

    return map_batches(keyed, run, schema)


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Tree:
    """A vantage-point tree of shards: inner nodes hold a point and a radius.

    Inside is distance <= radius. Node k has the children 2k + 1 and 2k + 2; a node
    without a point is a shard.
    """

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        size = (1 << (depth + 1)) - 1
        self.point = np.zeros(size, np.uint64)
        self.radius = np.full(size, -1, np.int64)
        self._grow(0, depth, sample)

    def _grow(self, node: int, depth: int, own: np.ndarray) -> None:
        if not depth or len(own) < 2:
            return
        far = distance(own, own[0])
        radius = int(np.median(far))
        inside = far <= radius
        if inside.all():
            radius -= 1
            inside = far <= radius
        if not inside.any():
            return
        self.point[node], self.radius[node] = own[0], radius
        self._grow(2 * node + 1, depth - 1, own[inside])
        self._grow(2 * node + 2, depth - 1, own[~inside])

    def route(self, points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point number, shard, stored there?) of every visit.

        A stored point crosses only from outside to inside: of two linked points that
        part at a node, the outer one visits the inner one's side.
        """
        number = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        own = np.ones(len(points), bool)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(number):
            leaf = self.radius[node] < 0
            done.append((number[leaf], node[leaf], own[leaf]))
            number, node, own = number[~leaf], node[~leaf], own[~leaf]
            far, radius = distance(points[number], self.point[node]), self.radius[node]
            inside = far <= radius
            go_in = np.where(own, inside, far - most <= radius)
            cross = own & ~inside & (far - most <= radius)
            go_out = np.where(own, ~inside, far + most > radius)
            picks = [(go_in, 1, own), (cross, 1, np.zeros(len(own), bool)), (go_out, 2, own)]
            number, node, own = (
                np.concatenate([number[p] for p, _, _ in picks]),
                np.concatenate([2 * node[p] + side for p, side, _ in picks]),
                np.concatenate([o[p] for p, _, o in picks]),
            )
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _stars(u: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """The least node of each node's component, for edges between 0 .. size - 1."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], least)
        np.minimum.at(root, root[v], least)
        while (root[root] != root).any():
            root = root[root]
        if (root[u] == root[v]).all():
            return root


def _local_links(stored: np.ndarray, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (stored, query) within ``most`` bits, a block at a time."""
    waiting = [(np.arange(len(stored)), np.arange(len(queries)))]
    while waiting:
        s, q = waiting.pop()
        if not len(s) or not len(q):
            continue
        if len(s) * len(q) > BLOCK_PAIRS and len(s) > 1:
            point = stored[s[0]]
            far_s, far_q = distance(stored[s], point), distance(queries[q], point)
            radius = int(np.median(far_s))
            inside = far_s <= radius
            if inside.all():
                radius -= 1
                inside = far_s <= radius
            if inside.any() and not inside.all():
                waiting.append((s[inside], q[far_q - most <= radius]))
                waiting.append((s[~inside], q[far_q + most > radius]))
                continue
        step = max(1, BLOCK_PAIRS // len(s))
        for at in range(0, len(q), step):
            part = q[at : at + step]
            near = np.bitwise_count(stored[s][:, None] ^ queries[part][None, :]) <= most
            i, j = np.nonzero(near)
            if len(i):
                yield s[i], part[j]


def _shard_edges(stored: np.ndarray, visitors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the links between stored points and all points of a shard."""
    points = np.concatenate([stored, visitors])
    root = np.arange(len(points))
    for i, j in _local_links(stored, points, most):
        joined = _stars(root[i], root[j], len(points))
        root = joined[root]
    moved = np.flatnonzero(root != np.arange(len(points)))
    return points[moved], points[root[moved]]


def link_fingerprints(distinct: DataFrame, most: int) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs within ``most`` bits.

    ``distinct`` has one row for each fingerprint, in the long column ``fp``.
    """
    count = distinct.count()
    wanted = min(MOST_SHARDS, max(1, count // SHARD))
    depth = (wanted - 1).bit_length()
    # At most SAMPLE longs: they only place the borders between shards.
    sample = [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    tree = Tree(np.array(sample, np.int64).view(np.uint64), depth)

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        number, shard, own = tree.route(points, most)
        columns = [pa.array(points[number].view(np.int64)), pa.array(shard), pa.array(own)]
        return pa.record_batch(columns, names=["fp", "shard", "own"])

    def join(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        own = group.column("own").to_numpy(zero_copy_only=False).astype(bool)
        u, v = _shard_edges(points[own], points[~own], most)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    routed = map_batches(distinct.select("fp"), route, "fp long, shard long, own boolean")
    return routed.groupBy("shard").applyInArrow(join, "u long, v long")


def _labels(marked: DataFrame, most: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint; root, a fingerprint, names its
    component, while components whose least ids are equal share component_id."""
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = link_fingerprints(classes, most)
    roots = connected_components(edges)
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    groups = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(groups, "root").select("fp", "root", "component_id")


def near_duplicates(
    documents: DataFrame, *, shingle: int = 3, most: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    marked = saved(fingerprints(documents, shingle, key=key, text=text), "fingerprints")
    return marked.join(_labels(marked, most), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_of_each(
    documents: DataFrame, *, shingle: int = 3, most: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component: the one with the least id, of equal ids the one with
    the least text. Rows without an id cannot be named and stay as they are."""
    # Rows may share an id, so a row is found again by its id and a digest of its text.
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    keyed = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), digest.alias("digest"))
    marked = saved(_with_fingerprint(keyed, shingle, "doc_id long, digest string, fp long"), "fingerprints")
    rows = marked.where(F.col("doc_id").isNotNull()).join(_labels(marked, most), "fp")
    rows = rows.select("root", "doc_id", "digest")
    first = rows.groupBy("root").agg(F.min("doc_id").alias("doc_id"))
    named = rows.join(first, ["root", "doc_id"]).distinct()
    root, own, name, rank = (f"{x}-{uuid.uuid4().hex}" for x in ("root", "own", "name", "rank"))
    named = named.select(F.col("root").alias(root), F.col("doc_id").alias(name), F.col("digest").alias(own))
    met = (F.col(f"`{name}`") == F.col(key)) & (F.col(f"`{own}`") == digest)
    with_id = documents.join(named, met).select(*documents.columns, F.col(f"`{root}`"))
    tie = [F.col(key), F.col(text).asc_nulls_first(), *[F.col(f"`{c}`").cast("string") for c in documents.columns]]
    numbered = with_id.withColumn(rank, F.row_number().over(Window.partitionBy(f"`{root}`").orderBy(*tie)))
    kept = numbered.where(F.col(f"`{rank}`") == 1).drop(root, rank)
    return kept.unionByName(documents.where(F.col(key).isNull()))
