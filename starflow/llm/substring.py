"""Substring duplicates of words by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of half a window's words.
A window that repeats elsewhere covers a whole reference block there, so one of its
own rolling half-windows equals that block. Three passes over packed chunks:

1. every chunk sends its reference blocks and all its rolling half-windows, as packed
   hashes, to the buckets of the hash space, which answer with those that a reference
   block and another place share;
2. around these anchors a chunk extends to whole windows and sends their hashes with
   their least document; buckets answer with those found under a smaller id elsewhere;
3. the covered words of each document, overlaps joined, are its maximal exact repeats.

Only hashes move, each once for a chunk, so a passage of any number of documents makes
no pairs. Hashes are 64 bits of a non-linear mix: among n candidate windows two
different ones collide with probability below n * n / 2**65.

Defined cases: null and empty texts have no words; a document shorter than a window
keeps all; repeats inside one document, and rows with equal ids, do not count against
each other; a null id counts as larger than every id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starflow.llm import chunks as ch
from starflow.llm.scratch import saved
from starflow.llm.text import keyed_text, tidy

WINDOW = 50
ANCHOR_BITS = 44
PIECE_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _weights(size: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    return np.multiply.accumulate(np.full(size, np.uint64(0x9E3779B97F4A7C15)))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9FB21C651E98DF25) + right)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a byte array."""
    solid = ~SPACE[data]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    weights = _weights(1 << int(sizes.max()).bit_length())
    summed = np.add.reduceat(_byte_values()[data[solid]] * weights[place], first)
    return mix(summed + sizes.astype(np.uint64)), starts


def windows(units: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` units, built from runs of powers of two."""
    if len(units) < width:
        return np.zeros(0, np.uint64)
    out, done, run, size = None, 0, units, 1
    while True:
        if width & size:
            if out is None:
                out = run
            else:
                n = len(units) - done - size + 1
                out = join_hashes(out[:n], run[done : done + n])
            done += size
        if done == width:
            return out
        run = join_hashes(run[:-size], run[size:]) if len(run) > size else run[:0]
        size *= 2


def hash_documents(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents in their order, and each one's word count."""
    hashes: list[np.ndarray] = []
    sizes = np.zeros(len(bodies), np.int64)
    at = 0
    while at < len(bodies):
        to, size = at, 0
        while to < len(bodies) and (to == at or size + len(bodies[to]) <= PIECE_BYTES):
            size += len(bodies[to]) + 1
            to += 1
        data = np.frombuffer(b"\n".join(bodies[at:to]), np.uint8)
        found, starts = word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in bodies[at:to]])
        sizes[at:to] = np.diff(np.searchsorted(starts, ends), prepend=0)
        hashes.append(found)
        at = to
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), sizes


class Chunk:
    """The words of a chunk's documents, one after the other, as hashes."""

    def __init__(self, table: pa.Table, key: str, text: str) -> None:
        ids = table.column(key).to_pylist()
        self.texts = [t.encode() if t else b"" for t in table.column(text).to_pylist()]
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.words, self.sizes = hash_documents(self.texts)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of the runs that stay inside a document."""
        hashes = windows(self.words, width)
        inside = np.flatnonzero(self.doc[: len(hashes)] == self.doc[width - 1 :]) if len(hashes) else np.zeros(0, int)
        return hashes[inside], inside


def _anchor_hashes(chunk: Chunk, half: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, at = chunk.runs(half)
    # Fewer bits make shorter messages; a chance hit only makes one more candidate.
    return hashes & ~np.uint64((1 << (64 - ANCHOR_BITS)) - 1), at


def _messages(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _send_anchors(packed: DataFrame, key: str, text: str, half: int, buckets: int) -> DataFrame:
    """(bucket, chunk, blocks, probes): the chunk's reference blocks and other windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(ch.unpack_rows(row["rows"]), key, text)
                hashes, at = _anchor_hashes(chunk, half)
                block = (at - chunk.first[chunk.doc[at]]) % half == 0
                own = np.sort(hashes[block])
                twice = own[1:][own[1:] == own[:-1]]
                blocks = np.unique(own)
                probes = np.unique(np.concatenate([hashes[~block], twice]))
                sides = [dict(ch.bucket_slices(x, buckets)) for x in (blocks, probes)]
                for b in sorted(sides[0].keys() | sides[1].keys()):
                    parts = [
                        ch.pack_sorted(x[s[b]] if b in s else x[:0])
                        for x, s in zip((blocks, probes), sides, strict=True)
                    ]
                    yield _messages(
                        [(b, row["chunk"], *parts)],
                        ["bucket", "chunk", "blocks", "probes"],
                        [pa.int32(), pa.int64(), pa.binary(), pa.binary()],
                    )

    return packed.mapInArrow(run, "bucket int, chunk long, blocks binary, probes binary")


def _answer_anchors(group: pa.Table) -> pa.Table:
    numbers = group.column("chunk").to_pylist()
    blocks = [ch.unpack_sorted(x) for x in group.column("blocks").to_pylist()]
    probes = [ch.unpack_sorted(x) for x in group.column("probes").to_pylist()]
    index, count = np.unique(np.concatenate(blocks), return_counts=True)
    probed = np.zeros(len(index), bool)
    for p in probes:
        if len(index):
            at = np.minimum(np.searchsorted(index, p), len(index) - 1)
            probed[at[index[at] == p]] = True
    shared = index[(count > 1) | probed]
    rows = []
    for number, own, p in zip(numbers, blocks, probes, strict=True):
        both = np.union1d(own[ch.in_sorted(own, shared)], p[ch.in_sorted(p, shared)])
        if len(both):
            rows.append((number, ch.pack_sorted(both)))
    tidy()
    return pa.Table.from_batches([_messages(rows, ["chunk", "answer"], [pa.int64(), pa.binary()])])


def _read_group(group: pa.Table, key: str, text: str) -> tuple[int, pa.Table, np.ndarray] | None:
    """A chunk's number, rows and all answers to it, ascending."""
    rows = [x for x in group.column("rows").to_pylist() if x is not None]
    if not rows:
        return None
    answers = [ch.unpack_sorted(x) for x in group.column("answer").to_pylist() if x is not None]
    known = np.sort(np.concatenate(answers)) if answers else np.zeros(0, np.uint64)
    return group.column("chunk")[0].as_py(), ch.unpack_rows(rows[0]), known


def _candidates(chunk: Chunk, shared: np.ndarray, half: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the windows that hold a shared anchor."""
    hashes, at = _anchor_hashes(chunk, half)
    hit = np.zeros(len(chunk.words) + 1, np.int64)
    hit[at[ch.in_sorted(hashes, shared)] + 1] = 1
    hit = np.cumsum(hit)
    whole, start = chunk.runs(window)
    # Anchors that begin at start .. start + window - half lie inside the window.
    some = hit[start + window - half + 1] > hit[start]
    return whole[some], start[some]


def _send_windows(
    chunked: DataFrame, key: str, text: str, half: int, window: int, buckets: int
) -> DataFrame:
    """(bucket, chunk, hashes, least): candidate windows and their least document."""

    def run(group: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if (found := _read_group(group, key, text)) is not None:
            number, table, shared = found
            chunk = Chunk(table, key, text)
            hashes, at = _candidates(chunk, shared, half, window)
            order = np.argsort(hashes, kind="stable")
            hashes, ids = hashes[order], chunk.ids[chunk.doc[at[order]]]
            if len(hashes):
                first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
                least, hashes = np.minimum.reduceat(ids, first), hashes[first]
                for b, s in ch.bucket_slices(hashes, buckets):
                    rows.append((b, number, ch.pack_sorted(hashes[s]), ch.pack_plain(least[s])))
        names = ["bucket", "chunk", "hashes", "least"]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_batches([_messages(rows, names, types)])

    return chunked.groupBy("chunk").applyInArrow(run, "bucket int, chunk long, hashes binary, least binary")


def _answer_windows(group: pa.Table) -> pa.Table:
    """To each chunk the windows that a smaller id than all of its own has."""
    numbers = group.column("chunk").to_pylist()
    hashes = [ch.unpack_sorted(x) for x in group.column("hashes").to_pylist()]
    least = [ch.unpack_plain(x) for x in group.column("least").to_pylist()]
    every, ids = np.concatenate(hashes), np.concatenate(least)
    order = np.argsort(every, kind="stable")
    every, ids = every[order], ids[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    every, ids = every[first], np.minimum.reduceat(ids, first)
    rows = []
    for number, own, low in zip(numbers, hashes, least, strict=True):
        smaller = own[ids[np.searchsorted(every, own)] < low]
        if len(smaller):
            rows.append((number, ch.pack_sorted(smaller)))
    tidy()
    return pa.Table.from_batches([_messages(rows, ["chunk", "answer"], [pa.int64(), pa.binary()])])


def _covered(chunk: Chunk, smaller: np.ndarray, anchors: np.ndarray, half: int, window: int) -> np.ndarray:
    """Words covered by a window that a smaller id has, here or in another chunk."""
    hashes, at = _candidates(chunk, anchors, half, window)
    ids = chunk.ids[chunk.doc[at]]
    marked = ch.in_sorted(hashes, smaller)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        marked[order] |= ids[order] > least[np.cumsum(new) - 1]
    change = np.zeros(len(chunk.words) + 1, np.int64)
    starts = at[marked]
    change[starts] += 1
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:-1] > 0


def _rounds(documents: DataFrame, key: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """The packed chunks, and the answers of both rounds as (chunk, answer, round)."""
    if window < 2:
        raise ValueError("a window must have two words or more")
    half = (window + 1) // 2
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    name = f"size-{uuid.uuid4().hex}"
    packed = ch.to_chunks(documents.withColumn(name, size), name, "text-chunks")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = ch.buckets_for(total // 6)
    asked = _send_anchors(packed, key, text, half, buckets)
    anchors = asked.groupBy("bucket").applyInArrow(_answer_anchors, "chunk long, answer binary")
    anchors = saved(anchors, "anchors", compression="none")
    sent = _send_windows(ch.with_answers(packed, anchors), key, text, half, window, buckets)
    smaller = saved(
        sent.groupBy("bucket").applyInArrow(_answer_windows, "chunk long, answer binary"),
        "repeats",
        compression="none",
    )
    return packed, anchors.withColumn("round", F.lit(1)).union(smaller.withColumn("round", F.lit(2)))


Build = Callable[[pa.Table, Chunk, np.ndarray], pa.Table]


def _finish(
    documents: DataFrame, key: str, text: str, window: int, schema: str | StructType, build: Build
) -> DataFrame:
    """``build(table, chunk, covered)`` of every chunk, as one DataFrame."""
    packed, answers = _rounds(documents, key, text, window)
    half = (window + 1) // 2
    empty = F.lit(None).cast("binary")
    rows = packed.select("chunk", "rows", empty.alias("answer"), F.lit(0).alias("round")).unionByName(
        answers.select("chunk", empty.alias("rows"), "answer", "round")
    )

    def run(group: pa.Table) -> pa.Table:
        turn = np.array(group.column("round").to_pylist())
        body = group.column("rows").to_pylist()
        sent = group.column("answer").to_pylist()
        known = []
        for k in (1, 2):
            parts = [ch.unpack_sorted(sent[i]) for i in np.flatnonzero(turn == k)]
            known.append(np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64))
        table = ch.unpack_rows(body[int(np.flatnonzero(turn == 0)[0])])
        chunk = Chunk(table, key, text)
        tidy()
        return build(table, chunk, _covered(chunk, known[1], known[0], half, window))

    return rows.groupBy("chunk").applyInArrow(run, schema)


def repeated_words(
    documents: DataFrame, *, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""

    def build(table: pa.Table, chunk: Chunk, covered: np.ndarray) -> pa.Table:
        removed, digests = [], []
        for k, body in enumerate(chunk.texts):
            own = covered[chunk.first[k] : chunk.first[k] + chunk.sizes[k]]
            found = body.split()
            removed.append(int(own.sum()))
            if removed[-1]:
                found = [w for w, gone in zip(found, own.tolist(), strict=True) if not gone]
            digests.append(hashlib.sha256(b" ".join(found)).hexdigest())
        return pa.table(
            {
                "doc_id": table.column(key),
                "n_words": pa.array(chunk.sizes),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    narrow = keyed_text(documents, key, text)
    key, text = "doc_id", "text"
    return _finish(narrow, key, text, window, schema, build)


def remove_repeated_words(
    documents: DataFrame, *, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns; a text that repeats an earlier one keeps its other words.

    Kept words are joined by one blank; a text with nothing to remove stays unchanged.
    """
    columns = documents.columns

    def build(table: pa.Table, chunk: Chunk, covered: np.ndarray) -> pa.Table:
        bodies = table.column(text).to_pylist()
        for k in np.unique(chunk.doc[covered]).tolist():
            own = covered[chunk.first[k] : chunk.first[k] + chunk.sizes[k]].tolist()
            kept = [w for w, gone in zip(chunk.texts[k].split(), own, strict=True) if not gone]
            bodies[k] = b" ".join(kept).decode()
        changed = table.set_column(table.column_names.index(text), text, pa.array(bodies, pa.string()))
        return changed.select(columns)

    return _finish(documents, key, text, window, documents.schema, build)
