"""Packing rows into chunks, and sorted hashes into byte strings.

Operators that look up every position of a corpus would shuffle a row for each. Here a
task packs the distinct hashes of a chunk of documents into one byte string for each
bucket of the hash space; buckets answer with the hashes that matter, and the chunk's
documents meet the answers again. What moves is a few bytes a position, and a hash
that a third of the documents share counts once for each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.scratch import saved

CHUNK_BYTES = 4 << 20
HASHES_IN_BUCKET = 1 << 21
MOST_BUCKETS = 1 << 16
CHUNK_SCHEMA = "chunk long, n_bytes long, rows binary"
_SQUEEZE, _UNSQUEEZE = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(data: bytes) -> bytes:
    return _SQUEEZE.compress(data)


def unsqueeze(data: bytes) -> bytes:
    return _UNSQUEEZE.decompress(data)


def numbered_tables(
    batches: Iterator[pa.RecordBatch], size: str, chunk_bytes: int
) -> Iterator[tuple[int, int, pa.Table]]:
    """A task's rows cut into tables of about ``chunk_bytes``: a chunk number no other task
    gives, the table's weight, and the table."""
    base, seq = TaskContext.get().partitionId() << 32, 0
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        sizes = np.maximum(batch.column(size).to_numpy(zero_copy_only=False), 1)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, before + chunk_bytes - weight, side="left")) + 1
            to = min(max(to, at + 1), batch.num_rows)
            held.append(batch.slice(at, to - at))
            weight += int(ends[to - 1] - before)
            at = to
            if weight >= chunk_bytes:
                yield base + seq, weight, pa.Table.from_batches(held)
                held, weight, seq = [], 0, seq + 1
    if held:
        yield base + seq, weight, pa.Table.from_batches(held)


def pack_rows(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def to_chunks(df: DataFrame, size: str, name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of ``df`` packed in their order as (chunk, n_bytes, rows).

    ``size`` names a long column with each row's weight. The packed rows are written
    once, so a chunk keeps its number whatever happens later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, weight, rows in numbered_tables(batches, size, chunk_bytes):
            yield pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([weight], pa.int64()), pa.array([pack_rows(rows)], pa.binary())],
                names=["chunk", "n_bytes", "rows"],
            )

    return saved(df.mapInArrow(run, CHUNK_SCHEMA), name, compression="none")


def unpack_rows(rows: bytes) -> pa.Table:
    with pa.ipc.open_stream(rows) as reader:
        return reader.read_all()


def buckets_for(n_hashes: int) -> int:
    """A power of two, so that the leading bits of a hash name its bucket."""
    wanted = max(1, -(-n_hashes // HASHES_IN_BUCKET))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit values as compressed byte planes of their steps."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return squeeze(planes.tobytes())


def unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(8, -1)
    steps = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_plain(values: np.ndarray) -> bytes:
    """64-bit integers in any order, compressed by byte planes."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return squeeze(planes.tobytes())


def unpack_plain(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def bucket_slices(values: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of ascending hashes, by their leading bits; empty ones left out."""
    bits = buckets.bit_length() - 1
    if not bits:
        if len(values):
            yield 0, slice(0, len(values))
        return
    borders = np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.r_[0, np.searchsorted(values, borders), len(values)]
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, slice(int(cuts[b]), int(cuts[b + 1]))


def in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in the ascending array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunk rows and answer rows (chunk, answer) under one schema, for a group by chunk."""
    empty = F.lit(None).cast("binary")
    return chunks.select("chunk", "rows", empty.alias("answer")).unionByName(
        answers.select("chunk", empty.alias("rows"), "answer")
    )
