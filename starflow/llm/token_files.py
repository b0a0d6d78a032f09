"""Token ids as patched frame-of-reference files.

Documents are ordered by id, encoded, and cut into segments of whole documents. A
segment is one byte string in the format below; Spark writes the segments as rows of
a Parquet table beside their document index, so any store that Spark writes will do.

Segment, little-endian: magic ``PFR1``; u64 number of ids; u32 ids in a block; u32
number of blocks; u64 start of each block, counted from the first block, and one more
for the end. A block: u32 minimum; u8 width; u8 0; u16 number of exceptions; the ids
less the minimum, their low ``width`` bits packed lane by lane into u64 words; the
exceptions' places (u16 each) and then their high bits (u32 each). The width is the
one that the ``percentile`` of the block's values needs, so few values are exceptions.

Defined cases: null and empty texts hold the end id alone; documents with equal ids
are kept, ordered by their text; null ids come first; an empty table writes no
segment and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starflow.llm import tokens
from starflow.llm.scratch import scratch_root
from starflow.llm.text import keyed_text

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
HEADER = struct.Struct("<4sQII")

SEGMENTS = (
    "part int, seq int, part_start long, n_ids long, doc_ids array<bigint>, "
    "doc_tokens array<bigint>, payload binary"
)


def _widths(values: np.ndarray, percentile: int) -> np.ndarray:
    """Bits for the given percentile of each row."""
    rank = min(values.shape[1] - 1, values.shape[1] * percentile // 100)
    cut = np.partition(values, rank, axis=1)[:, rank]
    return np.frexp(cut.astype(np.float64))[1].astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values below 2**width as rows of u64 words."""
    words = np.zeros((len(values), (BLOCK * width + 63) // 64), np.uint64)
    for lane in range(BLOCK if width else 0):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= values[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, lane] >> np.uint64(64 - shift)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(words), BLOCK), np.uint64)
    if not width:
        return values
    mask = np.uint64((1 << width) - 1)
    for lane in range(BLOCK):
        word, shift = divmod(lane * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, lane] = value & mask
    return values


def encode_segment(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One segment. The last block is filled up with its own last id."""
    count = -(-len(ids) // BLOCK)
    filled = np.full(count * BLOCK, ids[-1] if len(ids) else 0, np.uint64)
    filled[: len(ids)] = ids
    rows = filled.reshape(count, BLOCK)
    least = rows.min(axis=1) if count else np.zeros(0, np.uint64)
    rows = rows - least[:, None]
    width = _widths(rows, percentile) if count else np.zeros(0, np.int64)
    high = rows >> width.astype(np.uint64)[:, None]
    rows = rows & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
    odd_block, odd_place = np.nonzero(high)
    odd_high = high[odd_block, odd_place].astype("<u4")
    odd_count = np.bincount(odd_block, minlength=count).astype(np.int64)
    odd_from = np.r_[0, np.cumsum(odd_count)]
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        body = _pack(rows[at], int(w)).astype("<u8").tobytes()
        step = len(body) // len(at)
        for k, b in enumerate(at.tolist()):
            packed[b] = body[k * step : (k + 1) * step]
    places = odd_place.astype("<u2")
    blocks = []
    heads = np.zeros(count, np.dtype([("least", "<u4"), ("width", "u1"), ("zero", "u1"), ("odd", "<u2")]))
    heads["least"], heads["width"], heads["odd"] = least, width, odd_count
    head_bytes = heads.tobytes()
    for b in range(count):
        body = head_bytes[8 * b : 8 * b + 8] + packed[b]
        if odd_count[b]:
            own = slice(odd_from[b], odd_from[b + 1])
            body += places[own].tobytes() + odd_high[own].tobytes()
        blocks.append(body)
    starts = np.r_[0, np.cumsum([len(b) for b in blocks], dtype=np.uint64)].astype("<u8")
    return HEADER.pack(MAGIC, len(ids), BLOCK, count) + starts.tobytes() + b"".join(blocks)


def decode_segment(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks, found by the index."""
    magic, n, block, count = HEADER.unpack_from(payload)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    last_block = count if last_block is None else last_block
    starts = np.frombuffer(payload, "<u8", count + 1, HEADER.size).astype(np.int64)
    raw = np.frombuffer(payload, np.uint8, offset=HEADER.size + 8 * (count + 1))
    at = starts[first_block:last_block]
    out = np.zeros((len(at), BLOCK), np.uint64)
    if len(at):
        heads = raw[at[:, None] + np.arange(8)]
        least = heads[:, :4].copy().view("<u4").ravel()
        width, odd = heads[:, 4].astype(np.int64), heads[:, 6:8].copy().view("<u2").ravel().astype(np.int64)
        size = (BLOCK * width + 63) // 64 * 8
        for w in np.unique(width):
            own = np.flatnonzero(width == w)
            body = raw[(at[own] + 8)[:, None] + np.arange(size[own[0]])]
            out[own] = _unpack(np.ascontiguousarray(body).view("<u8"), int(w))
        for b in np.flatnonzero(odd).tolist():
            place_at = at[b] + 8 + size[b]
            places = raw[place_at : place_at + 2 * odd[b]].copy().view("<u2")
            highs = raw[place_at + 2 * odd[b] : place_at + 6 * odd[b]].copy().view("<u4")
            out[b, places] |= highs.astype(np.uint64) << np.uint64(width[b])
        out += least.astype(np.uint64)[:, None]
    ids = out.reshape(-1)[: n - first_block * BLOCK if last_block == count else None]
    return ids.astype("<u4")


def write_token_files(
    documents: DataFrame,
    tokenizer: str,
    path: str,
    *,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Write every document's ids and the end id, in ascending order of the key."""
    ordered = keyed_text(documents, key, text).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.ids(tokenizer)
        end = encoder.pack([end_id])
        part = TaskContext.get().partitionId()
        seq = start = 0
        packed: list[bytes] = []
        keys: list[int | None] = []
        sizes: list[int] = []
        held = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(packed), encoder.dtype)
            row = [part, seq, start, len(ids), keys, sizes, encode_segment(ids)]
            types = [
                pa.int32(),
                pa.int32(),
                pa.int64(),
                pa.int64(),
                pa.list_(pa.int64()),
                pa.list_(pa.int64()),
                pa.binary(),
            ]
            names = ["part", "seq", "part_start", "n_ids", "doc_ids", "doc_tokens", "payload"]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            for doc, body in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                own = encoder.of(body or "") + end
                packed.append(own)
                keys.append(doc)
                sizes.append(len(own) // encoder.dtype.itemsize)
                held += sizes[-1]
                if held >= SEGMENT_IDS:
                    yield segment()
                    seq, start, held = seq + 1, start + held, 0
                    packed, keys, sizes = [], [], []
        if packed:
            yield segment()

    rows = ordered.select("doc_id", "text").mapInArrow(run, SEGMENTS)
    rows.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row for each written part: as many as the write had tasks.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    parts = totals.select("part", before.alias("part_before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row["payload"])
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                data = memoryview(ids.tobytes())
                crcs = [
                    zlib.crc32(data[4 * (e - s) : 4 * e])
                    for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)
                ]
                n = len(sizes)
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["part_start"] + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = segments.mapInArrow(
        run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return found.join(parts, "part").select(
        "doc_id", (F.col("start") + F.col("part_before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(
    documents: DataFrame, tokenizer: str, *, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write into the shared folder and read back."""
    spark = documents.sparkSession
    path = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents, tokenizer, path, end_id=end_id, key=key, text=text)
    return read_token_files(spark, path)
