"""Token counts by overlap resynchronisation.

Documents up to ``chunk_chars`` are counted where they lie. A longer one is cut into
overlapping chunks that Spark deals out; each is encoded with offsets, and neighbours
are spliced at a piece border that both have in their overlap. Such a border is proven
stable: the cutting pattern never looks back, so from a border on which the true
cutting and the chunk's cutting agree, they agree until shortly before the chunk's
end (``MARGIN`` characters: the longest special string or contraction looks no
further ahead). Where a pair of neighbours shares no border, the document is encoded
again with overlaps ``WIDEN`` times as wide, until it is one chunk.

Defined cases: null and empty texts have 0 tokens; repeated rows and repeated ids are
counted row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm import tokens
from starflow.llm.scratch import saved
from starflow.llm.text import keyed_text, map_batches

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 1_024
MARGIN = 16
WIDEN = 8


def _count_small(documents: DataFrame, tokenizer: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = tokens.counts(tokenizer)
        found = [counter.of(t) if t else 0 for t in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())]
        return pa.record_batch(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return map_batches(documents, run, "doc_id long, n_bytes long, n_tokens long")


def _chunks(documents: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc row, chunk number, first character, last chunk?, chunk text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, size = row["text"], len(row["text"])
                starts = range(0, max(1, size - overlap), chunk)
                for k, at in enumerate(starts):
                    piece = text[at : at + chunk + overlap]
                    yield pa.record_batch(
                        [
                            pa.array([row["row_id"]], pa.int64()),
                            pa.array([k], pa.int32()),
                            pa.array([at], pa.int64()),
                            pa.array([at + len(piece) >= size]),
                            pa.array([piece], pa.string()),
                        ],
                        names=["row_id", "k", "at", "last", "piece"],
                    )

    return documents.mapInArrow(run, "row_id long, k int, at long, last boolean, piece string")


def borders(tokenizer: str, piece: str) -> tuple[np.ndarray, np.ndarray]:
    """Characters at which a piece of the cutting begins, and the tokens before each."""
    encoding = tokens.load(tokenizer).encode(piece, add_special_tokens=False)
    if not len(encoding):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.array([a for a, _ in encoding.offsets], np.int64)
    number = np.array(encoding.word_ids, np.int64)
    new = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    return starts[new], new


def _encode_chunks(chunks: DataFrame, tokenizer: str, overlap: int) -> DataFrame:
    """Borders inside both overlaps, with the tokens before them, and all tokens."""
    schema = (
        "row_id long, k int, last boolean, n long, head array<long>, head_n array<long>, "
        "tail array<long>, tail_n array<long>"
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for row in batch.to_pylist():
            piece = row["piece"]
            at, before = borders(tokenizer, piece)
            total = len(tokens.load(tokenizer).encode(piece, add_special_tokens=False))
            head = at < overlap
            tail = (at >= len(piece) - overlap) & (at < len(piece) - MARGIN)
            rows.append(
                {
                    "row_id": row["row_id"],
                    "k": row["k"],
                    "last": row["last"],
                    "n": total,
                    "head": (at[head] + row["at"]).tolist(),
                    "head_n": before[head].tolist(),
                    "tail": (at[tail] + row["at"]).tolist(),
                    "tail_n": before[tail].tolist(),
                }
            )
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), *[pa.list_(pa.int64())] * 4]
        names = ["row_id", "k", "last", "n", "head", "head_n", "tail", "tail_n"]
        return pa.record_batch(
            [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names
        )

    return map_batches(chunks, run, schema)


def _splice(encoded: DataFrame) -> DataFrame:
    """Tokens of each document, null where two neighbours share no border."""
    order = Window.partitionBy("row_id").orderBy("k")
    joined = encoded.select(
        "*",
        F.lag("tail").over(order).alias("left_at"),
        F.lag("tail_n").over(order).alias("left_n"),
    )
    border = F.array_max(F.array_intersect("left_at", "head"))
    met = joined.withColumn("border", border)
    spot = lambda at, n: F.get(n, (F.array_position(at, F.col("border")) - 1).cast("int"))
    parts = met.select(
        "row_id",
        F.when(F.col("last"), F.col("n")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("k") == 0, F.lit(0))
        .otherwise(spot("left_at", "left_n") - spot("head", "head_n"))
        .alias("step"),
    )
    # The chunk before a border counts up to it, the chunk after it from there on.
    return parts.groupBy("row_id").agg(
        F.when(F.count("step") == F.count("*"), F.sum("whole") + F.sum("step")).alias("n_tokens")
    )


def count_tokens(
    documents: DataFrame,
    tokenizer: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 512,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens is over ``limit``, a row per row."""
    if not MARGIN < overlap_chars <= chunk_chars // 2:
        raise ValueError("an overlap must be over the margin and at most half a chunk")
    whole = keyed_text(documents, key, text)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sized = whole.withColumn("n_bytes", size)
    is_long = F.coalesce(F.char_length("text") > chunk_chars + overlap_chars, F.lit(False))
    counted = _count_small(sized.where(~is_long), tokenizer)
    long_ones = saved(
        sized.where(is_long).withColumn("row_id", F.monotonically_increasing_id()), "long-documents"
    )
    pending = long_ones
    chunk, overlap = chunk_chars, overlap_chars
    while not pending.isEmpty():
        pieces = _chunks(pending.select("row_id", "text"), chunk, overlap)
        spread = pieces.repartition(F.col("row_id"), F.col("k"))
        spliced = saved(_splice(_encode_chunks(spread, tokenizer, overlap)), "spliced-counts")
        done = spliced.where(F.col("n_tokens").isNotNull())
        keys = long_ones.select("row_id", "doc_id", "n_bytes")
        counted = counted.unionByName(keys.join(done, "row_id").drop("row_id"))
        pending = pending.join(spliced.where(F.col("n_tokens").isNull()), "row_id", "left_semi")
        overlap *= WIDEN
        chunk = max(chunk, 2 * overlap)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
