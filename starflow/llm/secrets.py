"""Secret scans: fixed patterns, then dictionary-primed zstandard novelty.

The base finds three kinds of secret by pattern, leftmost and non-overlapping per
kind, and drops matches that are too short (``BASE``). The method then looks at
strings in a sensitive context (a keyword such as ``token`` or ``auth`` shortly
before them): each candidate is compressed after the code that precedes it, by a
zstandard compressor primed with a dictionary trained on the texts of the corpus
and by one primed with the corpus's frequent identifiers. What the candidate adds in
compressed bytes, per byte of its own, is its novelty; identifiers and words compress
well against either dictionary, random keys do not. Candidates at or above
``NOVELTY`` against both dictionaries are reported as kind ``novel``; base spans stay
as they are, and candidates that overlap one are not reported twice.

The dictionaries are fitted on every text: identifiers are counted in all of them,
and tasks train a dictionary on each shard of ``SHARD_BYTES`` of text, from which the
final one is trained. Every text is then scanned whole, in Arrow batches on the
executors.

Defined cases: a null text is scanned as empty (no spans); a null doc_id is carried;
repeated rows give one row each; an empty table gives no rows; other columns of the
input are ignored, whatever their names. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.scratch import saved
from starflow.llm.text import keyed_text, map_batches, tidy

# The base kinds, in their listed order, and the least length of a match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "novel")

# The method's parameters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_.-]{16,}")
CONTEXT_WORDS = re.compile(r"key|secret|token|passw|pwd|auth|credential|private|bearer|session|signature", re.IGNORECASE)
CONTEXT_BEFORE = 64  # characters before a candidate searched for a context word
CODE_BEFORE = 512  # characters before a candidate that it is compressed after
NOVELTY = 0.9  # compressed bytes added per byte of the candidate
PIECE_BYTES = 2_048  # texts are cut into pieces of this size to train on
DICT_BYTES = 16_384
SHARD_BYTES = 8 << 20  # text that one shard's dictionary is trained on
SHARD_DICT_BYTES = 32_768  # size of a shard's dictionary
SEGMENT_BYTES = 1_024  # of a shard's dictionary
FAN_IN = 64  # shards' dictionaries that one is trained from
LEVEL = 19

OUT = (
    "doc_id long, n_assign long, n_access long, n_hex long, "
    "base_sha256 string, spans string, n_novel long"
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans of one text, by start and then kind as listed."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= 8:
            found.append(("assign", m.start(), m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 16:
            found.append(("access", m.start(), m.end()))
    for m in HEX.finditer(text):
        if m.end() - m.start() >= 32:
            found.append(("hex", m.start(), m.end()))
    return ordered(found)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@dataclass(frozen=True)
class Dictionaries:
    """Raw bytes of the trained dictionary and of the identifier dictionary."""

    trained: bytes
    identifiers: bytes


def fit_dictionaries(df: DataFrame, text: str = "text") -> Dictionaries:
    """Both dictionaries from every text; only they and at most ``FAN_IN`` shards'
    dictionaries reach the driver."""
    texts = df.select(F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    if not size:
        return Dictionaries(b"", b"")
    identifiers = _identifier_bytes(texts)
    return Dictionaries(_trained_on_all(texts, size, identifiers), identifiers)


def _trained_on_all(texts: DataFrame, size: int, fallback: bytes) -> bytes:
    """A dictionary trained level by level: on texts, then on ``FAN_IN`` dictionaries.

    Texts of one shard are trained on at once, in their order.
    """
    tasks = -(-size // SHARD_BYTES)
    if tasks == 1:
        return _trained([p for r in texts.coalesce(1).collect() for p in _pieces(r[0].encode("utf-8"))], fallback)
    level = saved(texts.coalesce(tasks).mapInArrow(_shard_dictionaries, "d binary"), "dictionaries")
    while (n := level.count()) > FAN_IN:
        group = F.pmod(F.xxhash64("d"), F.lit(-(-n // FAN_IN)))
        level = saved(level.groupBy(group).applyInArrow(_merged_dictionary, "d binary"), "dictionaries")
    shards = sorted(bytes(r[0]) for r in level.collect())
    return _trained([p for d in shards for p in _pieces(d)], fallback)


def _shard_dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A dictionary for every ``SHARD_BYTES`` of a task's texts; a short rest joins the last."""
    full: list[bytes] = []
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for value in batch.column(0):
            data = value.as_py().encode("utf-8")
            held += _pieces(data)
            size += len(data)
            if size >= SHARD_BYTES:
                if full:
                    yield _one_dictionary(full)
                full, held, size = held, [], 0
    if full and size >= SHARD_BYTES // 2:
        yield _one_dictionary(full)
        full = []
    if full or held:
        yield _one_dictionary(full + held)
    tidy()


def _merged_dictionary(table: pa.Table) -> pa.Table:
    shards = sorted(table.column("d").to_pylist())
    return pa.Table.from_batches([_one_dictionary([p for d in shards for p in _pieces(d)])])


def _one_dictionary(pieces: list[bytes]) -> pa.RecordBatch:
    """One row, or none where the pieces are too few to have segments that repeat."""
    try:
        found = [zstandard.train_dictionary(SHARD_DICT_BYTES, pieces, k=SEGMENT_BYTES, d=8).as_bytes()]
    except zstandard.ZstdError:
        found = []
    return pa.RecordBatch.from_pydict({"d": found}, schema=pa.schema([("d", pa.binary())]))


def _pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def _trained(pieces: list[bytes], fallback: bytes) -> bytes:
    """A trained dictionary (frequent segments only); a sample too small to train on
    gives the identifier content instead, never raw text that may hold a key itself."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, threads=1).as_bytes()
    except zstandard.ZstdError:
        return fallback


def _identifier_bytes(texts: DataFrame) -> bytes:
    """Identifier-like words found in two or more texts, most frequent first.

    A word of one text only is left out, so a key in a single text is not learnt.
    """
    word = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z_][A-Za-z0-9_]{3,}"), 0)))
    counted = texts.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # The shortest words take five bytes with their separator, so these are enough.
    most = counted.where("n >= 2").orderBy(F.desc("n"), "word").limit(DICT_BYTES // 5 + 1).collect()
    out, size = [], 0
    for row in most:
        size += len(row["word"]) + 1
        if size > DICT_BYTES:
            break
        out.append(row["word"])
    return "\n".join(out).encode("utf-8")


class Novelty:
    """Marginal compressed bytes of a candidate after its code, against each dictionary."""

    def __init__(self, dictionaries: Dictionaries):
        self.compressors = []
        for raw in (dictionaries.trained, dictionaries.identifiers):
            if raw:
                kind = zstandard.DICT_TYPE_AUTO if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
                data = zstandard.ZstdCompressionDict(raw, dict_type=kind)
            else:
                data = None
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data))

    def least(self, code: bytes, candidate: bytes) -> float:
        """The least novelty over the dictionaries: a key must be new to both."""
        ratios = []
        for c in self.compressors:
            added = len(c.compress(code + candidate)) - len(c.compress(code))
            ratios.append(added / len(candidate))
        return min(ratios)


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Candidates in a sensitive context whose novelty reaches ``NOVELTY``."""
    found = []
    starts, ends = _merged(base)
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        word = m.group()
        if not (re.search(r"[0-9]", word) and re.search(r"[A-Za-z]", word)):
            continue
        if not CONTEXT_WORDS.search(text, max(0, start - CONTEXT_BEFORE), start):
            continue
        at = bisect.bisect_left(ends, start + 1)
        if at < len(starts) and starts[at] < end:
            continue
        code = text[max(0, start - CODE_BEFORE) : start].encode("utf-8")
        if novelty.least(code, word.encode("utf-8")) >= NOVELTY:
            found.append(("novel", start, end))
    return found


def _merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of the spans, as disjoint intervals in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    dictionaries: Dictionaries | None = None,
) -> DataFrame:
    """One row per input row: the counts of each kind, the base digest and all spans."""
    pairs = keyed_text(df, key, text)
    fitted = dictionaries if dictionaries is not None else fit_dictionaries(pairs)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        novelty = Novelty(fitted)
        cols = {name: [] for name in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")}
        ids, texts = b.column(0), b.column(1)
        for i in range(b.num_rows):
            value = texts[i].as_py() or ""
            base = base_spans(value)
            extra = novel_spans(value, base, novelty)
            kinds = Counter(k for k, _, _ in base)
            cols["doc_id"].append(ids[i].as_py())
            cols["n_assign"].append(kinds["assign"])
            cols["n_access"].append(kinds["access"])
            cols["n_hex"].append(kinds["hex"])
            cols["n_novel"].append(len(extra))
            cols["base_sha256"].append(_sha(joined(base)))
            cols["spans"].append(joined(ordered(base + extra)))
        return pa.RecordBatch.from_pydict(
            cols,
            schema=pa.schema(
                [("doc_id", pa.int64())]
                + [(c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")]
                + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_novel", pa.int64())]
            ),
        )

    return map_batches(pairs, batch, OUT)
