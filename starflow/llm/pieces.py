"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A normalised text is cut before each blank that follows another character, and around
characters that no piece holds; no piece crosses such a cut. Distinct units of equal
length advance together, one character a step: the hashes of the substrings that end
there probe the sorted keys of the pieces, each found piece is scored as a last step,
and the maximum's length is the backpointer.

The model is of the BPE kind, where the path of the highest score sum is not what the
library returns. A last piece therefore scores only where merging would leave it and
the piece before it apart (both are undone, latest merge first, until a merge across
the border would have come earlier). By the uniqueness of the merge order one last
piece survives at each place, and the ids equal the library's.

Defined cases: null and empty texts have no ids; invalid byte pieces decode to U+FFFD;
repeated rows are encoded row by row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from starflow.llm.text import keyed_text, map_batches

BLANK = "▁"
LONG_UNIT = 96
REMEMBERED = 300_000
CHARS_AT_ONCE = 1 << 22
UNITS_AT_ONCE = 50_000
FAR = np.int64(1) << 40
# Slots of the table of judged pairs, and of the filter before each length's keys.
PAIR_BITS, FILTER_BITS = 20, 18
BASE = np.uint64(0x9E3779B97F4A7C15)


def merge(unit: str, score: dict[str, float]) -> list[str]:
    """Merging by its definition: the best-scored pair of neighbours first, then the leftmost."""
    parts = list(unit)
    while True:
        best = None
        for k in range(len(parts) - 1):
            s = score.get(parts[k] + parts[k + 1])
            if s is not None and (best is None or s > best[0]):
                best = (s, k)
        if best is None:
            return parts
        k = best[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def _last_merge(piece: str, score: dict[str, float]) -> tuple[str, str] | None:
    """The two halves that the last merge of a piece joins; None if merging misses it."""
    parts = list(piece)
    while len(parts) > 2:
        pairs = [(-score[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in score]
        if not pairs:
            return None
        k = min(pairs)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class Model:
    """The tables of one model, built once in a worker."""

    def __init__(self, path: str) -> None:
        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [
            i
            for i in range(size)
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        ]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        single = "".join(re.escape(p) for p in self.id if len(p) == 1)
        self.foreign = re.compile(f"([^{single}])")
        order = sorted(self.score, key=lambda p: -self.score[p])
        # Rank of the merge that makes a piece; -1 where a piece is one character.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        reached = []
        for k, piece in enumerate(order):
            if len(piece) == 1:
                reached.append(piece)
            elif (halves := _last_merge(piece, self.score)) is not None:
                own = self.id[piece]
                self.rank[own] = k
                self.left[own], self.right[own] = self.id[halves[0]], self.id[halves[1]]
                reached.append(piece)
        rank_of = {p: k for k, p in enumerate(order)}
        pairs = {
            self.id[p[:k]] * size + self.id[p[k:]]: rank_of[p]
            for p in order
            for k in range(1, len(p))
            if p[:k] in self.id and p[k:] in self.id
        }
        self.size = size
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_length = defaultdict(list)
        for p in reached:
            by_length[len(p)].append(p)
        for length, own in by_length.items():
            hashes = self.prefixes(own)[:, -1]
            at = np.argsort(hashes)
            held = np.zeros(1 << FILTER_BITS, bool)
            held[hashes >> np.uint64(64 - FILTER_BITS)] = True
            self.keys[length] = (hashes[at], np.array([self.id[p] for p in own], np.int64)[at], held)
        self.longest = max(self.keys)
        surface = [sp.id_to_piece(i).replace(BLANK, " ").encode() for i in range(size)]
        for value, i in self.byte.items():
            surface[i] = bytes([value])
        for i in range(size):
            if sp.is_control(i):
                surface[i] = b""
        self.surface = surface
        self.prefix = sp.normalize("a") == BLANK + "a"
        # The latest pair judged in each slot: twice its key, plus one if it stays apart.
        self.judged = np.full(1 << PAIR_BITS, -1, np.int64)
        # Ids of words and units; a unit is the word that has nothing to cut.
        self.known: dict[str, bytes] = {}

    @staticmethod
    def prefixes(units: list[str]) -> np.ndarray:
        """Hashes of the prefixes of units of one length; column k covers k characters."""
        length = len(units[0])
        codes = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(-1, length)
        out = np.zeros((len(units), length + 1), np.uint64)
        for k in range(length):
            out[:, k + 1] = out[:, k] * BASE + codes[:, k].astype(np.uint64) + np.uint64(1)
        return out

    def apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of neighbouring pieces as it is."""
        key = first * self.size + second
        slot = (key.astype(np.uint64) * BASE) >> np.uint64(64 - PAIR_BITS)
        entry = self.judged[slot]
        good = (entry & 1) == 1
        new = np.flatnonzero((entry >> 1) != key)
        if len(new):
            good[new] = self._judge(first[new], second[new])
            self.judged[slot[new]] = 2 * key[new] + good[new]
        return good

    def _judge(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The verdicts by undoing merges, for pairs that no slot holds."""
        good = np.ones(len(first), bool)
        live = np.arange(len(first))
        limit = np.full(len(first), FAR)
        first, second = first.copy(), second.copy()
        while len(live):
            a, b = first[live], second[live]
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            across = np.where(self.pair_key[at] == key, self.pair_rank[at], FAR)
            good[live] = across >= limit[live]
            # The first look has no limit: any piece that joins both wins.
            good[live[(limit[live] == FAR) & (across == FAR)]] = True
            rank_a, rank_b = self.rank[a], self.rank[b]
            undo_first = rank_a > rank_b
            go = good[live] & ((rank_a >= 0) | (rank_b >= 0))
            limit[live] = np.where(undo_first, rank_a, rank_b + 1)
            first[live] = np.where(undo_first, self.right[a], a)
            second[live] = np.where(undo_first, b, self.left[b])
            live = live[go]
        return good

    def _advance(self, units: list[str]) -> list[bytes]:
        """The Viterbi of units of one length."""
        n, length = len(units), len(units[0])
        hashes = self.prefixes(units)
        last = np.zeros((n, length + 1), np.int64)
        back = np.zeros((n, length + 1), np.int64)
        for end in range(1, length + 1):
            best = np.full(n, -1, np.int64)
            for size in range(1, min(end, self.longest) + 1):
                if size not in self.keys:
                    continue
                keys, ids, held = self.keys[size]
                power = np.multiply.reduce(np.full(size, BASE))
                wanted = hashes[:, end] - hashes[:, end - size] * power
                found = np.flatnonzero(held[wanted >> np.uint64(64 - FILTER_BITS)])
                wanted = wanted[found]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                found, piece = found[hit], ids[at[hit]]
                if end > size:
                    fits = self.apart(last[found, end - size], piece)
                    found, piece = found[fits], piece[fits]
                better = size > best[found]
                found, piece = found[better], piece[better]
                best[found] = size
                last[found, end] = piece
            back[:, end] = best
        path = np.zeros((n, length), "<u4")
        spot, used = np.full(n, length), np.zeros(n, np.int64)
        while (live := np.flatnonzero(spot > 0)).size:
            used[live] += 1
            path[live, length - used[live]] = last[live, spot[live]]
            spot[live] -= back[live, spot[live]]
        flat = path[np.arange(length) >= (length - used)[:, None]].tobytes()
        ends = (4 * np.cumsum(used)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _alone(self, unit: str) -> bytes:
        """The same recursion for one long unit, without arrays across units."""
        last, back, known = [0] * (len(unit) + 1), [0] * (len(unit) + 1), {}
        for end in range(1, len(unit) + 1):
            for size in range(1, min(end, self.longest) + 1):
                piece = self.id.get(unit[end - size : end])
                if piece is None or (size > 1 and self.rank[piece] < 0):
                    continue
                if end > size:
                    pair = (last[end - size], piece)
                    if pair not in known:
                        known[pair] = bool(self.apart(np.array(pair[:1]), np.array(pair[1:]))[0])
                    if not known[pair]:
                        continue
                last[end], back[end] = piece, size
        ids, end = [], len(unit)
        while end:
            ids.append(last[end])
            end -= back[end]
        return np.array(ids[::-1], "<u4").tobytes()

    def _learn(self, units: Iterable[str]) -> None:
        by_length = defaultdict(list)
        for unit in units:
            if BLANK * 2 in unit:
                # Runs of blanks share one score, so the merge order itself decides.
                parts = merge(unit[:LONG_UNIT], self.score) if len(unit) <= LONG_UNIT else None
                ids = [self.id[p] for p in parts] if parts else self._library(unit)
                self.known[unit] = np.array(ids, "<u4").tobytes()
            elif len(unit) > LONG_UNIT:
                self.known[unit] = self._alone(unit)
            else:
                by_length[len(unit)].append(unit)
        for own in by_length.values():
            for at in range(0, len(own), UNITS_AT_ONCE):
                part = own[at : at + UNITS_AT_ONCE]
                self.known.update(zip(part, self._advance(part), strict=True))

    def _library(self, unit: str) -> list[int]:
        """A blank run longer than a unit may be: the library's own merges."""
        text = unit.replace(BLANK, " ")
        return self.library.encode(text[1:] if self.prefix else text)

    def cut(self, text: str) -> list[str]:
        """The words of a text, each with the blanks before it."""
        whole = self.library.normalize(text)
        if BLANK * 2 not in whole:
            first, *rest = whole.split(BLANK)
            return ([first] if first else []) + [BLANK + w for w in rest]
        return re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", whole)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; the words of about ``CHARS_AT_ONCE`` are held at a time."""
        out: list[np.ndarray] = []
        held: list[str | None] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= CHARS_AT_ONCE:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = [self.cut(t) if t else [] for t in texts]
        new = set().union(*cut) - self.known.keys() if cut else set()
        parts = {w: [x for x in self.foreign.split(w) if x] for w in new}
        foreign = {x for own in parts.values() for x in own if len(x) == 1 and x not in self.id}
        units = {x for own in parts.values() for x in own} - foreign - self.known.keys()
        self._learn(units)
        for x in foreign:
            ids = [self.byte[b] for b in x.encode()] if self.byte else [self.unknown]
            self.known[x] = np.array(ids, "<u4").tobytes()
        look_up = self.known.__getitem__
        for w, own in parts.items():
            if own != [w]:
                self.known[w] = b"".join(map(look_up, own))
        return [np.frombuffer(b"".join(map(look_up, own)), "<u4") for own in cut]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode(errors="replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@cache
def load(path: str) -> Model:
    return Model(path)


def encode_documents(
    documents: DataFrame, model: str, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding the ids gives the text again."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = load(model)
        texts = batch.column("text").to_pylist()
        ids = own.encode(texts)
        same = [own.decode(x) == (t or "") for x, t in zip(ids, texts, strict=True)]
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        columns = [
            batch.column("doc_id"),
            pa.array(np.diff(ends), pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
            pa.array(same),
        ]
        return pa.record_batch(columns, names=["doc_id", "n_tokens", "ids", "round_trip"])

    schema = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    return map_batches(keyed_text(documents, key, text), run, schema)


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = load(model)
        texts = [own.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array(texts)], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
