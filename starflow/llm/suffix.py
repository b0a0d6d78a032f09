"""Substring duplicates of bytes by run-length Burrows-Wheeler indexes.

A 50-byte string is dealt to a shard by its minimiser (the least hash of its 20-byte
grams), so equal strings meet and the corpus needs no single index. Three passes over
packed chunks of documents:

1. chunks send their distinct minimisers with their counts; buckets answer with those
   that occur in two documents, and only text around such ones goes on. One that heads
   over ``HOT_RUNS`` runs would fill a shard: its windows are dealt singly by a hash of
   all their bytes instead, so only equal windows still meet;
2. chunks send its runs (consecutive windows of one minimiser, at most 80 bytes), each
   distinct one once with its least document. A shard sorts the suffixes of the runs
   that share a minimiser with another run, stores their Burrows-Wheeler transform as runs of equal bytes with suffixes
   sampled at both ends of a run, and the least document of every interval of equal
   50-byte prefixes. It then streams the matching statistics of each run through that
   index, and answers for each window whether a smaller document has it;
3. chunks join the answers to spans.

Defined cases: null and empty texts have no bytes; a text shorter than the match keeps
all; repeats inside one document, and rows with equal ids, do not count against each
other; a null id counts as larger than every id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import chunks as ch
from starflow.llm.scratch import saved
from starflow.llm.substring import NO_ID, _messages, mix
from starflow.llm.text import keyed_text, tidy

LENGTH = 50
GRAM = 20
MINIMISER_BITS = 48
PIECE_BYTES = 1 << 18  # hashed together: the arrays of a piece stay in the processor's cache
HOT_RUNS = 200_000
HOT = np.uint64(1)


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each byte on; ``data`` has 8 bytes of padding."""
    eight = np.lib.stride_tricks.as_strided(data.view("<u1"), (len(data) - 7, 8), (1, 1)).view("<u8").ravel()
    n = max(0, len(data) - 8 - GRAM + 1)
    first, second, third = eight[:n], eight[8 : n + 8], eight[GRAM - 8 : n + GRAM - 8]
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    return mix(first * odd[0] + second * odd[1] + third * odd[2])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:]) if len(values) > size else values[:0]
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Runs:
    """A chunk's runs of windows with one minimiser: hash, first byte, windows, document."""

    def __init__(self, table: pa.Table, length: int) -> None:
        ids = table.column("doc_id").to_pylist()
        self.length, self.width = length, length - GRAM + 1
        self.texts = [t.encode() if t else b"" for t in table.column("text").to_pylist()]
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.sizes = sizes
        parts: list[list[np.ndarray]] = []
        at = 0
        while at < len(ids):
            to, size = at + 1, int(sizes[at])
            while to < len(ids) and size + sizes[to] <= PIECE_BYTES:
                size += int(sizes[to])
                to += 1
            parts.append(self._of(at, to))
            at = to
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4
        self.value, self.start, self.count, self.doc = joined

    def _of(self, at: int, to: int) -> list[np.ndarray]:
        base = self.first[at]
        own = self.data[base : self.first[to - 1] + self.sizes[to - 1]]
        padded = np.concatenate([own, np.zeros(8, np.uint8)])
        if len(own) < self.length:
            return [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 3
        least = _sliding_least(_grams(padded), self.width)
        doc = np.repeat(np.arange(at, to), self.sizes[at:to])
        inside = doc[: len(least)] == doc[self.length - 1 :]
        new = np.r_[True, (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])]
        new |= np.r_[True, inside[1:] != inside[:-1]]
        head = np.flatnonzero(new)
        count = np.diff(np.r_[head, len(least)])
        if (count > self.width).any():
            parts = -(-count // self.width)
            place = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            head = np.repeat(head, parts) + place * self.width
            count = np.diff(np.r_[head, len(least)])
        good = inside[head]
        mask = ~np.uint64((1 << (64 - MINIMISER_BITS)) - 1)
        # Mixed again: least hashes are small, and leading bits name the bucket.
        return [mix(least[head][good]) & mask, head[good] + base, count[good], doc[head][good]]

    def picked(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Key, first byte, windows and document of the runs to send, in order of key.

        ``shared`` holds minimisers, those with the ``HOT`` bit set to be dealt by window.
        """
        plain = shared & ~HOT
        pick = np.flatnonzero(ch.in_sorted(self.value, plain))
        hot = ch.in_sorted(self.value[pick], plain[(shared & HOT) == HOT])
        cold, split = pick[~hot], pick[hot]
        times = self.count[split]
        place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        start = np.repeat(self.start[split], times) + place
        joined = (
            np.concatenate([self.value[cold], self._window_keys(start)]),
            np.concatenate([self.start[cold], start]),
            np.concatenate([self.count[cold], np.ones(len(start), np.int64)]),
            np.concatenate([self.doc[cold], np.repeat(self.doc[split], times)]),
        )
        order = np.argsort(joined[0], kind="stable")
        return tuple(x[order] for x in joined)

    def _window_keys(self, start: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(start), np.uint64)
        for k in range(self.length if len(start) else 0):
            keys = mix(keys + self.data[start + k].astype(np.uint64) + np.uint64(1))
        return keys

    def strings(self, at: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
        """Rows of bytes plus one, zero-filled, of runs."""
        size = count + self.length - 1
        place = np.arange(width)
        inside = place < size[:, None]
        where = np.minimum(at[:, None] + place, max(0, len(self.data) - 1))
        return np.where(inside, self.data[where] + np.uint8(1), np.uint8(0))


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and each row's place among them."""
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
    distinct, inverse = np.unique(whole, return_inverse=True)
    return distinct.view(np.uint8).reshape(-1, rows.shape[1]), inverse


def _words(rows: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of each row on, zeros behind a row's end."""
    n, width = rows.shape
    wide = np.zeros((n, width + 16), np.uint8)
    wide[:, :width] = rows
    eight = np.lib.stride_tricks.as_strided(wide, (n, width + 9, 8), (wide.shape[1], 1, 1))
    return np.ascontiguousarray(eight).view("<u8")[:, :, 0]


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of a set of distinct strings.

    ``rows`` holds byte + 1 per place and zeros behind a string's end; a zero ends a
    string, and ends are ordered by row. ``owner`` is the document of each string. Each suffix keeps
    its run and its least document, so that both are read without a search.
    """

    def __init__(self, rows: np.ndarray, owner: np.ndarray, length: int) -> None:
        if length < 8:
            raise ValueError("prefixes are told apart from 8 bytes on")
        self.rows, self.length = rows, length
        self.words = _words(rows)
        n, width = rows.shape
        size = (rows != 0).sum(axis=1)
        span = width + 1
        valid = np.arange(span) <= size[:, None]
        row, col = np.nonzero(valid)
        rank, at_length = self._ranks(row, col, valid)
        # In order of rank, then of row.
        order = np.sort(rank.astype(np.int64) * len(rank) + np.arange(len(rank))) % max(1, len(rank))
        self.row, self.col = row[order].astype(np.int32), col[order].astype(np.int32)
        same = at_length[order]
        same = same[1:] == same[:-1]
        # Intervals of equal prefixes of ``length`` bytes, with their least document.
        self.interval = np.flatnonzero(np.r_[True, ~same])
        least = np.minimum.reduceat(owner[self.row], self.interval)
        self.least = np.repeat(least, np.diff(np.r_[self.interval, len(self.row)]))
        last = np.where(self.col > 0, rows[self.row, np.maximum(self.col, 1) - 1], 0)
        head = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])
        end = np.r_[head[1:], len(last)]
        symbol = last[head].astype(np.int64)
        by_symbol = np.lexsort((head, symbol))
        place = np.empty(len(head), np.int32)
        place[by_symbol] = np.arange(len(head))
        # The run that holds each suffix, so that only a pattern that leaves its run searches.
        self.run_at = np.repeat(place, end - head)
        self.symbol, self.head, self.end = symbol[by_symbol], head[by_symbol], end[by_symbol]
        self.n = len(last)
        self.key = self.symbol * (self.n + 1) + self.head
        # Suffixes before a run's first byte in the order of all suffixes.
        self.before = np.cumsum(self.end - self.head) - (self.end - self.head)
        # Samples: the suffixes at both ends of each run are all that matching reads.
        self.sample = [(self.row[x], self.col[x]) for x in (self.head, self.end - 1)]
        del self.row, self.col

    def _ranks(self, row: np.ndarray, col: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of all suffixes by prefix doubling, and what tells ``length`` bytes apart."""
        n, span = valid.shape
        first = self.words[row, col].byteswap()
        order = np.argsort(first)
        first = first[order]
        head = np.r_[True, first[1:] != first[:-1]]
        # A rank is one more than the suffixes before its group, so that groups that are
        # told apart keep theirs and only tied suffixes are sorted again.
        rank = np.empty(len(order), np.int32 if len(order) < (1 << 31) - 1 else np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0)) + 1
        tied = order[~(head & np.r_[head[1:], True])]
        depth, at_length = 8, None
        stride = 2 * span + self.length
        table, place_of = np.zeros(n * stride, rank.dtype), row * stride + col
        table[place_of] = rank
        while True:
            if at_length is None and (2 * depth > self.length or depth >= span):
                behind = table[place_of + max(0, self.length - depth)]
                at_length = rank.astype(np.int64) * (len(order) + 1) + behind
            if depth >= span or not len(tied) and at_length is not None:
                return rank, at_length
            old = rank[tied].astype(np.int64)
            pair = old * (len(order) + 1) + table[place_of[tied] + np.minimum(depth, stride - 1 - col[tied])]
            by_pair = np.argsort(pair)
            tied, old, pair = tied[by_pair], old[by_pair], pair[by_pair]
            place = np.arange(len(tied))
            group = np.r_[True, old[1:] != old[:-1]][: len(tied)]
            head = np.r_[True, pair[1:] != pair[:-1]][: len(tied)]
            since = [np.maximum.accumulate(np.where(x, place, 0)) for x in (group, head)]
            rank[tied] = old + since[1] - since[0]
            table[place_of[tied]] = rank[tied]
            tied = tied[~(head & np.r_[head[1:], True][: len(tied)])]
            depth *= 2

    def _common(
        self, sample: int, run: np.ndarray, words: np.ndarray, line: np.ndarray, at: np.ndarray, most: np.ndarray
    ) -> np.ndarray:
        """Bytes, up to ``most``, that the sampled suffixes of runs share with the patterns
        from ``at`` on, compared eight at a time; ``words`` are the patterns' (:func:`_words`)."""
        row, col = (x[run].astype(np.int64) for x in self.sample[sample])
        common = np.zeros(len(run), np.int64)
        live = np.flatnonzero(most > 0)
        done = 0
        while len(live):
            differ = words[line[live], at[live] + done] ^ self.words[row[live], col[live] + done]
            # The place of the lowest bit that differs; eight bytes alike count eight.
            lowest = np.frexp((differ & (~differ + np.uint64(1))).astype(np.float64))[1] - 1
            common[live] = done + np.where(differ == 0, 8, lowest >> 3)
            done += 8
            live = live[(differ == 0) & (most[live] > done)]
        return np.minimum(common, most)

    def least_documents(self, text: np.ndarray) -> np.ndarray:
        """For each place of each pattern, the least document that has the ``length``
        bytes from there on; ``NO_ID`` where the matching statistic is shorter."""
        n, width = text.shape
        size = (text != 0).sum(axis=1)
        found = np.full((n, width), NO_ID, np.int64)
        words = _words(text)
        spot, match = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for step in range(1, int(size.max(initial=0)) + 1):
            live = np.flatnonzero(size >= step)
            at = size[live] - step
            symbol = text[live, at].astype(np.int64)
            run = self.run_at[spot[live]].astype(np.int64)
            lost = np.flatnonzero(self.symbol[run] != symbol)
            where, length = spot[live].copy(), match[live].copy()
            if len(lost):
                wanted = symbol[lost] * (self.n + 1) + spot[live[lost]]
                run[lost] = np.searchsorted(self.key, wanted, side="right") - 1
                own = (run[lost] >= 0) & (self.symbol[run[lost]] == symbol[lost])
                up = np.minimum(run[lost] + 1, len(self.key) - 1)
                has_up = (run[lost] + 1 < len(self.key)) & (self.symbol[up] == symbol[lost])
                known_to = length[lost]
                near = (words, live[lost], at[lost] + 1, known_to)
                down_common = np.where(own, self._common(1, run[lost], *near), -1)
                # What is matched below as far as can be needs no look above.
                look = np.flatnonzero(has_up & (down_common < known_to))
                near = (words, live[lost[look]], at[lost[look]] + 1, known_to[look])
                up_common = np.full(len(lost), -1, np.int64)
                up_common[look] = self._common(0, up[look], *near)
                go_up = up_common > down_common
                best = np.maximum(up_common, down_common)
                where[lost] = np.where(go_up, self.head[up], self.end[run[lost]] - 1)
                run[lost] = np.where(go_up, up, run[lost])
                length[lost] = best
            known = length >= 0
            spot[live] = np.where(known, self.before[run] + where - self.head[run], 0)
            match[live] = np.where(known, length + 1, 0)
            long = np.flatnonzero(match[live] >= self.length)
            if len(long):
                found[live[long], at[long]] = self.least[spot[live[long]]]
        return found


def _send_minimisers(packed: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, chunk, once, more, runs): minimisers in one of the chunk's documents, in
    several, and the runs of each, those of ``once`` first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                runs = Runs(ch.unpack_rows(row["rows"]), length)
                order = np.argsort(runs.value, kind="stable")
                value, doc = runs.value[order], runs.doc[order]
                if not len(value):
                    continue
                first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                times = np.diff(np.r_[first, len(value)])
                value = value[first]
                for b, s in ch.bucket_slices(value, buckets):
                    own, many, n = value[s], several[s], times[s]
                    counts = ch.pack_plain(np.concatenate([n[~many], n[many]]))
                    yield _messages(
                        [(b, row["chunk"], ch.pack_sorted(own[~many]), ch.pack_sorted(own[many]), counts)],
                        ["bucket", "chunk", "once", "more", "runs"],
                        [pa.int32(), pa.int64(), *[pa.binary()] * 3],
                    )
        tidy()

    return packed.mapInArrow(run, "bucket int, chunk long, once binary, more binary, runs binary")


def _answer_minimisers(group: pa.Table, hot_runs: int) -> pa.Table:
    numbers = group.column("chunk").to_pylist()
    once = [ch.unpack_sorted(x) for x in group.column("once").to_pylist()]
    more = [ch.unpack_sorted(x) for x in group.column("more").to_pylist()]
    runs = [ch.unpack_plain(x) for x in group.column("runs").to_pylist()]
    every = np.concatenate([np.concatenate(pair) for pair in zip(once, more, strict=True)])
    value, which, count = np.unique(every, return_inverse=True, return_counts=True)
    total = np.bincount(which, np.concatenate(runs), len(value))
    shared = value[(count > 1) | ch.in_sorted(value, np.unique(np.concatenate(more)))]
    hot = value[total > hot_runs]
    rows = []
    for number, a, b in zip(numbers, once, more, strict=True):
        both = np.union1d(a[ch.in_sorted(a, shared)], b)
        both |= np.where(ch.in_sorted(both, hot), HOT, np.uint64(0))
        if len(both):
            rows.append((number, ch.pack_sorted(both)))
    tidy()
    return pa.Table.from_batches([_messages(rows, ["chunk", "answer"], [pa.int64(), pa.binary()])])


def _shards(runs: Runs, shared: np.ndarray, buckets: int, width: int) -> Iterator[tuple]:
    """(bucket, first byte, windows and document of each run, distinct strings, place of
    each run among them, and of each string its least document and key)."""
    key, start, count, doc = runs.picked(shared)
    for b, s in ch.bucket_slices(key, buckets):
        distinct, inverse = _distinct_rows(runs.strings(start[s], count[s], width))
        least = np.full(len(distinct), NO_ID, np.int64)
        np.minimum.at(least, inverse, runs.ids[doc[s]])
        value = np.zeros(len(distinct), np.uint64)
        value[inverse] = key[s]
        yield b, start[s], count[s], doc[s], distinct, inverse, least, value


def _shared_of(group: pa.Table) -> tuple[int, pa.Table, np.ndarray]:
    rows = [x for x in group.column("rows").to_pylist() if x is not None]
    turn = group.column("round").to_pylist()
    answers = [
        ch.unpack_sorted(x)
        for x, k in zip(group.column("answer").to_pylist(), turn, strict=True)
        if k == 1
    ]
    shared = np.sort(np.concatenate(answers)) if answers else np.zeros(0, np.uint64)
    return group.column("chunk")[0].as_py(), ch.unpack_rows(rows[0]), shared


def _match(group: pa.Table, width: int, length: int) -> pa.Table:
    """Index a shard's strings, stream them through it, and answer each chunk."""
    numbers = group.column("chunk").to_pylist()
    bucket = group.column("bucket")[0].as_py()
    strings = [
        np.frombuffer(ch.unsqueeze(x), np.uint8).reshape(-1, width)
        for x in group.column("strings").to_pylist()
    ]
    least = [ch.unpack_plain(x) for x in group.column("least").to_pylist()]
    distinct, inverse = _distinct_rows(np.concatenate(strings))
    owner = np.full(len(distinct), NO_ID, np.int64)
    np.minimum.at(owner, inverse, np.concatenate(least))
    value = np.zeros(len(distinct), np.uint64)
    value[inverse] = np.concatenate([ch.unpack_plain(x) for x in group.column("value").to_pylist()]).view(np.uint64)
    # A string alone under its key shares no window with another: its least
    # document has them all, and only the others go into the index.
    known = np.repeat(owner[:, None], width - length + 1, axis=1)
    _, which, count = np.unique(value, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[which] > 1)
    if len(several):
        index = RunIndex(distinct[several], owner[several], length)
        for at in range(0, len(several), 1 << 14):
            part = several[at : at + (1 << 14)]
            known[part] = index.least_documents(distinct[part])[:, : width - length + 1]
    rows, at = [], 0
    for number, own, low in zip(numbers, strings, least, strict=True):
        smaller = known[inverse[at : at + len(own)]] < low[:, None]
        at += len(own)
        rows.append((number, bucket, ch.squeeze(np.packbits(smaller, axis=1).tobytes())))
    tidy()
    names, types = ["chunk", "bucket", "answer"], [pa.int64(), pa.int32(), pa.binary()]
    return pa.Table.from_batches([_messages(rows, names, types)])


def repeated_bytes(
    documents: DataFrame, *, length: int = LENGTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    hot_runs = HOT_RUNS
    if length < GRAM:
        raise ValueError(f"a match must have {GRAM} bytes or more")
    width = 2 * length - GRAM
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    packed = ch.to_chunks(keyed_text(documents, key, text).withColumn("n_bytes", size), "n_bytes", "byte-chunks")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    first_buckets, second_buckets = ch.buckets_for(total // 16), ch.buckets_for(total // 4)
    asked = _send_minimisers(packed, length, first_buckets)
    shared = saved(
        asked.groupBy("bucket").applyInArrow(
            lambda group: _answer_minimisers(group, hot_runs), "chunk long, answer binary"
        ),
        "minimisers",
        compression="none",
    )
    none = F.lit(None)
    base = packed.select(
        "chunk", "rows", none.cast("binary").alias("answer"), F.lit(0).alias("round"), F.lit(0).alias("bucket")
    )
    one = shared.select(
        "chunk", none.cast("binary").alias("rows"), "answer", F.lit(1).alias("round"), F.lit(0).alias("bucket")
    )

    def send(group: pa.Table) -> pa.Table:
        number, table, own = _shared_of(group)
        rows = [
            (b, number, ch.squeeze(distinct.tobytes()), ch.pack_plain(least), ch.pack_plain(value.view(np.int64)))
            for b, _, _, _, distinct, _, least, value in _shards(Runs(table, length), own, second_buckets, width)
        ]
        names = ["bucket", "chunk", "strings", "least", "value"]
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
        return pa.Table.from_batches([_messages(rows, names, types)])

    sent = base.union(one).groupBy("chunk").applyInArrow(
        send, "bucket int, chunk long, strings binary, least binary, value binary"
    )
    matched = saved(
        sent.groupBy("bucket").applyInArrow(
            lambda group: _match(group, width, length), "chunk long, bucket int, answer binary"
        ),
        "matches",
        compression="none",
    )
    two = matched.select("chunk", none.cast("binary").alias("rows"), "answer", F.lit(2).alias("round"), "bucket")

    def finish(group: pa.Table) -> pa.Table:
        _, table, own = _shared_of(group)
        runs = Runs(table, length)
        change = np.zeros(len(runs.data) + 1, np.int32)
        turn, bucket = group.column("round").to_pylist(), group.column("bucket").to_pylist()
        bits = {
            b: np.frombuffer(ch.unsqueeze(x), np.uint8)
            for x, k, b in zip(group.column("answer").to_pylist(), turn, bucket, strict=True)
            if k == 2
        }
        places = width - length + 1
        for b, start, count, doc, distinct, inverse, least, _ in _shards(runs, own, second_buckets, width):
            flags = np.unpackbits(bits[b].reshape(len(distinct), -1), axis=1, count=places).astype(bool)
            # A larger document of this chunk has the whole string from the least one.
            marked = flags[inverse] | (runs.ids[doc] > least[inverse])[:, None]
            marked &= np.arange(places) < count[:, None]
            where = (start[:, None] + np.arange(places))[marked]
            np.add.at(change, where, 1)
            np.add.at(change, where + length, -1)
        covered = np.cumsum(change[:-1]) > 0
        removed, spans, digests = [], [], []
        for k, body in enumerate(runs.texts):
            mask = covered[runs.first[k] : runs.first[k] + runs.sizes[k]]
            removed.append(int(mask.sum()))
            spans.append(int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1)))
            kept = np.frombuffer(body, np.uint8)[~mask].tobytes() if removed[-1] else body
            digests.append(hashlib.sha256(kept).hexdigest())
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array(runs.sizes),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return base.union(one).union(two).groupBy("chunk").applyInArrow(finish, schema)
