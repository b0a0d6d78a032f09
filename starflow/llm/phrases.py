"""Phrase collocation mining over count streams in prefix and suffix order.

Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends and those into
words at runs of space and tab. Per language, every phrase of 1 to ``longest`` words is
counted where it occurs inside a piece (overlaps included). A candidate is a phrase of 2
or more words seen at least ``least`` times; every part of it is then seen as often, so
only phrases at or above ``least`` are kept for what follows. Most phrases are rarer and
never travel as strings: chunks of texts, their words numbered and written once, send
hashes of their phrases first (:func:`frequent`).

The kept counts are laid out twice: sorted by their words (prefix order), and sorted
by their words reversed (suffix order). In prefix order a phrase follows its own
prefixes and precedes its right extensions, so one pass per partition with a stack
of the last phrase of each length gives the count of every left part (``l``) and the
largest right extension; the pass over suffix order gives right parts (``r``) and the
largest left extension. No hash table is consulted: the streams are merged as
sorted. A partition that starts inside a family lacks at most two prefixes and
passes at most one extension on; those are looked up in a table of at most three rows
a partition, a proven bound, broadcast. The two annotated streams are then merge-
joined on the phrase.

A candidate's score at a cut after ``k`` words is floor(1e6 * a * a / (l * r)),
computed in decimal(38, 0): exact while a * a * 1e6 stays below 1e38 (a below 1e16).
The lowest cut counts, ties to the smallest k. A candidate is dropped when a longer
candidate contains it contiguously and occurs at least half as often. Per language the
first ``top`` by score, then count, descending, then phrase (UTF-8 bytes) ascending are
returned; Spark limits each task's rows per language before the exchange.

Defined cases: a null text counts as empty and a null language as ``und``; empty and
blank texts add nothing; repeated rows count each time; an empty table gives no rows;
columns other than text and language are ignored, whatever their names. A task holds
the words of ``CHUNK_BYTES`` of texts, or of one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starflow.llm import chunks as ch
from starflow.llm.scratch import saved
from starflow.llm.substring import _messages, join_hashes, mix
from starflow.llm.text import tidy

# Where pieces and words are cut, and the letters lower-cased.
KIND = np.zeros(256, np.uint8)  # 0 in words, 1 between words, 2 between pieces
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK_BYTES = 16 << 20  # of text whose words are numbered and counted together
HASH_BITS = 48

STREAM = "lang string, key array<string>, f long, p1 long, p2 long, ext long, kind string"


def _hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of binary strings, a polynomial of their bytes."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets, size = offsets[:-1] - offsets[0], np.diff(offsets)
    power = np.cumprod(np.full(int(size.max(initial=0)), 0x9FB21C651E98DF25, np.uint64))
    value = (data.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(data)) - np.repeat(offsets, size)]
    total = np.add.reduceat(np.r_[value, np.uint64(0)], offsets) if len(offsets) else value
    return mix(np.where(size > 0, total, 0) + size.astype(np.uint64))


def _numbered(table: pa.Table) -> dict[str, pa.Array]:
    """A chunk's words by number.

    ``words`` and ``langs`` are distinct; an entry is a pair of both (``word_of``,
    ``lang_of``). ``own`` has the entry of each word of the texts in their order, and
    ``follows`` says whether the next one stands in the same piece.
    """
    text = pc.fill_null(table.column("text").cast(pa.large_string()), "")
    empty, line = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    # Every text ends a piece.
    text = pa.concat_arrays(pc.binary_join_element_wise(text, empty, line).chunks)
    lang = pa.concat_arrays(pc.fill_null(table.column("lang").cast(pa.string()), "und").chunks).dictionary_encode()
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    kind, offsets = KIND[data], offsets - offsets[0]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    start, size = edge[::2], edge[1::2] - edge[::2]
    follows = ~np.logical_or.reduceat(kind == 2, start) if len(start) else np.zeros(0, bool)
    ends = pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int64))
    letters = pa.py_buffer(LOWER[data[inside]])
    word = pa.Array.from_buffers(pa.large_binary(), len(start), [None, ends, letters]).dictionary_encode()
    of_text = np.repeat(lang.indices.to_numpy(), np.diff(np.searchsorted(start, offsets)))
    n_words = max(1, len(word.dictionary))
    entry = pa.array(of_text.astype(np.int64) * n_words + word.indices.to_numpy()).dictionary_encode()
    pair = entry.dictionary.to_numpy()
    return {
        "words": word.dictionary,
        "langs": lang.dictionary,
        "word_of": pa.array(pair % n_words, pa.int32()),
        "lang_of": pa.array(pair // n_words, pa.int32()),
        "own": entry.indices,
        "follows": pa.array(follows),
    }


class Grams:
    """All phrases of a chunk: their hashes, and where they start."""

    def __init__(self, rows: bytes, bits: int) -> None:
        table = ch.unpack_rows(rows)
        lists = {name: table.column(name).chunk(0).flatten() for name in table.column_names}
        self.words, self.langs = lists.pop("words"), lists.pop("langs")
        own, follows, word_of, lang_of = (
            lists[x].to_numpy(zero_copy_only=False) for x in ("own", "follows", "word_of", "lang_of")
        )
        self.own, self.word_of, self.lang_of = own, word_of, lang_of
        self.two = np.flatnonzero(follows[:-1]).astype(np.int32)
        self.three = np.flatnonzero(follows[:-2] & follows[1:-1]).astype(np.int32)
        one = join_hashes(_hashes(self.words)[word_of], _hashes(self.langs.cast(pa.large_binary()))[lang_of])[own]
        pairs = join_hashes(one[:-1], one[1:])
        parts = [one, pairs[self.two], join_hashes(pairs[self.three], one[self.three + 2])]
        self.hashes = np.concatenate(parts)
        self.hashes &= ~np.uint64((1 << (64 - bits)) - 1)

    def entries(self, at: np.ndarray) -> list[np.ndarray]:
        """The entries of up to three words of the phrases at places of ``hashes``; -1 for none."""
        n, m = len(self.own), len(self.two)
        start = at.copy()
        start[(at >= n) & (at < n + m)] = self.two[at[(at >= n) & (at < n + m)] - n]
        start[at >= n + m] = self.three[at[at >= n + m] - n - m]
        found = [self.own[start]]
        for k, least in ((1, n), (2, n + m)):
            own = np.full(len(at), -1, np.int32)
            own[at >= least] = self.own[start[at >= least] + k]
            found.append(own)
        return found

    def strings(self, entries: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
        """Languages and phrases."""
        parts = [
            self.words.take(pa.array(self.word_of[np.maximum(e, 0)], mask=e < 0)).cast(pa.large_string()) for e in entries
        ]
        space = pa.scalar(" ", pa.large_string())
        phrase = pc.binary_join_element_wise(*parts, space, null_handling="skip")
        return self.langs.take(pa.array(self.lang_of[entries[0]])), phrase


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where an ordered array has a new value, and how often each stands there."""
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    return head, np.diff(np.r_[head, len(ordered)])


def _number_words(df: DataFrame, text: str, lang: str, chunk_bytes: int) -> DataFrame:
    """(chunk, n_words, rows, langs, totals): texts as numbered words, written once."""
    sized = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, table in ch.numbered_tables(batches, "n_bytes", chunk_bytes):
            found = _numbered(table)
            packed = {k: pa.LargeListArray.from_arrays([0, len(v)], v) for k, v in found.items()}
            times = np.bincount(found["own"].to_numpy(), minlength=len(found["lang_of"]))
            totals = np.bincount(found["lang_of"].to_numpy(), times, len(found["langs"])).astype(np.int64)
            row = (number, len(found["own"]), ch.pack_rows(pa.table(packed)), found["langs"].to_pylist(), totals.tolist())
            types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield _messages([row], ["chunk", "n_words", "rows", "langs", "totals"], types)
        tidy()

    schema = "chunk long, n_words long, rows binary, langs array<string>, totals array<long>"
    return saved(sized.mapInArrow(run, schema), "phrases-words", compression="none")


def frequent(words: DataFrame, least: int, bits: int) -> DataFrame:
    """``lang``, ``phrase`` and count ``f`` of the phrases seen ``least`` times or more.

    Chunks send the distinct hashes of their phrases, with counts, to buckets of the hash
    space; a bucket answers which reach ``least``. Only those phrases then travel as
    strings, once a chunk with their count, and their counts are added up by string: a
    shared hash lets a rare phrase through to the count, and changes none.
    """
    total = words.agg(F.sum("n_words")).first()[0] or 0
    buckets = ch.buckets_for(3 * total // 4)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ordered = Grams(row["rows"], bits).hashes
                ordered.sort()
                head, times = _groups(ordered)
                ordered, times = ordered[head], np.minimum(times, least)
                for b, s in ch.bucket_slices(ordered, buckets):
                    yield _messages(
                        [(b, row["chunk"], ch.pack_sorted(ordered[s]), ch.pack_plain(times[s]))],
                        ["bucket", "chunk", "hashes", "times"],
                        [pa.int32(), pa.int64(), pa.binary(), pa.binary()],
                    )
        tidy()

    def answer(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        hashes = [ch.unpack_sorted(x) for x in group.column("hashes").to_pylist()]
        times = np.concatenate([ch.unpack_plain(x) for x in group.column("times").to_pylist()])
        _, which = np.unique(np.concatenate(hashes), return_inverse=True)
        enough = (np.bincount(which, times) >= least)[which]
        cuts = np.cumsum([len(x) for x in hashes])[:-1]
        rows = [
            (number, bucket, np.packbits(own).tobytes())
            for number, own in zip(group.column("chunk").to_pylist(), np.split(enough, cuts), strict=True)
            if own.any()
        ]
        tidy()
        return pa.Table.from_batches([_messages(rows, ["chunk", "bucket", "rows"], [pa.int64(), pa.int32(), pa.binary()])])

    def spell(group: pa.Table) -> pa.Table:
        sent = dict(zip(group.column("bucket").to_pylist(), group.column("rows").to_pylist(), strict=True))
        grams = Grams(sent.pop(-1), bits)
        order = np.argsort(grams.hashes)
        ordered = grams.hashes[order]
        grams.hashes = None
        head, times = _groups(ordered)
        value, enough = ordered[head], np.zeros(len(head), bool)
        for b, s in ch.bucket_slices(value, buckets):
            if b in sent:
                enough[s] = np.unpackbits(np.frombuffer(sent[b], np.uint8), count=s.stop - s.start)
        chosen = np.repeat(enough, times)
        own, at = ordered[chosen], order[chosen]
        del ordered, order
        entries = grams.entries(at)
        # Phrases that share a hash are told apart by their words.
        new = np.r_[True, own[1:] != own[:-1]][: len(own)]
        for e in entries:
            new[1:] |= e[1:] != e[:-1]
        head = np.flatnonzero(new)
        own, times = own[head], np.diff(np.r_[head, len(new)])
        langs, phrase = grams.strings([e[head] for e in entries])
        spelt = pa.table({"lang": langs, "phrase": phrase, "f": pa.array(times, pa.int64())})
        rows = [
            (b, ch.pack_rows(spelt.slice(s.start, s.stop - s.start))) for b, s in ch.bucket_slices(own, buckets)
        ]
        tidy()
        return pa.Table.from_batches([_messages(rows, ["bucket", "rows"], [pa.int32(), pa.binary()])])

    def add_up(group: pa.Table) -> pa.Table:
        spelt = pa.concat_tables([ch.unpack_rows(x) for x in group.column("rows").to_pylist()])
        counted = spelt.group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
        counted = counted.filter(pc.greater_equal(counted.column("f_sum"), least))
        tidy()
        return pa.table([counted.column(x) for x in ("lang", "phrase", "f_sum")], names=["lang", "phrase", "f"]).cast(
            pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
        )

    sent = words.select("chunk", "rows").mapInArrow(send, "bucket int, chunk long, hashes binary, times binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, rows binary")
    both = words.select("chunk", F.lit(-1).alias("bucket"), "rows").unionByName(answers)
    spelt = both.groupBy("chunk").applyInArrow(spell, "bucket int, rows binary")
    return spelt.groupBy("bucket").applyInArrow(add_up, "lang string, phrase string, f long")


def _stream_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Annotate one sorted partition: prefix counts from the stack, extension maxima.

    Rows of length 1 only feed the stack. A row of length 2 is held until the rows
    that extend it have passed. Extensions of a 2-word key not in this partition are
    passed on as one ``ext`` row.
    """
    last1 = last2 = None  # (lang, key, f) of the latest key of that length
    held = None  # [lang, key, f, p1, p2, ext] of the latest 2-word key
    orphan = None  # [lang, key, ext] for extensions whose key lies in an earlier partition
    out: dict[str, list] = {c: [] for c in ("lang", "key", "f", "p1", "p2", "ext", "kind")}

    def emit(lang, key, f, p1, p2, ext, kind):
        for c, v in zip(out, (lang, key, f, p1, p2, ext, kind)):
            out[c].append(v)

    def flushed():
        batch = pa.RecordBatch.from_pydict(
            out,
            schema=pa.schema(
                [("lang", pa.string()), ("key", pa.list_(pa.string()))]
                + [(c, pa.int64()) for c in ("f", "p1", "p2", "ext")]
                + [("kind", pa.string())]
            ),
        )
        for v in out.values():
            v.clear()
        return batch

    for batch in batches:
        for lang, key, f in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "f"))):
            m = len(key)
            p1 = last1[2] if last1 and last1[0] == lang and last1[1] == key[:1] else None
            if m == 1:
                last1, last2 = (lang, key, f), None
                continue
            if m == 2:
                if held:
                    emit(*held, "gram")
                held = [lang, key, f, p1, None, None]
                last2 = (lang, key, f)
                continue
            parent = key[:2]
            p2 = last2[2] if last2 and last2[0] == lang and last2[1] == parent else None
            if held and held[0] == lang and held[1] == parent:
                held[5] = f if held[5] is None else max(held[5], f)
            elif orphan and orphan[0] == lang and orphan[1] == parent:
                orphan[2] = max(orphan[2], f)
            else:
                if orphan:
                    emit(orphan[0], orphan[1], None, None, None, orphan[2], "ext")
                orphan = [lang, parent, f]
            emit(lang, key, f, p1, p2, None, "gram")
        if out["lang"]:
            yield flushed()
    if held:
        emit(*held, "gram")
    if orphan:
        emit(orphan[0], orphan[1], None, None, None, orphan[2], "ext")
    if out["lang"]:
        yield flushed()


def annotated(kept: DataFrame, reverse: bool) -> DataFrame:
    """Kept phrases with the counts of their first (or last) one and two words.

    ``key`` is the words in stream order; ``p1``/``p2`` are the counts of its first one
    and two keys, ``ext`` the largest count of a phrase that extends it at the end.
    """
    words = F.split("phrase", " ")
    stream = kept.select("lang", (F.reverse(words) if reverse else words).alias("key"), "f")
    passed = saved(stream.orderBy("lang", "key").mapInArrow(_stream_pass, STREAM), "phrases-stream")
    grams_, ends = passed.where("kind = 'gram'"), passed.where("kind = 'ext'")
    # At most one ext row and two missing prefixes a partition of the stream.
    ends = ends.groupBy("lang", "key").agg(F.max("ext").alias("_ext"))
    lacking = grams_.where("p1 IS NULL").select("lang", F.slice("key", 1, 1).alias("key")).unionByName(
        grams_.where("size(key) = 3 AND p2 IS NULL").select("lang", F.slice("key", 1, 2).alias("key"))
    ).distinct()
    found = lacking.join(stream.withColumnRenamed("f", "_f"), ["lang", "key"])
    one = found.where("size(key) = 1").select(F.col("lang").alias("_l1"), F.col("key").alias("_k1"), F.col("_f").alias("_f1"))
    two = found.where("size(key) = 2").select(F.col("lang").alias("_l2"), F.col("key").alias("_k2"), F.col("_f").alias("_f2"))
    fixed = (
        grams_.join(F.broadcast(ends), ["lang", "key"], "left")
        .join(F.broadcast(one), (F.col("lang") == F.col("_l1")) & (F.slice("key", 1, 1) == F.col("_k1")), "left")
        .join(F.broadcast(two), (F.col("lang") == F.col("_l2")) & (F.slice("key", 1, 2) == F.col("_k2")), "left")
    )
    return fixed.select(
        "lang",
        F.array_join(F.reverse("key") if reverse else F.col("key"), " ").alias("phrase"),
        F.size("key").alias("m"),
        F.col("f"),
        F.coalesce("p1", "_f1").alias("p1"),
        F.coalesce("p2", "_f2").alias("p2"),
        F.greatest("ext", "_ext").alias("ext"),
    )


def score(a: str, l: str, r: str) -> Column:
    """floor(1e6 * a * a / (l * r)) of three long columns, exact in decimal(38, 0)."""
    big = [f"CAST(`{c}` AS DECIMAL(38,0))" for c in (a, l, r)]
    return F.expr(f"({big[0]} * {big[0]} * CAST(1000000 AS DECIMAL(38,0))) div ({big[1]} * {big[2]})")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    least: int = 10,
    longest: int = 3,
    top: int = 2000,
) -> DataFrame:
    """Per language the ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    if longest != 3:
        raise ValueError("the streams hold prefixes of one and two words: longest is 3")
    words = _number_words(df, text, lang, CHUNK_BYTES)
    each = words.select(F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("totals").alias("n"))))
    totals = each.groupBy("lang").agg(F.sum("n").alias("n"))
    kept = saved(frequent(words, least, HASH_BITS), "phrases-counts")
    left = annotated(kept, reverse=False).where("m >= 2")
    right = annotated(kept, reverse=True).where("m >= 2").select(
        "lang", "phrase", F.col("p1").alias("r1"), F.col("p2").alias("r2"), F.col("ext").alias("lext")
    )
    both = left.hint("merge").join(right, ["lang", "phrase"])
    a = F.col("f")
    two = F.col("m") == 2
    l1, l2, r1, r2 = F.col("p1"), F.col("p2"), F.col("r1"), F.col("r2")
    s_first = F.when(two, score("f", "p1", "r1")).otherwise(score("f", "p1", "r2"))
    s_second = F.when(two, F.lit(None).cast("long")).otherwise(score("f", "p2", "r1"))
    first_wins = s_second.isNull() | (s_first <= s_second)
    longer = F.greatest("ext", "lext")
    chosen = both.where(~(two & longer.isNotNull() & (2 * longer >= a))).select(
        "lang",
        "phrase",
        a.alias("a"),
        F.when(first_wins, l1).otherwise(l2).alias("l"),
        F.when(first_wins, F.when(two, r1).otherwise(r2)).otherwise(r1).alias("r"),
        F.when(first_wins, s_first).otherwise(s_second).alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"),
        F.col("r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"),
        F.col("score").cast("long").alias("score"),
    )
