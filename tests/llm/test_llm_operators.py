"""Each operator against a plain form or the library on small inputs."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from brute import alignment, components, repeated_bytes, repeated_words
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from starflow.llm import (
    chunks,
    decontaminate,
    licenses,
    pieces,
    simhash,
    substring,
    suffix,
    token_counts,
    token_files,
    tokens,
    warc,
)
from starflow.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
BYTE, WORD, PIECE = map(
    public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")
)
ODD_TEXTS = [
    "",
    " ",
    "a\x1cb \x1f!\x1d.",
    "x\x85y\xa0z w　 q",
    "\n\n  b \r\n c  ",
    "don't we'll, x's 'tis",
    "<|endoftext|> hi<|endoftext|>. <|ENDOFTEXT|> <|startoftext|>b",
    "é ́a Å ß İ Σς ΑΣ ﬁ ǅ ŉ",
    "!!\n!! ..\t. 123 ab12 １２３",
    "日本語 テスト。 🙂🙂 ok a▁b",
    "x" * 300 + "    y" + " " * 40,
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def small_chunks(monkeypatch):
    """Many chunks and buckets, so that answers cross both."""
    monkeypatch.setattr(chunks, "HASHES_IN_BUCKET", 500)
    monkeypatch.setattr(chunks.to_chunks, "__defaults__", (1_500,))


def copies(units, join, pieces_of):
    rnd = random.Random(3)
    source = [rnd.choice(units) for _ in range(4000)]
    found = [(5000, None), (5001, "")]
    for i in rnd.sample(range(1000), 120):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            k = rnd.randint(0, 3900)
            parts += source[k : k + rnd.randint(1, pieces_of)]
        found.append((i, join.join(parts)))
    return found


@pytest.mark.parametrize("window", [2, 3, 10])
def test_repeated_words(spark, small_chunks, window):
    rows = copies("abcd", " ", 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring.repeated_words(df, window=window).collect()
    assert sorted(map(tuple, got)) == repeated_words(rows, window)


@pytest.mark.parametrize("length, hot", [(20, 200_000), (33, 200_000), (33, 3)])
def test_repeated_bytes(spark, small_chunks, monkeypatch, length, hot):
    monkeypatch.setattr(suffix, "HOT_RUNS", hot)
    rows = [*copies("abcdé ", "", 200), (7000, "x" * 300), (7001, "y" + "x" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix.repeated_bytes(df, length=length).collect()
    assert sorted(map(tuple, got)) == repeated_bytes(rows, length)


def test_run_index_gives_the_least_document_of_each_match():
    rnd = random.Random(5)
    strings = sorted({bytes(rnd.choice(b"ab") for _ in range(rnd.randint(9, 30))) for _ in range(300)})
    rows = np.zeros((len(strings), 32), np.uint8)
    for k, s in enumerate(strings):
        rows[k, : len(s)] = np.frombuffer(s, np.uint8) + 1
    owner = np.array([rnd.randrange(1000) for _ in strings])
    index = suffix.RunIndex(rows, owner, 9)
    assert len(index.head) < index.n
    other = np.zeros((1, 32), np.uint8)
    other[0, :13] = np.frombuffer(b"abzabbabaaabz", np.uint8) + 1
    found = index.least_documents(np.concatenate([rows, other]))
    for k, s in enumerate([*strings, b"abzabbabaaabz"]):
        for p in range(len(s) - 8):
            has = [owner[j] for j, t in enumerate(strings) if s[p : p + 9] in t]
            assert found[k, p] == (min(has) if has else substring.NO_ID)


def test_fingerprint_by_its_definition():
    for text in ("A b  C d\nb c d É", "One two", "x"):
        words = "".join(c.lower() if c.isascii() else c for c in text).split()
        n = max(1, len(words) - 2)
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), seed=42) for i in range(n)]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("shard", [4, 100])
def test_linked_fingerprints(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "BLOCK_PAIRS", 64)
    rnd = random.Random(1)
    points = {0, 1, 3, *(rnd.getrandbits(64) for _ in range(150))}
    for p in list(points)[:60]:
        points |= {p ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for _ in range(3)}
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    edges = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), 2)
    got = {r.node: r.root for r in connected_components(edges).collect()}
    groups, want = {}, {}
    for p in signed:
        groups.setdefault(got.get(p, p), set()).add(p % (1 << 64))
    for p, root in components(points, 2).items():
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_of_whole_table(documents):
    rows = documents.collect()
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in rows}
    roots, least = components(set(prints.values()), 2), {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    got = simhash.near_duplicates(documents).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {
        i: (p, least[roots[p]]) for i, p in prints.items()
    }


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)]
    df = spark.createDataFrame(chain, "u long, v long")
    got = {r.node: r.root for r in connected_components(df.union(df.select("v", "u"))).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)}


def test_alignment_scores():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))]
        b = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 15))]
        assert decontaminate.smith_waterman(np.array(a), np.array(b)) == alignment(a, b)


@pytest.mark.parametrize("block_words", [30, 1 << 20])
def test_edited_copies_are_found_and_clean_text_is_not(spark, documents, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    rnd = random.Random(1)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").limit(8)
    clean = documents.where("lang <> 'en'").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in clean if not any(i.text in r.text for i in items.collect())]
    for item in items.collect():
        words = []
        for w in item.text.split():
            drawn = rnd.random()
            words += ["zz"] if drawn < 0.1 else [] if drawn < 0.15 else [w.upper()]
        rows.append((100_000 + item.item_id, " ".join(["Der Text davor,", *words, "und danach."])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, items).collect()}
    want = {(100_000 + r.item_id, r.item_id) for r in items.collect()}
    assert want <= found and {d for d, _ in found} == {d for d, _ in want}
    kept = {r.doc_id for r in decontaminate.drop_leaks(df, items).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in want}


@pytest.mark.parametrize("copies_of_it", [4, 3_000])
def test_many_equal_edited_copies_beside_a_verbatim_one_are_found(spark, copies_of_it):
    item = [f"w{k}" for k in range(40)]
    edited = ["zz" if k % 7 == 6 else w for k, w in enumerate(item)]
    assert alignment(item, edited) >= 0.8 * 2 * len(item)
    rows = [(0, " ".join(item))] + [(k, " ".join(edited)) for k in range(1, copies_of_it + 1)]
    df = spark.createDataFrame([*rows, (-1, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(df, items).collect()} == {d for d, _ in rows}
    assert [r.doc_id for r in decontaminate.drop_leaks(df, items).collect()] == [-1]


def test_copies_with_a_quarter_of_the_words_replaced_are_found():
    rnd = random.Random(9)
    items = [[f"i{i}w{k}" for k in range(15 + i % 6)] for i in range(400)]
    words = [decontaminate.hash_documents([" ".join(x).encode()])[0] for x in items]
    block = decontaminate.Block(list(range(len(items))), words)
    even = [["zz" if k % 4 == 3 else w for k, w in enumerate(x)] for x in items]
    drawn = [["zz" if rnd.random() < 0.25 else w for w in x] for x in items]
    for edited in (even, drawn):
        least = block.least(np.arange(len(items)), 0.5)
        want = {k for k, x in enumerate(edited) if alignment(items[k], x) >= least[k]}
        found = decontaminate._align([" ".join(["so", *x, "on"]) for x in edited], block, 0.5)
        got = {k for k, scores in found if k in scores}
        assert len(want) > 300 and got <= want and len(want - got) <= 0.005 * len(want)
        # Only copies without three words in a row are lost.
        assert all(max(len(r.split()) for r in " ".join(edited[k]).split("zz")) < 3 for k in want - got)


@pytest.mark.parametrize("size", range(2, 17))
def test_only_items_below_eight_words_must_match_wholly(size):
    item = [f"w{k}" for k in range(size)]
    block = decontaminate.Block([1], [decontaminate.hash_documents([" ".join(item).encode()])[0]])
    edited = [*item[:-2], "zz", item[-1]]
    found = [k for k, _ in decontaminate._align([" ".join(item), " ".join(edited)], block, 0.5)]
    assert found == ([0, 1] if size >= 8 else [0])


def test_documents_that_share_only_common_phrases_align_as_without_bounds():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    items = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 25))) for _ in range(20)]
    words = [decontaminate.hash_documents([t.encode()])[0] for t in items]
    block = decontaminate.Block(list(range(20)), words)
    got = {(k, i): s for k, found in decontaminate._align(texts, block, 0.5) for i, s in found.items()}
    plain = {}
    for k, text in enumerate(texts):
        for i, item in enumerate(items):
            own, other = item.split(), text.split()
            width = min(decontaminate.GRAM, len(own))
            grams = {tuple(own[p : p + width]) for p in range(len(own) - width + 1)}
            if any(tuple(other[p : p + width]) in grams for p in range(len(other) - width + 1)):
                best = alignment(own, other) / (2 * len(own))
                if best * 2 * len(own) >= block.least(np.array([i]), 0.5)[0]:
                    plain[k, i] = best
    assert len(plain) > 100 and got.keys() <= plain.keys()
    assert all(got[x] <= plain[x] for x in got) and len(got) > 0.99 * len(plain)


def test_pieces_equal_the_library(documents):
    model = pieces.load(PIECE)
    texts = [*ODD_TEXTS, *(r.text for r in documents.collect())]
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == model.library.encode(text)
        assert model.decode(ids) == model.library.decode(ids.tolist())


def test_pieces_come_back_as_texts(documents):
    encoded = pieces.encode_documents(documents, PIECE)
    got = {r.doc_id: r.text for r in pieces.decode_ids(encoded, PIECE).collect()}
    assert got == {r.doc_id: r.text for r in documents.collect()}


@pytest.mark.parametrize("sizes", [(65_536, 1_024), (300, 40), (60, 20)])
def test_token_counts_equal_the_library(spark, documents, sizes):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + r.doc_id, r.text) for r in documents.limit(60).collect()]
    rows += [(90, "q" * 5_000), (91, "ab<|endoftext|>" * 200), (92, " " * 3_000 + "'re've" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_counts.count_tokens(df, BYTE, chunk_chars=sizes[0], overlap_chars=sizes[1])
    library = tokens.load(BYTE)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want


def test_token_files_equal_the_library(spark, documents, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 2_000)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + r.doc_id, r.text) for r in documents.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = token_files.token_files(df, WORD, end_id=2).orderBy("doc_id").collect()
    library, start = tokens.load(WORD), 0
    for (i, text), row in zip(sorted(rows), got, strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert tuple(row) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("high", [1, 2, 50_000, 1 << 32])
def test_segments_come_back(high):
    rng = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 3_000):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
        ids[::37] = min(high - 1, 7)
        payload = token_files.encode_segment(ids)
        assert (token_files.decode_segment(payload) == ids).all()
        if n == 3_000:
            assert (token_files.decode_segment(payload, 2, 5) == ids[256:640]).all()


def test_licence_texts(spark):
    mit = (
        "# MIT License\n#\n# Copyright (c) 2020 A. Person\n#\n# Permission is hereby granted, free of charge, to any "
        "person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal\n"
        "# in the Software without restriction, including without limitation the rights\n# to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell\n# copies of the Software, and to permit persons to whom "
        "the Software is\n# furnished to do so, subject to the following conditions:\n\n# The above copyright notice "
        "and this permission notice shall be included in all\n# copies or substantial portions of the Software.\n\n"
        "# THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n# IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n# FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    rows = [
        (1, mit),
        (2, "Text.\nLicensed under the Apache License, Version 2.0.\nMore.\nReleased under the MIT License."),
        (3, "A licence is a permission, and no sentence here is known."),
        (4, "SPDX-License-Identifier: GPL-3.0-or-later"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.rule, r.n_matches) for r in got) == [
        (1, "MIT", "text", 1),
        (2, "Apache-2.0", "notice", 1),
        (2, "MIT", "notice", 1),
        (4, "GPL-3.0", "notice", 1),
    ]
    assert set(licenses.known_sentences().values()) == set(licenses.SENTENCES)


def test_warc_records_link_and_files_hold_them(spark, tmp_path):
    page = "<title>T &amp; &#233;&#xE9;</title><script>x</script><p>One<br>two &lt;b&gt; <a href='/z'>z</a></p>"
    pages = spark.createDataFrame([(1, "http://a/b", page)], "page_id long, url string, html string")
    source = warc.responses(pages)
    records = {r.record_type: r for r in warc.derive(source).collect()}
    response = source.first()
    for r in records.values():
        assert r.refers_to == response.record_id and r.payload_digest == response.payload_digest
        assert r.content_length == len(r.block.encode())
        assert f"WARC-Refers-To: {response.record_id}\r\n" in r.header
    assert records["conversion"].block == "T & éé\nOne\ntwo <b> z"
    assert "title: T & éé\r\noutlink: /z\r\n" in records["metadata"].block
    assert records["conversion"].record_id in records["metadata"].header
    warc.write_warc(warc.derive(source).coalesce(1), str(tmp_path / "out"))
    text = "".join(r.value for r in spark.read.text(str(tmp_path / "out"), wholetext=True).collect())
    assert text.count("WARC/1.1\r\n") == 2
    assert all(r.header + r.block + "\r\n\r\n" in text for r in records.values())


@pytest.mark.parametrize("name", ["op3_license_scan", "op6_warc_derivatives", "op10_quality_rules"])
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got, want = queries()[name](spark, FOLDER), connection.sql(oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    left = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    index = [want.columns.index(c) for c in columns]
    assert left == sorted(repr(tuple(r[i] for i in index)) for r in want.fetchall())


def test_pipeline_runs_its_stages_in_order(spark):
    kept = queries()["pipeline"](spark, FOLDER)
    assert kept.where(~F.col("round_trip")).count() == 0
    found = {r.doc_id for r in kept.select("doc_id").collect()}
    good = {r.doc_id for r in queries()["op10_quality_rules"](spark, FOLDER).where("kept").collect()}
    leaked = {r.doc_id for r in queries()["op4_decontaminate"](spark, FOLDER).collect()}
    assert found and found <= good and not found & leaked
