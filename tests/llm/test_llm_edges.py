"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starflow.llm import (
    decontaminate,
    licenses,
    pieces,
    quality,
    simhash,
    substring,
    suffix,
    token_counts,
    token_files,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("chunk", "rows", "answer", "bucket", "fp", "keep", "row", "c", "at", "piece", "n_words", "round")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 4),
    (4, "one", "en", "a", 3),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (6, LONG, "en", "b", len(LONG)),
    (None, "the word of a text without an id", "en", "b", 9),
    (None, None, None, None, None),
    (7, "\x00 zero  é 日本 🙂 <|endoftext|>", "en", "b", 9),
]
OPERATORS = {
    "1": lambda d, s: substring.repeated_words(d),
    "1 texts": lambda d, s: substring.remove_repeated_words(d),
    "2": lambda d, s: simhash.near_duplicates(d),
    "2 rows": lambda d, s: simhash.keep_one_of_each(d),
    "3": lambda d, s: licenses.scan(d),
    "4": lambda d, s: decontaminate.leaks(d, s.createDataFrame([(1, "one"), (None, None)], "item_id long, text string")),
    "4 rows": lambda d, s: decontaminate.drop_leaks(d, s.createDataFrame([], "item_id long, text string")),
    "5": lambda d, s: pieces.encode_documents(d, public_tokenizers.path("piece_bpe_32k.model")),
    "6": lambda d, s: warc.derive(warc.responses(d, key="doc_id", url="source", html="text")),
    "7": lambda d, s: suffix.repeated_bytes(d),
    "8": lambda d, s: token_files.token_files(d, public_tokenizers.path("word_bpe_49k.json"), end_id=2),
    "9": lambda d, s: token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")),
    "10": lambda d, s: quality.measure(d),
    "10 rows": lambda d, s: quality.keep_good(d),
}
ROW_FOR_ROW = ("1", "1 texts", "2", "4 rows", "5", "7", "8", "9", "10")


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return rows.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    got = OPERATORS[name](odd, spark).collect()
    if name in ROW_FOR_ROW:
        assert len(got) == len(ROWS)
    if name in ("1", "7"):
        removed = sorted((r.doc_id, r.n_removed > 0) for r in got if r.doc_id in (5, 6))
        assert removed == [(5, False), (6, True), (6, True)]
    if name == "1 texts":
        assert {r.n_chars for r in got if r.doc_id == 6 and not r.text} == {len(LONG)}
        assert set(got[0].asDict()) == set(odd.columns)
    if name == "2":
        same = {r.doc_id: r.component_id for r in got}
        assert (same[1], same[2], same[3], same[5], same[6]) == (1, 1, 1, 5, 5)
        assert {r.component_id for r in got if r.doc_id is None} == {None, 1}
    if name == "2 rows":
        assert sorted(r.doc_id or 0 for r in got) == [0, 0, 1, 4, 5, 7]
    if name == "4":
        assert [(r.doc_id, r.item_id) for r in got] == [(4, 1)]
    if name == "5":
        assert all(r.round_trip for r in got)
    if name == "6":
        assert len(got) == 2 * len(ROWS) and not any(r.block is None for r in got)
    if name == "8":
        assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
    if name == "10":
        assert {r.doc_id: r.n_words for r in got if r.doc_id} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 30_000, 6: 30_000, 7: 6}


def test_unlike_documents_that_share_an_id_are_kept_each(spark):
    one, two, three = (" ".join(f"{x}{k}" for k in range(200)) for x in "abc")
    rows = [(1, two), (1, one), (1, one), (2, one), (3, two), (4, three), (None, one)]
    got = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, one), (1, one), (1, two), (4, three)]
    # The row of id 2 that is a near duplicate of id 1 does not stand for the other row of id 2.
    rows = [(1, two), (2, two), (2, three)]
    got = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, two), (2, three)]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA), spark).collect() == []


def test_every_stage_takes_odd_rows_and_keeps_the_columns(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for docs in (rows, rows.limit(0)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, str(tmp_path))
            if number < len(corpus_pipeline.STAGES) - 1:
                assert got.schema.names == rows.schema.names
                assert [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
            got.collect()
