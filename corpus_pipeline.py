"""Documents to training ids in five stages, each one operator of ``starflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to
the shared folder and reads again as the next stage's docs. All but the last return
the columns of ``documents``.

1. quality: documents that the quality rules reject go.
2. near duplicates: of each SimHash component the document with the least id stays.
3. substring duplicates: words covered by a 50-word window that a document with a
   smaller id has go; a document left without words goes too.
4. decontamination: documents in which a benchmark item aligns go.
5. encoding: doc_id, n_tokens, ids and the round-trip check.

Null texts and empty ones fail the quality rules; columns beyond those of documents are
carried to stage 4; rows with a null id pass stage 2 as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import decontaminate, pieces, quality, simhash, substring
from starflow.llm.scratch import saved

MODEL = "piece_bpe_32k.model"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs, shingle=3, most=2)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = substring.remove_repeated_words(docs, window=50).where(F.trim("text") != "")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rest = rest.withColumn("n_chars", F.char_length("text").cast(kind))
    return rest


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, public_tokenizers.path(MODEL))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_duplicates", substring_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

# SQL expresses neither SimHash bits nor alignment nor piece merges: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
