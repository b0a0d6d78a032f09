"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import (
    decontaminate,
    licenses,
    merkle,
    phrases,
    pieces,
    quality,
    secrets,
    simhash,
    substring,
    suffix,
    token_counts,
    token_files,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_words(table(spark, folder, "documents"), window=50)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, most=2)


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_documents(table(spark, folder, "documents"), path)


def op6_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, folder, "pages")))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.repeated_bytes(table(spark, folder, "documents"), length=50)


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_files(table(spark, folder, "documents"), path, end_id=2)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measure(table(spark, folder, "documents"))


def op11_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), least=10, longest=3, top=2000)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower_every_fifth(df: DataFrame) -> dict[str, Column]:
    """Rows whose unsigned crc32 of the decimal doc_id is divisible by 5 get A-Z lowered."""
    chosen = F.crc32(df["doc_id"].cast("string")) % 5 == 0
    return {"text": F.when(chosen, F.translate(df["text"], UPPER, UPPER.lower())).otherwise(df["text"])}


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"), tamper=_lower_every_fifth)


def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_simhash": op2_simhash,
        "op3_license_scan": op3_license_scan,
        "op4_decontaminate": op4_decontaminate,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_warc_derivatives": op6_warc_derivatives,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_token_files": op8_token_files,
        "op9_token_counts": op9_token_counts,
        "op10_quality_rules": op10_quality_rules,
        "op11_phrase_mining": op11_phrase_mining,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_secret_scan": op13_secret_scan,
    }
