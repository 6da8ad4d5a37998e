"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontaminate, language_model, mixing, ngram_join, quality, resampling, secrets, simhash,
               token_alignment, toxicity, urls, warc)
from .common import read_table

#: Folder of the public tokenizers' files, on every machine.
TOKENIZERS = "/opt/tokenizers"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    return quality.judge(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.default_rules(pages))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(*chat.pack(chat.with_extra(read_table(spark, sf_dir, "conversations"))))


def op9_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judge(docs, read_table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, read_table(spark, sf_dir, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_secret_scans": op2_secret_scans,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_language_model": op6_language_model,
    "op7_url_filters": op7_url_filters,
    "op8_chat_format": op8_chat_format,
    "op9_weighted_fair_mix": op9_weighted_fair_mix,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE: dict[str, str] = {
    "op5_warc": warc.ORACLE,
    "op7_url_filters": urls.ORACLE,
    "op9_weighted_fair_mix": mixing.ORACLE,
}
