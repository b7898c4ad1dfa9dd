"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (collocations, decontaminate, near_dups, packing, quality, quality_rules,
               secret_scan, sharding, spellings, suffixes, token_files, toxicity, url_rules)
from .common import read

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "round(posterior, 4) posterior")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "rule string, verdict string")
    return url_rules.filter_urls(read(spark, sf_dir, "pages"), rules)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"),
                                       read(spark, sf_dir, "benchmark"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_classes(read(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), (3, 1)
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels"), held), held)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read(spark, sf_dir, "documents"), (4, 2)
    return toxicity.score(docs, quality.train(docs, read(spark, sf_dir, "labels"), held), held)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(secret_scan.find_secrets(read(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_groups(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_url_filters, op3_suffix_dedup, op4_token_ids, op5_decontamination,
        op6_near_dedup, op7_packing, op8_toxicity, op9_quality_classifier, op10_sharding,
        op11_secret_scan, op12_collocations, op13_spelling_groups)}
