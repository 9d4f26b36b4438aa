"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from facetlake.llm import bpe, ctw, exact_dedup, license_scan, nbsvm, packing, pii, quality_rules, sentence_spans, simhash, suffix_dedup, word_runs
from facetlake.llm.text import documents, labels


def op1_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(documents(spark, sf_dir))


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.span_dedup(documents(spark, sf_dir), run_words=sentence_spans.RUN)


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir)).drop("failed_rule")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return nbsvm.score_quality(docs, nbsvm.train(docs, labels(spark, sf_dir)))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.substring_dedup(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.word_runs(documents(spark, sf_dir), stretch=True)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan_licenses(documents(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": quality_rules.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE}
