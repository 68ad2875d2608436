"""Registered queries of the operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finsight.llm import (attention_lm, decontaminate, html_extract, langid, minhash, mixture_packing, packing, quality_ratio,
                          token_alignment, toxicity, url_filter, vector_codes, warc_revisit)
from finsight.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.report(table(spark, sf_dir, "pages"))


def op4_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ratio.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.report(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_packing.report(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_html_extraction, op3_warc_revisits, op4_quality_ratio, op5_url_filter, op6_minhash,
    op7_decontaminate, op8_language_id, op9_toxicity, op10_attention_lm, op11_vector_codes,
    op12_mixture_packing, op13_token_alignment)}
