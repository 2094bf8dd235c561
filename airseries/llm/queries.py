"""The registered queries of the training-data operators, each next to its DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airseries.llm import (
    alignment,
    decontaminate,
    hard_negatives,
    line_dedup,
    lm_score,
    packing,
    quality_model,
    quality_rules,
    secret_scan,
    simhash,
    sql,
    substring_dedup,
    token_counts,
    url_filter,
)
from airseries.llm.common import reach_workers, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.document_scores(table(spark, sf_dir, "documents"), depth=6)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_digest(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged_pages(spark, table(spark, sf_dir, "pages"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.masked_counts(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"))


def _reaching(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    registered = {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_url_filters": op3_url_filters,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_packing": op5_packing,
        "op6_quality_rules": op6_quality_rules,
        "op7_token_counts": op7_token_counts,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_simhash": op9_simhash,
        "op10_line_dedup": op10_line_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_secret_scans": op12_secret_scans,
        "op13_tokenizer_alignment": op13_tokenizer_alignment,
    }
    return {name: _reaching(query) for name, query in registered.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": sql.SUBSTRING_DEDUP,
        "op3_url_filters": sql.URL_FILTERS,
        "op4_benchmark_decontamination": sql.DECONTAMINATION,
        "op10_line_dedup": sql.LINE_DEDUP,
        "op11_hard_negatives": sql.HARD_NEGATIVES,
    }
