"""One query per corpus operator, over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from periodica.llm import (
    decontamination,
    exact_dedup,
    importance_resampling,
    jaccard_join,
    license_scan,
    packing,
    pii_scan,
    secret_scan,
    simhash_golay,
    spelling_variants,
    substring_dedup,
    toxicity,
    url_filter,
)
from periodica.session import table

URL_RULES = url_filter.UrlRules(
    rules=(
        ("allow", "com/"),
        ("block", "example.com/en/"),
        ("allow", "www.example.com/en/"),
        ("block", "net/es/"),
        ("block", "net/fr/"),
    )
)


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.Index:
    """Learn from labelled rows outside the held-out fifth."""
    return toxicity.fit(docs, labels.where(~toxicity.held_out(labels["doc_id"])))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    index = fit_toxicity(docs, table(spark, folder, "labels"))
    scored = toxicity.score_texts(docs, index)
    return scored.select("doc_id", toxicity.held_out(scored["doc_id"]).alias("held_out"), "score", "predicted", "vote", "evidence")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.cut_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_pii_scan(spark: SparkSession, folder: str) -> DataFrame:
    return pii_scan.scan_pii(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op11_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_golay.simhash_components(table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_url_filter,
        op3_decontamination,
        op4_substring_dedup,
        op5_secret_scan,
        op6_exact_dedup,
        op7_packing,
        op8_pii_scan,
        op9_license_scan,
        op10_jaccard_join,
        op11_simhash_dedup,
        op12_importance_resampling,
        op13_spelling_variants,
    )
}
