"""The corpus pipeline: filters, deduplication, decontamination, and packing into training batches.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. ``run`` writes each
stage's rows to the cluster's shared folder and reads them back as the next stage's input, so a lost
executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from periodica.llm.queries import fit_toxicity
from periodica.operators.joins import rows_without
from periodica.session import table, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with a toxicity score under 0.5 stay."""
    index = fit_toxicity(docs, table(spark, folder, "labels"))
    judged = docs.withColumn("_judged", toxicity.score_column(docs, index))
    return judged.where(F.col("_judged.score") < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return rows_without(docs, exact_dedup.exact_groups(docs).where("not kept"), ["doc_id"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked texts the one with the smallest id stays."""
    return rows_without(docs, jaccard_join.jaccard_components(docs).where("component_id < doc_id"), ["doc_id"])


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without a passage of the benchmark stay."""
    found = decontamination.matches_column(docs, table(spark, folder, "benchmark"))
    return docs.withColumn("_found", found).where(F.size("_found") == 0).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The place of every remaining text in its padded batch."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack_batches),
]

# The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    rows = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
