"""Questions asked of a finished mart: sums per month, leaders, profile, freshness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def monthly_sum(df: DataFrame, entity: str, date: str, value: str, output: str) -> DataFrame:
    """Sum per entity and calendar month."""
    return df.groupBy(entity, F.trunc(date, "MM").alias("month")).agg(F.sum(value).alias(output))


def latest_rows(df: DataFrame, date: str) -> DataFrame:
    """Rows of the newest date; the maximum is a scalar subquery that can reach the scan."""
    return df.where(F.col(date) == df.select(F.max(date)).scalar())


def top_entities(df: DataFrame, entity: str, date: str, value: str, n: int) -> DataFrame:
    """The whole history of the ``n`` entities that lead at the newest date, ties by name."""
    leaders = latest_rows(df, date).orderBy(F.col(value).desc_nulls_last(), entity).select(entity).limit(n)
    return df.join(leaders, entity, "left_semi")


def profile(df: DataFrame, entity: str, date: str, top_n: int) -> DataFrame:
    """Row count, entity count and date range in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(entity).alias("entities"),
        F.min(date).alias("month_start"),
        F.max(date).alias("month_end"),
        F.lit(top_n).alias("top_n"),
    )


def freshness(df: DataFrame, loaded_at: str, now, condition: str | Column | None = None) -> DataFrame:
    """Newest load time beside the time of the check."""
    rows = df if condition is None else df.where(condition)
    return rows.agg(
        F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"),
        F.lit(now).cast("timestamp_ntz").alias("snapshotted_at"),
    )


def freshness_of_query(times: DataFrame, now) -> DataFrame:
    """Freshness from a query that already returns the newest load time."""
    first = times.columns[0]
    return times.select(
        F.col(first).cast("timestamp_ntz").alias("max_loaded_at"),
        F.lit(now).cast("timestamp_ntz").alias("snapshotted_at"),
    )


def array_agg(df: DataFrame, keys: Sequence[str], value: str, output: str) -> DataFrame:
    """All values of a group as a sorted array, repeats kept, NULLs first.

    Equal values are counted before they are moved, so a large group travels as its distinct values; the
    array itself holds the whole group and callers group values of bounded number.
    """
    counted = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    ordered = F.array_sort(F.collect_list(F.struct("_value", "_n")))
    repeated = F.transform(ordered, lambda e: F.array_repeat(e["_value"], e["_n"]))
    return counted.groupBy(*keys).agg(F.flatten(repeated).alias(output))


def joined_text(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order_by: str,
    delimiter: str,
    output: str,
    limit: int | None = None,
) -> DataFrame:
    """Values of a group joined in order, optionally only the first ``limit`` of them.

    With a limit, rows past it are cut before the shuffle, so a large group never travels whole.
    Without one the text itself holds the whole group; callers group values of a bounded domain.
    """
    if limit is None:
        text = F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(order_by).alias("o"), F.col(value).alias("v")))),
                lambda e: e["v"],
            ),
            delimiter,
        )
        return df.groupBy(*keys).agg(text.alias(output))
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order_by, value))
    first = df.withColumn("_rank", rank).where(F.col("_rank") <= limit)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("_rank").alias("o"), F.col(value).alias("v"))))
    return first.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda e: e["v"]), delimiter).alias(output)
    )
