"""Keeping one version per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.operators.joins import KEY, key_of


def latest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def keep_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, a NULL version losing to any other.

    ``latest_by`` has to end in a tie-breaker. The rank filter lets Spark limit each key to one
    row per task before the shuffle (WindowGroupLimit), so a key with very many versions sends at
    most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first(latest_by)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def attach_latest(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], value: str, output: str
) -> DataFrame:
    """All rows, each with its key's latest ``value``.

    The latest value comes from an aggregate, which combines inside each task, and is joined back;
    the adaptive skew join can split a hot key on the row side. Structs compare NULL parts as equal,
    so rows with a NULL key form a group as they do in a window.
    """
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(value), F.struct(*latest_by))[value].alias(output)
    )
    keyed = newest.select(key_of(keys).alias(KEY), output)
    return df.join(keyed, key_of(keys) == F.col(KEY), "inner").select(*df.columns, output)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
