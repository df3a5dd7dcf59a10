"""Incremental runs on partitioned tables: a run reads and writes the partitions it changes, and no others.

1. The partitions a run touches are those of the target rows that the strategy may change or drop, and those of
   its source rows. The former are found with keys, predicate and partition columns only; where the merge key holds
   the partition columns, or the source is just added, the target is not read at all.
2. The strategy is applied to the touched partitions, read with a filter that prunes all others.
3. The result replaces these partitions by dynamic overwrite: rows are staged beside the table and moved in when all
   tasks are done. Touched partitions that are left without rows are emptied and dropped.

A plain append adds files and touches nothing. New columns are added to the table's columns; removed or retyped columns
and whole-table replacement rebuild the table. Only the names of touched partitions reach the driver, where Spark keeps
the partitions of a table anyway. A failed run leaves the table as it was, unless it fails while partitions are moved
in; merge, delete_insert and the replacing strategies can then simply be run again. Partition columns keep their declared type
(text such as ``01`` stays text), and NULL is a partition of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.operators import incremental
from periodica.operators.joins import rows_with
from periodica.operators.schema import find, reconcile, schema_changes


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns_ddl(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def literal(value) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]


def partitions_of(rows: DataFrame, partition_by: Sequence[str]) -> set[Row]:
    """The partitions that ``rows`` fall into; sets of them are merged, and one row leaves the aggregate."""
    return set(rows.agg(F.collect_set(F.struct(*partition_by)).alias("found")).first()["found"])


def in_partitions(schema: T.StructType, partition_by: Sequence[str], wanted: set[Row]) -> Column:
    """Condition over partition columns alone, so that it prunes the scan; NULL is equal to NULL here."""
    kinds = [find(schema, c).dataType for c in partition_by]
    values = [F.struct(*[F.lit(v).cast(k) for v, k in zip(row, kinds, strict=True)]) for row in wanted]
    return F.struct(*partition_by).isin(values) if values else F.lit(False)


def only_adds(strategy: str, options: dict) -> bool:
    """Does the strategy leave every target row as it is?"""
    return strategy == "append" or (strategy in ("merge", "delete_insert") and not options.get("keys"))


def rows_at_risk(strategy: str, target: DataFrame, source: DataFrame, options: dict) -> DataFrame:
    """The target rows that a strategy may change or drop; only those columns are read that decide it."""
    predicate = options.get("predicate")
    if strategy == "microbatch":
        moment = F.col(options["event_time"])
        in_slice = (moment >= F.lit(options["start"])) & (moment < F.lit(options["end"]))
        return target.where(in_slice if predicate is None else in_slice & predicate)
    held = target if predicate is None else target.where(predicate)
    return held if strategy == "insert_overwrite" else rows_with(held, source, options["keys"])


def touched_partitions(
    strategy: str, target: DataFrame, source: DataFrame, partition_by: Sequence[str], options: dict
) -> set[Row]:
    """Partitions whose rows the run may change, drop or add to."""
    touched = partitions_of(incremental.align(source, target), partition_by)
    keys = {k.lower() for k in options.get("keys") or []}
    stays = strategy in ("merge", "delete_insert") and {c.lower() for c in partition_by} <= keys
    return touched if stays else touched | partitions_of(rows_at_risk(strategy, target, source, options), partition_by)


def evenly(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together in few files; a partition with very many rows is split over tasks."""
    return rows.hint("rebalance", *partition_by)


def replace_partitions(spark: SparkSession, name: str, rows: DataFrame, touched: set[Row]) -> None:
    """Let ``rows`` be all there is in the ``touched`` partitions of a table. They may be read from it."""
    partition_by = partition_columns(spark, name)
    seen = Observation()
    (
        evenly(rows, partition_by)
        .observe(seen, F.collect_set(F.struct(*partition_by)).alias("partitions"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(location(spark, name))
    )
    written = set(seen.get["partitions"])
    if written:
        specs = " ".join(_spec(partition_by, row) for row in written)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    rest = [f for f in spark.table(name).schema if f.name not in partition_by]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in rest)
    for row in touched - written:
        spec = _spec(partition_by, row)
        spark.sql(f"INSERT OVERWRITE TABLE {name} {spec} SELECT {nothing} WHERE 1 = 0")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(name)


def _spec(partition_by: Sequence[str], row: Row) -> str:
    cells = ", ".join(f"{quoted(c)} = {literal(v)}" for c, v in zip(partition_by, row, strict=True))
    return f"PARTITION ({cells})"


def append_rows(spark: SparkSession, name: str, source: DataFrame) -> None:
    """Add files to a table; columns that the source lacks are NULL."""
    held = spark.table(name)
    rows = incremental.align(source, held)
    partition_by = partition_columns(spark, name)
    if partition_by:
        rows = evenly(rows, partition_by)
    rows.write.insertInto(name)
    spark.catalog.refreshTable(name)


def run_in_place(
    spark: SparkSession, name: str, source: DataFrame, strategy: str, on_schema_change: str, options: dict
) -> bool:
    """Apply a strategy to the partitions it touches. False when the table has to be rebuilt instead."""
    target = spark.table(name)
    partition_by = partition_columns(spark, name)
    if not (partition_by or only_adds(strategy, options)):
        return False
    if strategy == "insert_overwrite" and options.get("predicate") is None:
        return False
    fitted, source = reconcile(target, source, on_schema_change)
    if any(c.change != "added" for c in schema_changes(fitted.schema, target.schema)):
        return False
    added = [f for f in fitted.schema if not find(target.schema, f.name)]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl(added)})")
        target = spark.table(name)
    if only_adds(strategy, options):
        append_rows(spark, name, source)
        return True
    touched = touched_partitions(strategy, target, source, partition_by, options)
    if touched:
        held = target.where(in_partitions(target.schema, partition_by, touched))
        replace_partitions(spark, name, incremental.STRATEGIES[strategy](held, source, **options), touched)
    return True
