"""Schema contracts, differences and reconciliation. No data is read by any of these."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

SCHEMA_MODES = ("ignore", "fail", "append_new_columns", "sync_all_columns")

# Types in the order in which each one fits without loss into those after it.
WIDENING = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.FloatType(), T.DoubleType()],
]


class SchemaMismatch(ValueError):
    """Declared and actual columns do not agree."""


@dataclass(frozen=True)
class ColumnChange:
    column_name: str
    change: str
    source_type: str | None
    target_type: str | None


def find(schema: T.StructType, name: str) -> T.StructField | None:
    """Field by name, ignoring case as Spark does."""
    return next((f for f in schema if f.name.lower() == name.lower()), None)


def typed_null(data_type: T.DataType | str, name: str) -> Column:
    return F.lit(None).cast(data_type).alias(name)


def typed_nulls(columns: Mapping[str, str] | T.StructType) -> list[Column]:
    """One typed NULL per declared column."""
    if isinstance(columns, T.StructType):
        return [typed_null(f.dataType, f.name) for f in columns]
    return [typed_null(kind, name) for name, kind in columns.items()]


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with the same columns; the optimizer drops the scan."""
    return df.where(F.lit(False))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the schema's order: missing ones as typed NULL, extra ones dropped."""
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if find(df.schema, f.name)
            else typed_null(f.dataType, f.name)
            for f in schema
        ]
    )


def contract_changes(actual: T.StructType, declared: T.StructType) -> list[ColumnChange]:
    """Every column with its verdict: ok, type mismatch, missing or undeclared."""
    rows = []
    for field in declared:
        found = find(actual, field.name)
        if not found:
            rows.append(ColumnChange(field.name, "missing", None, field.dataType.simpleString()))
            continue
        kinds = (found.dataType.simpleString(), field.dataType.simpleString())
        rows.append(ColumnChange(field.name, "ok" if kinds[0] == kinds[1] else "type mismatch", *kinds))
    for field in actual:
        if not find(declared, field.name):
            rows.append(ColumnChange(field.name, "undeclared", field.dataType.simpleString(), None))
    return rows


def enforce_contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The declared columns in declared order, or an error that lists both sides."""
    rows = contract_changes(df.schema, declared)
    if not len(declared) or any(r.change != "ok" for r in rows):
        listing = "; ".join(
            f"{r.column_name}: declared {r.target_type}, actual {r.source_type} ({r.change})" for r in rows
        )
        raise SchemaMismatch(f"contract not met: {listing or 'no columns declared'}")
    return df.select(*[F.col(f.name) for f in declared])


def fits_into(narrow: T.DataType, wide: T.DataType) -> bool:
    if narrow == wide:
        return True
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        whole = narrow.precision - narrow.scale <= wide.precision - wide.scale
        return whole and narrow.scale <= wide.scale
    for family in WIDENING:
        if narrow in family and wide in family:
            return family.index(narrow) <= family.index(wide)
    return False


def schema_changes(source: T.StructType, target: T.StructType) -> list[ColumnChange]:
    """Columns added, removed or retyped by the source; a type the target can hold is no change."""
    rows = []
    for field in source:
        held = find(target, field.name)
        if not held:
            rows.append(ColumnChange(field.name, "added", field.dataType.simpleString(), None))
        elif not fits_into(field.dataType, held.dataType):
            kinds = (field.dataType.simpleString(), held.dataType.simpleString())
            rows.append(ColumnChange(held.name, "retyped", *kinds))
    for field in target:
        if not find(source, field.name):
            rows.append(ColumnChange(field.name, "removed", None, field.dataType.simpleString()))
    return rows


def changes_with_counts(df: DataFrame, changes: Sequence[ColumnChange]) -> DataFrame:
    """The changes as rows, each with the number of values the column holds in ``df``.

    One scan counts all columns; the counts are turned into rows by position, so nothing but one
    row leaves the aggregate.
    """
    entries = [
        F.struct(
            F.lit(c.column_name).alias("column_name"),
            F.lit(c.change).alias("change"),
            F.lit(c.source_type).cast("string").alias("source_type"),
            F.lit(c.target_type).cast("string").alias("target_type"),
            (
                F.count(F.col(c.column_name)) if find(df.schema, c.column_name) else F.lit(0).cast("bigint")
            ).alias("n_values"),
        )
        for c in changes
    ]
    return df.agg(F.array(*entries).alias("_rows")).select(F.inline("_rows"))


def alter_column_type(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """Column recast in place, keeping its position."""
    return df.withColumn(column, F.col(column).cast(data_type))


def checked_mode(mode: str, default: str = "ignore") -> str:
    if mode in SCHEMA_MODES:
        return mode
    logger.warning("invalid schema change mode %r, using %r", mode, default)
    return default


def reconcile(target: DataFrame, source: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Bring an incremental target and its source to schemas that a strategy can combine.

    ignore: the target's columns stand, new source columns are left out and a column the source
    lacks is an error. append_new_columns: the target gains new columns. sync_all_columns: it also
    loses removed ones and takes new types. fail: any change is an error.
    """
    mode = checked_mode(mode)
    changes = schema_changes(source.schema, target.schema)
    if mode == "ignore":
        absent = [c.column_name for c in changes if c.change == "removed"]
        if absent:
            raise SchemaMismatch(f"source lacks target columns: {absent}")
        return target, source.select(*target.columns)
    if mode == "fail" and changes:
        raise SchemaMismatch(f"source and target schemas are out of sync: {changes}")
    added = [c for c in changes if c.change == "added"]
    if mode == "sync_all_columns":
        target = target.drop(*[c.column_name for c in changes if c.change == "removed"])
        for change in (c for c in changes if c.change == "retyped"):
            target = alter_column_type(target, change.column_name, change.source_type)
    target = target.select("*", *[typed_null(c.source_type, c.column_name) for c in added])
    return target, source
