"""Incremental strategies as pure functions: (target, source) -> new target.

Join keys are compared with plain equality, so a NULL key never matches. With a small source no
target row moves; with a large one, target rows sit on the side of each join where a partition
filled by a hot key can be split (see ``joins``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.scalars import all_known
from periodica.operators.joins import KEY, key_of, new_rows, rows_without
from periodica.operators.schema import find, reconcile


def align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source in the target's columns and types; columns it lacks become NULL."""
    return source.select(
        *[
            (F.col(f.name) if find(source.schema, f.name) else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(align(source, target))


def update_columns(
    columns: Sequence[str], only: Sequence[str] | None = None, exclude: Sequence[str] | None = None
) -> list[str]:
    """Columns a merge updates: all, the listed ones, or all but the listed ones."""
    if only and exclude:
        raise ValueError("give either the columns to update or the columns to exclude, not both")
    if only:
        return list(only)
    unwanted = {c.lower() for c in exclude or []}
    return [c for c in columns if c.lower() not in unwanted]


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | None,
    only: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    predicate: Column | None = None,
    one_pass: bool = False,
) -> DataFrame:
    """Update matched target rows and insert the rest of the source.

    Without keys it is a plain insert. ``predicate`` is over target columns and part of the match:
    a target row it rejects is left alone and the source row is inserted beside it. A target row
    that matches several source rows raises an error when the result is computed.

    ``one_pass`` is for a source about as large as the target: target and source are shuffled once and
    meet in one join. It cannot split the rows of one key, of which the target should have few.
    """
    if not keys:
        return append(target, source)
    if one_pass:
        return _merge_in_one_pass(target, source, keys, only, exclude, predicate)
    names = source.columns
    matched_names = {c.lower() for c in update_columns(names, only, exclude)}
    eligible = predicate if predicate is not None else F.lit(True)

    # One row per source key with its number of rows; combined inside each task first.
    packed = (
        source.where(all_known(keys))
        .groupBy(*keys)
        .agg(F.first(F.struct(*names)).alias("_source"), F.count(F.lit(1)).alias("_copies"))
        .select(key_of(keys).alias(KEY), "_source", "_copies")
    )
    marked = target.withColumn("_eligible", F.coalesce(eligible, F.lit(False)))
    joined = marked.join(packed, F.col("_eligible") & (key_of(keys) == F.col(KEY)), "left")
    updated = joined.withColumn("_match", _only_match(F.col("_copies").isNotNull(), F.col("_copies"))).select(
        *[
            F.when(F.col("_match"), F.col("_source")[find(source.schema, f.name).name].cast(f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            if f.name.lower() in matched_names and find(source.schema, f.name)
            else F.col(f.name)
            for f in target.schema
        ]
    )
    held = marked.where("_eligible").select(*keys)
    return updated.unionByName(align(new_rows(source, held, keys), target))


def _only_match(met: Column, copies: Column) -> Column:
    """``met``, or an error where a target row has met one of several source rows of its key."""
    several = F.raise_error(F.lit("a target row matches several source rows")).cast("boolean")
    return F.when(~met, F.lit(False)).when(copies == 1, F.lit(True)).otherwise(several)


def _merge_in_one_pass(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    only: Sequence[str] | None,
    exclude: Sequence[str] | None,
    predicate: Column | None,
) -> DataFrame:
    """One full outer join on the key, whose shuffle of the source also counts the copies of a key.

    Presence flags tell the three cases apart: matched, only in the target, only in the source. Rows that
    cannot match (a NULL in the key, or rejected by the predicate) do not take part.
    """
    matched_names = {c.lower() for c in update_columns(source.columns, only, exclude)}
    eligible = F.coalesce(predicate, F.lit(False)) if predicate is not None else F.lit(True)
    able = all_known(keys) & eligible
    on = [f"_key_{i}" for i in range(len(keys))]
    # Both sides in the target's key types: the window and the join then share the source's shuffle.
    kinds = [find(target.schema, k).dataType for k in keys]

    def keyed(rows: DataFrame, packed: str) -> DataFrame:
        cells = [F.col(k).cast(t).alias(o) for k, t, o in zip(keys, kinds, on, strict=True)]
        return rows.select(F.struct(*rows.columns).alias(packed), *cells)

    copies = F.count(F.lit(1)).over(Window.partitionBy(*on))
    given = keyed(source.where(all_known(keys)), "_source").withColumn("_copies", copies)
    met = keyed(target.where(able), "_target").join(given, on, "full_outer")
    held, brought = F.col("_target").isNotNull(), F.col("_source").isNotNull()
    met = met.withColumn("_match", _only_match(held & brought, F.col("_copies")))

    def cell(field: T.StructField) -> Column:
        known = find(source.schema, field.name)
        new = F.col("_source")[known.name].cast(field.dataType) if known else F.lit(None).cast(field.dataType)
        taken = (~held | F.col("_match")) if field.name.lower() in matched_names and known else ~held
        return F.when(taken, new).otherwise(F.col("_target")[field.name]).alias(field.name)

    result = met.select(*[cell(f) for f in target.schema])
    untouched = target.where(~F.coalesce(able, F.lit(False)))
    return result.unionByName(untouched).unionByName(align(source.where(~all_known(keys)), target))


def delete_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str] | None, predicate: Column | None = None
) -> DataFrame:
    """Drop target rows whose key occurs in the source, then add every source row.

    With ``predicate`` only target rows that also satisfy it are dropped.
    """
    if not keys:
        return append(target, source)
    kept = rows_without(target, source, keys, predicate)
    return append(kept, source)


def replace_where(target: DataFrame, source: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Drop target rows matching ``predicate`` (all without one), then add every source row."""
    if predicate is None:
        return append(target.where(F.lit(False)), source)
    kept = target.where(~F.coalesce(predicate, F.lit(False)))
    return append(kept, source)


def overwrite(target: DataFrame, source: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-table replacement; with ``columns`` the others become NULL."""
    chosen = source.select(*columns) if columns else source
    return align(chosen, target)


def replace_period(
    target: DataFrame, source: DataFrame, event_time: str, start, end, predicate: Column | None = None
) -> DataFrame:
    """Microbatch: replace the half-open event-time slice [start, end) by the source rows."""
    moment = F.col(event_time)
    in_slice = (moment >= F.lit(start)) & (moment < F.lit(end))
    return replace_where(target, source, in_slice if predicate is None else in_slice & predicate)


def newer_than_target(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows past the target's high-water mark; all of them for an empty target."""
    mark = target.select(F.max(column)).scalar()
    return source.where(mark.isNull() | (F.col(column) > mark))


STRATEGIES = {
    "append": append,
    "merge": merge,
    "delete_insert": delete_insert,
    "insert_overwrite": replace_where,
    "microbatch": replace_period,
}


def apply_strategy(
    strategy: str, target: DataFrame, source: DataFrame, on_schema_change: str = "ignore", **options
) -> DataFrame:
    """Reconcile schemas, then run the strategy of that name."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    target, source = reconcile(target, source, on_schema_change)
    return STRATEGIES[strategy](target, source, **options)
