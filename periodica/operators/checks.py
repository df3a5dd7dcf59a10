"""Data checks. A check returns its failing rows; a verdict turns them into one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.scalars import any_of
from periodica.operators.joins import rows_without
from periodica.operators.schema import find


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows; NULLs are not looked at."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str, keep_columns: bool = True) -> DataFrame:
    """Rows without a value; all their columns when failures are to be stored."""
    failing = df.where(F.col(column).isNull())
    return failing if keep_columns else failing.select(column)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, once per child row; NULL passes."""
    have = parent.select(F.col(parent_column).alias("from_field"))
    orphans = child.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    return rows_without(orphans, have, ["from_field"])


def aggregated_unique(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Repeated values of many columns in one pass: one grouping set per column.

    Values are counted in their own types; only repeated ones are cast to the shared text column.
    """
    names = [c for c in columns if c not in skip]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, unique_field string, n_records bigint")
    filled = df.where(any_of(*[F.col(c).isNotNull() for c in names])).select(*names)
    label = reduce(
        lambda rest, c: F.when(F.grouping(c) == 0, F.lit(c)).otherwise(rest),
        reversed(names),
        F.lit(None).cast("string"),
    )
    counted = filled.groupingSets([[c] for c in names], *names).agg(
        label.alias("column_name"), F.count(F.lit(1)).alias("n_records")
    )
    repeated = counted.where(F.col("n_records") > 1).select(
        "column_name", F.coalesce(*[F.col(c).cast("string") for c in names]).alias("unique_field"), "n_records"
    )
    return repeated.where(F.col("unique_field").isNotNull())


def aggregated_not_null(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """One row per missing value, naming its column; one scan for all columns. ``ordered`` gives the report's order."""
    names = [c for c in columns if c not in skip]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string")
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in names]))
    return df.select(F.explode(missing).alias("column_name"))


def ordered(failing: DataFrame) -> DataFrame:
    """Result of a check over many columns in the order of a report: by column, most records first, then by value."""
    held = set(failing.columns)
    order = [F.asc("column_name"), *[F.desc(c) for c in ("n_records", "failures") if c in held]]
    return failing.orderBy(*order, *[F.asc(c) for c in ("unique_field",) if c in held])


def verdict(
    failing: DataFrame,
    fail_calc: str = "count(*)",
    warn_if: str = "!= 0",
    error_if: str = "!= 0",
    limit: int | None = None,
) -> DataFrame:
    """One row: the failure measure and whether it warns or errs. ``limit`` applies before it."""
    rows = failing.limit(limit) if limit is not None else failing
    return rows.agg(F.expr(fail_calc).alias("failures")).select(
        "failures",
        F.expr(f"failures {warn_if}").alias("should_warn"),
        F.expr(f"failures {error_if}").alias("should_error"),
    )


def summary_by_column(failing: DataFrame) -> DataFrame:
    """Verdict per column name for checks that cover many columns."""
    return failing.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("failures"),
        (F.count(F.lit(1)) > 0).alias("should_warn"),
        (F.count(F.lit(1)) > 0).alias("should_error"),
    )


def with_where(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """The rows a check is restricted to."""
    return df if condition is None else df.where(condition)


def store_failures(failing: DataFrame, path: str) -> DataFrame:
    """Write the failing rows, replacing the last run's, and read them back for counting."""
    failing.write.mode("overwrite").parquet(path)
    return failing.sparkSession.read.schema(failing.schema).parquet(path)


@dataclass(frozen=True)
class ColumnCheck:
    column: str
    kind: str


def declared_suite(columns: Mapping[str, Sequence[str]]) -> list[ColumnCheck]:
    """Checks from a column -> kinds mapping."""
    return [ColumnCheck(c, kind) for c, kinds in columns.items() for kind in kinds]


def run_suite(df: DataFrame, model: str, suite: Sequence[ColumnCheck]) -> DataFrame:
    """One verdict row per declared check.

    All not_null checks share one scan; each unique check is one aggregate.
    """
    unknown = {c.kind for c in suite} - {"not_null", "unique"}
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    parts = []
    filled = [c.column for c in suite if c.kind == "not_null"]
    if filled:
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("failures"))
            for c in filled
        ]
        counted = df.agg(F.array(*entries).alias("_rows")).select(F.inline("_rows"))
        parts.append(counted.withColumn("check_name", F.lit("not_null")))
    for check in (c for c in suite if c.kind == "unique"):
        counted = unique(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(
            counted.withColumn("column_name", F.lit(check.column)).withColumn("check_name", F.lit("unique"))
        )
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(
        F.lit(model).alias("model"),
        "check_name",
        "column_name",
        "failures",
        (F.col("failures") != 0).alias("should_warn"),
        (F.col("failures") != 0).alias("should_error"),
    )


def unit_diff(actual: DataFrame, expected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows found on one side only, copies counted, labelled with their side."""
    left, right = actual.select(*columns), expected.select(*columns)
    return (
        left.exceptAll(right)
        .withColumn("actual_or_expected", F.lit("actual"))
        .unionByName(right.exceptAll(left).withColumn("actual_or_expected", F.lit("expected")))
    )


def labelled_union(actual: DataFrame, expected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All rows of both sides with the side label, as a unit test report shows them."""
    return (
        actual.select(*columns)
        .withColumn("actual_or_expected", F.lit("actual"))
        .unionByName(expected.select(*columns).withColumn("actual_or_expected", F.lit("expected")))
    )


def fixture_rows(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """Hand-written rows in a table's schema: names ignore case, missing columns are typed NULLs."""
    known = {f.name.lower(): f.name for f in schema}
    cells = []
    for row in rows:
        named = {}
        for name, value in row.items():
            if name.lower() not in known:
                raise ValueError(f"fixture column {name!r} is not one of {list(known.values())}")
            named[known[name.lower()]] = value
        cells.append(tuple(None if named.get(f.name) is None else str(named[f.name]) for f in schema))
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.createDataFrame(cells, texts)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def column_exists(df: DataFrame, name: str) -> bool:
    return find(df.schema, name) is not None
