"""Release files, seeds and extracts."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.fixed_values import MONTH_NAMES
from periodica.functions.scalars import add_interval, let, parse_number
from periodica.operators.joins import rows_without
from periodica.operators.schema import find

RELEASE_SCHEMA = T.StructType(
    [
        T.StructField("Manufacturer", T.StringType()),
        T.StructField("Frequency", T.StringType()),
        T.StructField("Month", T.StringType()),
        T.StructField("Units", T.StringType()),
        T.StructField("Region", T.StringType()),
        T.StructField("PDF", T.StringType()),
    ]
)


def _files_under(reader: DataFrameReader, name_glob: str) -> DataFrameReader:
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob)


def scan_csv(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    name_glob: str = "Press_release*.csv",
    one_layout: bool = False,
) -> DataFrame:
    """All CSV files under ``root`` whose name matches, unioned by column name, with the file's path and name.

    A first pass takes the header line of every file. Files with the same header are one scan; the columns of
    ``schema`` are found there without regard to case and order, a column that a file lacks is NULL, and
    others are left out. ``one_layout`` spares that pass for files that all have exactly the columns of
    ``schema`` in its order: another header is an error then.
    """
    if one_layout:
        return _scan_layout(spark, root, name_glob, schema, schema, None)
    layouts = csv_layouts(spark, root, name_glob)
    if not layouts:
        return _scan_layout(spark, root, name_glob, schema, schema, [])
    scans = []
    for header, paths in layouts:
        names = next(csv.reader([header.removeprefix("\ufeff")], doublequote=True))
        twice = {n for n in names if [m.lower() for m in names].count(n.lower()) > 1}
        if twice:
            raise ValueError(f"columns {sorted(twice)} occur more than once in the header of {paths[0]}")
        held = T.StructType([T.StructField(n, (find(schema, n) or T.StructField(n, T.StringType())).dataType) for n in names])
        scans.append(_scan_layout(spark, root, name_glob, held, schema, paths if len(layouts) > 1 else None))
    return reduce(DataFrame.unionByName, scans)


def csv_layouts(spark: SparkSession, root: str, name_glob: str) -> list[tuple[str, list[str]]]:
    """(header line, paths of the files that begin with it). Only headers and paths leave the scan."""
    lines = _files_under(spark.read, name_glob).text(root).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("path")
    headers = first.agg(F.min_by("value", "place").alias("header"))
    grouped = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    found = grouped.agg(F.sort_array(F.collect_list(F.struct("header", "paths"))).alias("layouts")).first()
    return [(layout.header, layout.paths) for layout in found["layouts"]]


def _scan_layout(
    spark: SparkSession, root: str, name_glob: str, held: T.StructType, wanted: T.StructType, paths: list[str] | None
) -> DataFrame:
    """Files of one header, ``held``, in the columns of ``wanted``; of all files, or of those in ``paths``."""
    reader = spark.read.schema(held).option("header", True).option("enforceSchema", False).option("escape", '"')
    rows = _files_under(reader, name_glob).csv(root)
    path = F.col("_metadata.file_path")
    if paths is not None:
        # A condition on the path alone: files of other layouts are not opened.
        rows = rows.where(path.isin(paths))

    def cell(field: T.StructField) -> Column:
        known = find(held, field.name)
        return (F.col(f"`{known.name}`") if known else F.lit(None).cast(field.dataType)).alias(field.name)

    return rows.select(
        *[cell(f) for f in wanted], path.alias("file_path"), F.col("_metadata.file_name").alias("file_name")
    )


def scan_lines(spark: SparkSession, root: str, name_glob: str = "*.txt") -> DataFrame:
    """Text files as (file_path, file_name, line_no, line), line_no rising in file order.

    ``line_no`` is made of the byte at which the piece of the file begins and the place inside the task, so lines
    need no shuffle to be put in order and a file may have any size. A task reads no more lines than bytes, at
    most those of one piece and a line break for each file; with four numbers to each byte, lines of one piece
    stay below the first of the next.
    """
    lines = _files_under(spark.read, name_glob).text(root)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        (F.col("_metadata.file_block_start") * 4 + place).alias("line_no"),
        F.col("value").alias("line"),
    )


def list_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """Files under ``root`` by name, contents left unread."""
    files = _files_under(spark.read.format("binaryFile"), name_glob).load(root)
    return files.select("path", "length", "modificationTime").orderBy("path")


def manifest(rows: DataFrame, file: str, data_columns: int) -> DataFrame:
    """Per file its number of rows and columns."""
    return rows.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(data_columns))


def period_from_name(name: Column | str, strict: bool = False) -> Column:
    """First day of the month a file name speaks of: a month name and a stand-alone 4-digit year.

    Without either the result is NULL, or an error if strict. When a name holds several month
    names, the first in calendar order counts.
    """
    name = F.col(name) if isinstance(name, str) else name
    bare = F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), r"\.[^.]*$", "")

    def month_of(lowered: Column) -> Column:
        return F.coalesce(
            *[F.when(F.contains(lowered, F.lit(m)), F.lit(i)) for i, m in enumerate(MONTH_NAMES, start=1)]
        )

    def period_of(text: Column) -> Column:
        year = F.regexp_extract(text, r"(?:^|\s)(\d{4})(?=\s|$)", 1).try_cast("int")
        return F.make_date(year, let(F.lower(text), month_of), F.lit(1))

    period = let(bare, period_of)
    if strict:
        message = F.concat(F.lit("no month and year in file name: "), name)
        return F.when(period.isNull(), F.raise_error(message).cast("date")).otherwise(period)
    return period


def period_label(period: Column) -> Column:
    """'Mon-YY' text of a date."""
    return F.date_format(period, "MMM-yy")


def year_before(period: Column) -> Column:
    return add_interval("month", -12, period).cast("date")


def load_raw(rows: DataFrame, loaded_at: str, units: str = "Units") -> DataFrame:
    """Release rows as raw facts: numbers cleaned, load time stamped.

    Unreadable numbers stop the load, as they would in the source's own strict conversion.
    """
    return rows.withColumn(units, parse_number(units, strict=True)).withColumn("inserted_at", F.lit(loaded_at))


def load_seed(spark: SparkSession, path: str, column_types: Mapping[str, str] | None = None) -> DataFrame:
    """CSV with inferred types, single columns overridden.

    Overridden columns are read as text before their cast, so '007' survives a string override.
    """
    wanted = dict(column_types or {})
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    as_read = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in wanted else f
            for f in inferred
        ]
    )
    rows = spark.read.option("header", True).schema(as_read).csv(path)
    return rows.select(*[F.col(f.name).cast(wanted.get(f.name, f.dataType)).alias(f.name) for f in inferred])


def load_extract(spark: SparkSession, path: str, schema: T.StructType, entity: str, month: str) -> DataFrame:
    """An exported CSV with its dates parsed, ordered by entity and month."""
    as_read = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == month else f for f in schema]
    )
    rows = spark.read.option("header", True).schema(as_read).csv(path)
    return rows.withColumn(month, F.to_date(month)).orderBy(entity, month)


def with_fallback(primary: DataFrame, secondary: DataFrame, document: str) -> DataFrame:
    """Primary records, and secondary ones for documents the primary source gave none for."""
    return primary.unionByName(rows_without(secondary, primary, [document]))


def lines_without_records(lines: DataFrame, records: DataFrame, document: str) -> DataFrame:
    """Lines of a second text source for documents that the first gave no records for: only these are parsed."""
    return rows_without(lines, records, [document])


def column_type(df: DataFrame, name: str) -> T.DataType:
    return find(df.schema, name).dataType
