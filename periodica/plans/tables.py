"""Table writers: replace, swap, partition overwrite, seeds, clones, incremental runs.

A table is always built aside in a new folder and then takes over its name in the catalog by two
renames, so a target can be read while its successor is written and a failed build leaves it alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.operators.incremental import STRATEGIES, apply_strategy
from periodica.operators.schema import find
from periodica.plans import partitioned


def replace_folder(df: DataFrame, path: str) -> DataFrame:
    """Full-replace sink; the folder must not be an input of ``df``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def export_table(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> str:
    """The whole table as files of one extract, replacing the last one."""
    writer = spark.table(name).write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
    return path


def clustered_write(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> DataFrame:
    """Files ordered by the cluster keys, so that readers skip files and row groups by range.

    Range partitioning samples the keys, which spreads the rows of a frequent leading key by the
    keys after it.
    """
    keys = [*partition_by, *cluster_by]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    writer = ranged.sortWithinPartitions(*keys).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    write_partitions(partitioned.evenly(df, partition_by), path, partition_by)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **options) -> None:
    """``overwrite_partitions`` for rows whose partitions lie together in few tasks already."""
    (
        df.write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def swap_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Build a table aside under ``root`` and let it take over ``name``.

    An existing table is renamed away, the new one renamed in, and the old one dropped; a view of
    that name is dropped first. The renames touch the catalog only.
    """
    spark = df.sparkSession
    if _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
    build, backup = f"{name}__build", f"{name}__backup"
    path = f"{root}/{name}/{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {build}")
    if partition_by:
        partitioned.evenly(df, partition_by).write.partitionBy(*partition_by).parquet(path)
        by = ", ".join(partitioned.quoted(c) for c in partition_by)
        columns = partitioned.columns_ddl(df.schema.fields)
        spark.sql(f"CREATE TABLE {build} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION {partitioned.literal(path)}")
        spark.sql(f"ALTER TABLE {build} RECOVER PARTITIONS")
    else:
        df.write.parquet(path)
        spark.catalog.createTable(build, path=path, source="parquet")
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {backup}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    spark.sql(f"ALTER TABLE {build} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {backup}")
    return spark.table(name)


def remove_old_builds(spark: SparkSession, name: str, root: str) -> list[str]:
    """Delete the folders of a table's earlier builds, once nothing reads them any more."""
    current = partitioned.location(spark, name).rstrip("/").rsplit("/", 1)[-1]
    return _delete_children(spark, f"{root}/{name}", lambda child: child != current)


def _delete_children(spark: SparkSession, folder: str, unwanted: Callable[[str], bool]) -> list[str]:
    """Delete the unwanted sub-folders of a folder on whatever storage it is."""
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in files.listStatus(home):
        if unwanted(status.getPath().getName()):
            files.delete(status.getPath(), True)
            removed.append(status.getPath().getName())
    return removed


def remove_versions_before(spark: SparkSession, root: str, version: str) -> list[str]:
    """Delete version folders whose name sorts before ``version``."""
    return _delete_children(spark, root, lambda child: child.startswith("version=") and child < version)


def remove_steps(spark: SparkSession, root: str) -> list[str]:
    """Delete what a finished batch has written between its runs."""
    return _delete_children(spark, root, lambda child: child == "_steps")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY")


def write_seed(df: DataFrame, name: str, root: str, full_refresh: bool = False) -> DataFrame:
    """Load a seed: an existing table keeps its columns and gets new rows, or is rebuilt.

    A view of that name is an error unless the load is a full refresh of a table.
    """
    spark = df.sparkSession
    if _is_view(spark, name):
        raise ValueError(f"cannot seed {name}: it is a view")
    if full_refresh or not spark.catalog.tableExists(name):
        return swap_table(df, name, root)
    held = spark.table(name).schema
    return swap_table(
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in held]), name, root
    )


def clone_table(spark: SparkSession, source: str, name: str, root: str, as_view: bool = False) -> DataFrame:
    """Copy of a table, or a view over it."""
    if as_view:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {source}")
        return spark.table(name)
    return swap_table(spark.table(source), name, root)


def truncate_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Same columns, no rows. Tables over a given folder cannot be truncated in place, so swap."""
    return swap_table(spark.table(name).limit(0), name, root)


def run_incremental(
    spark: SparkSession,
    name: str,
    root: str,
    model: Callable[[DataFrame | None], DataFrame],
    strategy: str,
    full_refresh: bool = False,
    on_schema_change: str = "ignore",
    partition_by: Sequence[str] = (),
    **options,
) -> DataFrame:
    """One run of an incremental model.

    The model gets the existing table, or None on a first run, a full refresh, or when a view holds
    the name; in those cases its result becomes the table as it is, partitioned by ``partition_by``.
    Later runs write the partitions they touch, and an append only adds files (see ``partitioned``);
    tables without partitions are built anew by the other strategies.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    exists = spark.catalog.tableExists(name) and not _is_view(spark, name)
    if full_refresh or not exists:
        return swap_table(model(None), name, root, partition_by)
    target = spark.table(name)
    source = model(target)
    if partitioned.run_in_place(spark, name, source, strategy, on_schema_change, options):
        return spark.table(name)
    merged = apply_strategy(strategy, target, source, on_schema_change, **options)
    return swap_table(merged, name, root, partitioned.partition_columns(spark, name))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def has_columns(df: DataFrame, names: Sequence[str]) -> bool:
    return all(find(df.schema, n) for n in names)
