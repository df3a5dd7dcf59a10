"""Histories in two stores: closed versions are only ever added to, open rows are replaced by bucket.

Under the root folder lie
- ``changes/run=R/_kind=...``: what run R closed and opened, written once. Its closed rows are the closed store.
- ``open/bucket=B``: the open rows, by a hash of the key. A run rewrites the buckets in which it changes a row.
- ``marks``: one row when the changes of a run are complete (with the layout of the history then), one when they
  have been applied to the open rows.

A run reads open rows and source, and of closed rows the version ids only. Its changes are stored before they are
applied, and applying them twice is applying them once: a run that has failed in between is finished by the next call,
whatever that is for. Numbers of runs have to grow; a run that is done is not repeated.

New source columns are added to the layout; older files lack them and give NULL. Rows with a NULL key match
nothing and are closed or kept as ``snapshot.apply`` does it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.operators import snapshot
from periodica.plans.partitioned import partitions_of
from periodica.plans.tables import write_partitions

RUN, BUCKET = "_run", "bucket"
STAGED, DONE = "staged", "done"
# Ids are hexadecimal text, which this packs to half of what the default does.
PACKED = {"compression": "zstd"}
# What a row is when changes meet the open rows.
WAS = "_was"
HELD, ENDED, ADDED = 0, 1, 2
MARKS = "run long, mark string, buckets int, layout string"


@dataclass(frozen=True)
class Marks:
    """How far a history has come."""

    staged: int | None = None
    done: int | None = None
    buckets: int | None = None
    layout: T.StructType | None = None


def _marks(spark: SparkSession, root: str) -> Marks:
    spark.createDataFrame([], MARKS).write.mode("ignore").parquet(f"{root}/marks")
    rows = spark.read.schema(MARKS).parquet(f"{root}/marks")
    newest = F.max(F.when(F.col("mark") == STAGED, F.struct("run", "buckets", "layout")))
    last = rows.agg(newest.alias("staged"), F.max(F.when(F.col("mark") == DONE, F.col("run"))).alias("done")).first()
    if last.staged is None:
        return Marks()
    return Marks(last.staged.run, last.done, last.staged.buckets, T.StructType.fromJson(json.loads(last.staged.layout)))


def _mark(spark: SparkSession, root: str, run: int, mark: str, buckets: int, layout: T.StructType) -> None:
    spark.createDataFrame([(run, mark, buckets, layout.json())], MARKS).coalesce(1).write.mode("append").parquet(f"{root}/marks")


def _open_rows(spark: SparkSession, root: str, layout: T.StructType) -> DataFrame:
    """Open rows with the run that opened them and their bucket."""
    held = T.StructType([*layout.fields, T.StructField(RUN, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    spark.createDataFrame([], held).write.mode("ignore").partitionBy(BUCKET).parquet(f"{root}/open")
    # A bucket that has become empty holds one row without a run.
    return spark.read.schema(held).parquet(f"{root}/open").where(F.col(RUN).isNotNull())


def _changes(spark: SparkSession, root: str, layout: T.StructType) -> DataFrame:
    """All changes so far, with their run and kind."""
    held = T.StructType([*layout.fields, T.StructField("run", T.LongType()), T.StructField(snapshot.KIND, T.StringType())])
    spark.createDataFrame([], held).write.mode("ignore").partitionBy("run", snapshot.KIND).parquet(f"{root}/changes")
    return spark.read.schema(held).parquet(f"{root}/changes")


def _closed(spark: SparkSession, root: str, layout: T.StructType, run: int) -> DataFrame:
    """Rows closed up to a run."""
    past = _changes(spark, root, layout).where((F.col("run") <= run) & (F.col(snapshot.KIND) == snapshot.CLOSED))
    return past.drop("run", snapshot.KIND)


def _bucket(cfg: snapshot.SnapshotConfig, buckets: int):
    return F.pmod(F.xxhash64(*cfg.keys), F.lit(buckets)).cast("int")


def _without_ended(rows: DataFrame, version: str) -> DataFrame:
    """Rows without the held ones that have ended, by bucket.

    Held rows are moved once, by ranges of (bucket, id): a range is a few files of a bucket at most, and has all
    rows of an id.
    """
    ended = F.max(F.col(WAS) == ENDED).over(Window.partitionBy(BUCKET, version))
    ranged = rows.repartitionByRange(BUCKET, version).withColumn("_ended", ended)
    stays = (F.col(WAS) == ADDED) | ((F.col(WAS) == HELD) & ~F.col("_ended"))
    return ranged.where(stays).drop(WAS, "_ended")


def overwrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the buckets that ``rows`` has rows for."""
    write_partitions(rows, path, partition_by, **PACKED)


def _apply_changes(spark: SparkSession, root: str, cfg: snapshot.SnapshotConfig, marks: Marks) -> None:
    """Bring the buckets that run ``marks.staged`` changes to their state after it."""
    run, layout = marks.staged, marks.layout
    changed = _changes(spark, root, layout).where(F.col("run") == run).drop("run")
    changed = changed.withColumn(BUCKET, _bucket(cfg, marks.buckets))
    touched = sorted(r[BUCKET] for r in partitions_of(changed, [BUCKET]))
    if touched:
        held = _open_rows(spark, root, layout).where(F.col(BUCKET).isin(touched) & (F.col(RUN) != run))
        is_closed = F.col(snapshot.KIND) == snapshot.CLOSED
        ended = changed.where(is_closed).select(cfg.names.scd_id, BUCKET)
        opened = changed.where(~is_closed).drop(snapshot.KIND).withColumn(RUN, F.lit(run).cast("long"))
        guards = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        parts = [(held, HELD), (ended, ENDED), (opened, ADDED), (guards, ADDED)]
        rows, *others = [part.withColumn(WAS, F.lit(was)) for part, was in parts]
        for other in others:
            rows = rows.unionByName(other, allowMissingColumns=True)
        overwrite_partitions(_without_ended(rows, cfg.names.scd_id), f"{root}/open", [BUCKET])
    _mark(spark, root, run, DONE, marks.buckets, layout)


def advance(
    source: DataFrame, cfg: snapshot.SnapshotConfig, now, root: str, run: int, buckets: int = 32
) -> None:
    """Run number ``run`` of a history: the first one builds it, later ones write what has changed.

    ``buckets`` counts for the first run. A run that is done already is left out.
    """
    spark = source.sparkSession
    marks = _marks(spark, root)
    if marks.staged is not None and marks.staged != marks.done:
        _apply_changes(spark, root, cfg, marks)
    if marks.staged is not None and run <= marks.staged:
        return
    layout = marks.layout or snapshot.initial(source.limit(0), cfg, now).schema
    if marks.staged is None:
        changed = snapshot.initial(source, cfg, now).withColumn(snapshot.KIND, F.lit(snapshot.OPENED))
    else:
        open_rows = _open_rows(spark, root, layout).drop(RUN, BUCKET)
        closed_ids = _closed(spark, root, layout, run - 1).select(cfg.names.scd_id)
        # Without a closed version none can come back, and what is opened need not meet the closed ids.
        looked_up = replace(cfg, versions_unique=cfg.versions_unique or closed_ids.isEmpty())
        changed = snapshot.changes(open_rows, closed_ids, source, looked_up, now)
    changed.write.mode("overwrite").options(**PACKED).partitionBy(snapshot.KIND).parquet(f"{root}/changes/run={run}")
    after = T.StructType([f for f in changed.schema if f.name != snapshot.KIND])
    marks = Marks(run, marks.done, marks.buckets or buckets, after)
    _mark(spark, root, run, STAGED, marks.buckets, after)
    _apply_changes(spark, root, cfg, marks)


def history(spark: SparkSession, root: str) -> DataFrame:
    """All versions after the last run that is done."""
    marks = _marks(spark, root)
    if marks.done is None:
        raise ValueError(f"no finished run under {root}")
    rows = _open_rows(spark, root, marks.layout).drop(RUN, BUCKET)
    return rows.unionByName(_closed(spark, root, marks.layout, marks.done))
