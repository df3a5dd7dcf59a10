"""Streams over arriving files: consume once, refresh, deduplicate, replace slices, keep history.

Every query runs with a checkpoint on shared storage and its output can be replayed: a batch that
is run again after a failure leaves the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from periodica.operators import snapshot
from periodica.plans import history as stored
from periodica.plans.partitioned import partitions_of
from periodica.plans.tables import overwrite_partitions, remove_steps, remove_versions_before

# Numbers of runs set aside for one batch.
RUNS_IN_BATCH = 1_000_000


def as_pattern(path: str) -> str:
    """Path as a glob, so that one file and a folder of files stream alike."""
    return f"{path[:-1]}[{path[-1]}]"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", **options
) -> DataFrame:
    return spark.readStream.format(file_format).schema(schema).options(**options).load(as_pattern(path))


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def ingest_once(rows: DataFrame, output: str, checkpoint: str) -> None:
    """Append files not seen before to a Parquet folder; the checkpoint remembers those taken."""
    run_to_end(
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )


def empty_landing_zone(
    spark: SparkSession, landing: str, archive: str, output: str, checkpoint: str, schema: T.StructType, **options
) -> None:
    """``ingest_once`` from a landing folder that empties itself.

    A file is moved below ``archive``, with its whole path, when its batch has been committed and the next
    one is planned: the files of the last delivery lie in the landing folder until another one arrives.
    ``archive`` must not lie in ``landing``, where archived files would be found again. Files are moved
    by a thread beside the batches; one that could not be moved stays and is not taken a second time.
    """
    if f"{archive.rstrip('/')}/".startswith(f"{landing.rstrip('/')}/"):
        raise ValueError(f"the archive {archive} lies in the landing folder")
    rows = read_files(spark, landing, schema, cleanSource="archive", sourceArchiveDir=archive, **options)
    ingest_once(rows, output, checkpoint)


def windowed_totals(rows: DataFrame, event_time: str, width: str, keys: Sequence[str], aggregates: Sequence) -> DataFrame:
    """Aggregates per tumbling window and key.

    As the model of ``replace_touched_days``, with the day among the keys and a width that divides a
    day, it keeps a refreshed total of everything that has arrived: last windows and late events too.
    """
    grouped = rows.groupBy(F.window(event_time, width).alias("_window"), *keys).agg(*aggregates)
    return grouped.select(
        F.col("_window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in grouped.columns if c != "_window"],
    )


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, of which a batch reads the keys it has rows for.

    The checkpoint remembers the choice, and only what changed is added to it with each batch. Old state is
    removed by the next batch with rows, not by one of its own.
    """
    store = "spark.sql.streaming.stateStore."
    wanted = {
        f"{store}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{store}rocksdb.changelogCheckpointing.enabled": "true",
        f"{store}rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def keep_first(rows: DataFrame, keys: Sequence[str], output: str, checkpoint: str) -> None:
    """Append the first arrival per key to the output, however late it or its copies come.

    All keys taken are state, spread over as many tasks as the first run has shuffle partitions; what was
    kept is never read again. ``stateful.keep_first_within`` bounds the state by event time.
    """
    with state_in_rocksdb(rows.sparkSession):
        query = (
            rows.dropDuplicates(list(keys))
            .writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(output)
        )
    run_to_end(query)


def rows_of_days(rows: DataFrame, event_time: str, days: Sequence[dt.date]) -> DataFrame:
    """Rows of the given days, with bounds on the time itself that a Parquet scan can push down."""
    kind = rows.schema[event_time].dataType
    start, end = F.lit(min(days)).cast(kind), F.lit(max(days) + dt.timedelta(days=1)).cast(kind)
    moment = F.col(event_time)
    return rows.where((moment >= start) & (moment < end) & F.to_date(event_time).isin(list(days)))


def replace_touched_days(
    arrivals: DataFrame,
    event_time: str,
    source: Callable[[], DataFrame],
    model: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    day: str = "day",
) -> None:
    """Recompute every day a batch has events for, and replace those partitions of the output.

    The day's rows are read from the source and not from the output, so running a batch twice gives
    the same partitions.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        # As literals the days reach the scan, which skips files and row groups of other days.
        touched = batch.select(F.to_date(event_time).alias(day)).where(F.col(day).isNotNull())
        days = sorted(r[day] for r in partitions_of(touched, [day]))
        if days:
            slices = rows_of_days(source(), event_time, days).withColumn(day, F.to_date(event_time))
            overwrite_partitions(model(slices), output, [day])

    run_to_end(
        arrivals.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_times(batch: DataFrame, now_column: str) -> list[dt.datetime]:
    """Times of the runs in a batch, in order: one row per run, not per source row."""
    times = [r[0] for r in batch.select(now_column).distinct().orderBy(now_column).toLocalIterator()]
    if None in times:
        raise ValueError(f"rows without a run time in {now_column}")
    return times


def rows_of_run(batch: DataFrame, now_column: str, now, config: snapshot.SnapshotConfig) -> DataFrame:
    source = batch.where(F.col(now_column) == F.lit(now)).drop(now_column)
    if not source.groupBy(*config.keys).count().where("count > 1").isEmpty():
        raise ValueError(f"the run of {now} holds a key more than once")
    return source


def stream_stored_history(
    arrivals: DataFrame,
    config: snapshot.SnapshotConfig,
    now_column: str,
    root: str,
    checkpoint: str,
    buckets: int = 32,
) -> None:
    """Apply each arriving run of source rows to a history in two stores (see ``plans.history``).

    A batch writes what its runs change: closed versions are added, open rows replaced in the buckets
    concerned. Runs are numbered by batch and time, so runs of a repeated batch that are done are left out and one
    that was under way is finished. All rows of one run carry the same time and arrive in one batch. A key that a run holds twice, or a missing run time, is an error.
    """

    def advance(batch: DataFrame, batch_id: int) -> None:
        for step, now in enumerate(run_times(batch, now_column)):
            source = rows_of_run(batch, now_column, now, config)
            stored.advance(source, config, now, root, batch_id * RUNS_IN_BATCH + step, buckets)

    run_to_end(
        arrivals.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def version_path(root: str, batch_id: int) -> str:
    return f"{root}/version={batch_id:012d}"


def stream_history(
    arrivals: DataFrame, config: snapshot.SnapshotConfig, now_column: str, root: str, checkpoint: str
) -> None:
    """Apply each arriving batch of source rows to a history kept as one folder per batch.

    Batch b reads version b - 1 and writes version b, so a repeated batch rewrites its own version
    from the same input; versions older than that input are removed. ``now_column`` holds the run time;
    all rows of one run carry the same time and arrive in one batch. Runs waiting together are applied
    one by one in time order. A key that a run holds twice, or a missing run time, is an error.
    """

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        times = run_times(batch, now_column)
        history = spark.read.parquet(version_path(root, batch_id - 1)) if batch_id else None
        for step, now in enumerate(times):
            source = rows_of_run(batch, now_column, now, config)
            history = snapshot.apply(history, source, config, now) if history else snapshot.initial(source, config, now)
            if step < len(times) - 1:
                path = f"{root}/_steps/{batch_id:012d}-{step:06d}"
                history.write.mode("overwrite").parquet(path)
                history = spark.read.parquet(path)
        history = history or snapshot.initial(batch.drop(now_column), config, None)
        history.write.mode("overwrite").parquet(version_path(root, batch_id))
        remove_steps(spark, root)
        oldest = version_path(root, max(batch_id - 1, 0)).rsplit("/", 1)[-1]
        remove_versions_before(spark, root, oldest)

    run_to_end(
        arrivals.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete history: partition discovery gives the version, its maximum the newest."""
    versions = spark.read.parquet(root)
    return versions.where(F.col("version") == versions.select(F.max("version")).scalar()).drop("version")
