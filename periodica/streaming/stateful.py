"""Streams with state bounded by event time, whose late rows are not lost.

A watermark lets Spark forget old state, and with it drop rows that come later than ``lateness``. Which rows those
are is not reported, so every batch also carries what it has seen past the stateful operator: what was seen and
is in no result of the operator came too late (or twice), and is settled against what is stored. On-time rows
touch nothing but the state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from periodica.operators.joins import KEY
from periodica.plans.partitioned import evenly, partitions_of
from periodica.plans.tables import overwrite_partitions
from periodica.streaming.ingest import rows_of_days, run_to_end, state_in_rocksdb

EPOCH = "1970-01-01 00:00:00"
DAY = "day"


def instant(event_time: str, kind: T.DataType) -> Column:
    """Event time as a timestamp, which a watermark needs; a time without zone is taken as UTC."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast(kind), F.col(event_time)))
    return F.col(event_time).cast("timestamp")


def wall_time(moment: Column, kind: T.DataType) -> Column:
    """The inverse of ``instant`` as a time without zone; other times are shown in the session's zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(moment), F.lit(EPOCH).cast(kind))
    return moment.cast("timestamp_ntz")


def _start(rows: DataFrame, take: Callable[[DataFrame, int], None], mode: str, checkpoint: str, lag: str | None):
    """Run to the end of what has arrived, or with a ``lag`` go on and look for new rows that often."""
    with state_in_rocksdb(rows.sparkSession):
        writer = rows.writeStream.outputMode(mode).foreachBatch(take).option("checkpointLocation", checkpoint)
        query = (writer.trigger(processingTime=lag) if lag else writer.trigger(availableNow=True)).start()
    if lag:
        return query
    run_to_end(query)
    return None


@dataclass(frozen=True)
class Totals:
    """Aggregates per tumbling window of ``width`` and per key; rows without event time are left out."""

    event_time: str
    width: str
    lateness: str
    keys: Sequence[str] = ()
    aggregates: Sequence[Column] = field(default_factory=tuple)

    def windowed(self, rows: DataFrame) -> DataFrame:
        """(_window, keys, aggregates)"""
        kind = rows.schema[self.event_time].dataType
        timed = rows.withColumn("_at", instant(self.event_time, kind))
        if rows.isStreaming:
            timed = timed.withWatermark("_at", self.lateness)
        return timed.groupBy(F.window("_at", self.width).alias("_window"), *self.keys).agg(*self.aggregates)

    def seen(self, rows: DataFrame) -> DataFrame:
        """(_window, keys) of all rows."""
        kind = rows.schema[self.event_time].dataType
        timed = rows.withColumn("_at", instant(self.event_time, kind))
        return timed.select(F.window("_at", self.width).alias("_window"), *self.keys)

    def laid_out(self, totals: DataFrame, kind: T.DataType) -> DataFrame:
        """window_start, window_end, keys, aggregates and the day of the start."""
        start = wall_time(F.col("_window.start"), kind)
        return totals.select(
            start.alias("window_start"),
            wall_time(F.col("_window.end"), kind).alias("window_end"),
            *[c for c in totals.columns if c != "_window"],
            F.to_date(start).alias(DAY),
        )


def refresh_totals(
    rows: DataFrame,
    totals: Totals,
    source: Callable[[], DataFrame],
    output: str,
    checkpoint: str,
    lag: str | None = None,
) -> StreamingQuery | None:
    """Keep ``output`` (Parquet, partitioned by day) at the totals of all rows that have arrived.

    Windows are state until the watermark has passed them; a batch gives the new totals of the windows it has rows
    for, which replace their rows in the days concerned. A window that was seen without such a total has had rows
    after its state was gone: only then are rows read from ``source``, those of the days of these windows, and
    the windows computed anew. Totals replace totals, so a batch that is run again leaves the same rows.
    """
    spark = rows.sparkSession
    kind = rows.schema[totals.event_time].dataType
    counted = totals.windowed(rows)
    names = [c for c in counted.columns if c != "_window" and c not in totals.keys]
    empty = totals.laid_out(totals.windowed(spark.createDataFrame([], rows.schema)), kind)
    layout = empty.schema
    empty.write.mode("ignore").partitionBy(DAY).parquet(output)

    place = ["_window", *totals.keys]
    both = counted.select(*place, F.struct(*names).alias("_total"))
    both = both.unionByName(totals.seen(rows).withColumn("_total", F.lit(None).cast(both.schema["_total"].dataType)))

    def window_range(windows: DataFrame) -> list[dt.date]:
        """Days on which rows of these windows can lie; windows are not longer than a few days."""
        first = F.to_date(wall_time(F.col("_window.start"), kind))
        last = F.to_date(wall_time(F.col("_window.end") - F.expr("INTERVAL 1 MICROSECOND"), kind))
        days = windows.select(F.explode(F.sequence(first, last)).alias(DAY))
        return sorted(r[DAY] for r in partitions_of(days, [DAY]))

    def take(batch: DataFrame, batch_id: int) -> None:
        settled = batch.groupBy(*place).agg(F.any_value("_total", F.lit(True)).alias("_total")).persist()
        try:
            changed = settled.where("_total IS NOT NULL").select(*place, "_total.*")
            missed = settled.where("_total IS NULL").select(*place)
            days = window_range(missed)
            if days:
                again = rows_of_days(source(), totals.event_time, days)
                changed = changed.unionByName(_only_in(totals.windowed(again), missed, place))
            changed = totals.laid_out(changed, kind)
            upsert(changed.persist() if days else changed)
            changed.unpersist()
        finally:
            settled.unpersist()

    def upsert(changed: DataFrame) -> None:
        touched = [r[DAY] for r in partitions_of(changed, [DAY])]
        if touched:
            held = spark.read.schema(layout).parquet(output).where(F.col(DAY).isin(touched))
            kept = _not_in(held, changed, ["window_start", *totals.keys])
            overwrite_partitions(kept.unionByName(changed), output, [DAY])

    return _start(both, take, "update", checkpoint, lag)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right``'s keys renamed, and the NULL-safe condition that they are those of ``left``."""
    other = right.select(F.struct(*columns).alias(KEY)).distinct()
    return other, F.struct(*columns).eqNullSafe(F.col(KEY))


def _not_in(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    other, condition = _same(left, right, columns)
    return left.join(other, condition, "left_anti")


def _only_in(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    other, condition = _same(left, right, columns)
    return left.join(other, condition, "left_semi")


def keep_first_within(
    rows: DataFrame,
    keys: Sequence[str],
    event_time: str,
    lateness: dt.timedelta,
    output: str,
    checkpoint: str,
    lag: str | None = None,
    taken_in: str = "taken_in",
) -> StreamingQuery | None:
    """Append the first arrival per key to ``output``, with keys in state for ``lateness`` of event time only.

    A key names one event, whose copies are at most ``lateness`` apart in event time. Rows that the state has not
    let through are copies or late. They are held against the kept rows of the days within ``lateness`` of theirs,
    and the others are kept too: of older days, nothing is read. Output is partitioned by batch and event day, and
    a batch that is run again replaces its own rows; read it with ``first_arrivals``. Rows with a NULL in
    the key, or without event time, have a state of their own: NULL is a key like any other.
    """
    spark = rows.sparkSession
    kind = rows.schema[event_time].dataType
    layout = T.StructType([*rows.schema.fields, T.StructField(DAY, T.DateType()), T.StructField(taken_in, T.LongType())])
    spark.createDataFrame([], layout).write.mode("ignore").partitionBy(taken_in, DAY).parquet(output)

    timed = rows.withColumn("_at", instant(event_time, kind))
    fresh = timed.where("_at IS NOT NULL").withWatermark("_at", f"{int(lateness.total_seconds())} seconds")
    fresh = fresh.dropDuplicatesWithinWatermark(list(keys)).drop("_at").withColumn("_fresh", F.lit(True))
    both = fresh.unionByName(rows.withColumn("_fresh", F.lit(False)))
    margin = lateness.days + (lateness % dt.timedelta(days=1) > dt.timedelta(0))

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            first = batch.where("_fresh").drop("_fresh")
            rest = _not_in(batch.where("NOT _fresh").drop("_fresh"), first, keys).dropDuplicates(list(keys))
            rest = rest.withColumn(DAY, F.to_date(event_time))
            spread = F.sequence(F.date_sub(DAY, margin), F.date_add(DAY, margin))
            around = rest.where(f"{DAY} IS NOT NULL").select(F.explode(spread).alias(DAY))
            near = [r[DAY] for r in partitions_of(around, [DAY])]
            held = spark.read.schema(layout).parquet(output).where(F.col(taken_in) < batch_id)
            held = held.where(F.col(DAY).isin(near) | F.col(DAY).isNull())
            late = _not_in(rest, held, keys)
            taken = first.withColumn(DAY, F.to_date(event_time)).unionByName(late)
            evenly(taken, [DAY]).write.mode("overwrite").partitionBy(DAY).parquet(f"{output}/{taken_in}={batch_id}")
        finally:
            batch.unpersist()

    return _start(both, take, "append", checkpoint, lag)


def first_arrivals(rows: DataFrame, output: str, taken_in: str = "taken_in") -> DataFrame:
    """What ``keep_first_within`` has kept, in the columns of ``rows``."""
    layout = T.StructType([*rows.schema.fields, T.StructField(DAY, T.DateType()), T.StructField(taken_in, T.LongType())])
    return rows.sparkSession.read.schema(layout).parquet(output).drop(DAY, taken_in)
