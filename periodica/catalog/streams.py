"""Streams over the given tables, run to the end of what has arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from periodica.catalog import history
from periodica.catalog.bindings import with_sql
from periodica.catalog.registry import query
from periodica.operators.dedupe import keep_latest
from periodica.operators.snapshot import SnapshotConfig
from periodica.plans import history as stored
from periodica.session import table, work_dir
from periodica.streaming import ingest, stateful


@query("stream_ingest_once", "SELECT * FROM events")
def stream_ingest_once(spark, folder):
    """Files land in two deliveries; every file is taken once."""
    root = work_dir(spark, "ingest")
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for delivery in [events.where(~late), events.where(late)]:
        delivery.write.mode("append").parquet(f"{root}/landing")
        rows = ingest.read_files(spark, f"{root}/landing", events.schema)
        ingest.ingest_once(rows, f"{root}/taken", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/taken")


@query("stream_landing_archive", "SELECT * FROM events")
def stream_landing_archive(spark, folder):
    """Three deliveries into a landing zone that moves what it has taken into an archive."""
    root = work_dir(spark, "landing")
    events = table(spark, folder, "events")
    delivery = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for turn in range(3):
        events.where(F.coalesce(delivery, F.lit(0)) == turn).write.mode("append").parquet(f"{root}/landing")
        ingest.empty_landing_zone(
            spark, f"{root}/landing", f"{root}/archive", f"{root}/taken", f"{root}/checkpoint", events.schema
        )
    return spark.read.parquet(f"{root}/taken")


@query(
    "stream_refresh_agg",
    """
WITH w AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
         count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
  FROM events GROUP BY 1, 2, 3)
SELECT * FROM w""",
)
def stream_refresh_agg(spark, folder):
    """Hourly totals kept in state, refreshed after three deliveries, the last of which is late throughout."""
    root = work_dir(spark, "refresh")
    events = table(spark, folder, "events")
    turn = F.when(F.col("event_type") == "click", 2).when(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"), 0).otherwise(1)
    totals = stateful.Totals(
        event_time="ts",
        width="1 hour",
        lateness="1 day",
        keys=["event_type"],
        aggregates=[
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        ],
    )
    for delivery in range(3):
        events.where(F.coalesce(turn, F.lit(1)) == delivery).write.mode("append").parquet(f"{root}/landing")
        stateful.refresh_totals(
            ingest.read_files(spark, f"{root}/landing", events.schema),
            totals,
            lambda: spark.read.schema(events.schema).parquet(f"{root}/landing"),
            f"{root}/totals",
            f"{root}/checkpoint",
        )
    return spark.read.parquet(f"{root}/totals").drop("day")


@query("stream_dedupe", "SELECT * FROM events")
def stream_dedupe(spark, folder):
    """Three deliveries: the later half, purchases and errors once more, and then everything."""
    root = work_dir(spark, "dedupe")
    events = table(spark, folder, "events")
    later = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for delivery in [events.where(later), events.where(F.col("event_type").isin("purchase", "error")), events]:
        delivery.write.mode("append").parquet(f"{root}/landing")
        rows = ingest.read_files(spark, f"{root}/landing", events.schema)
        ingest.keep_first(rows, ["event_id"], f"{root}/kept", f"{root}/checkpoint")
    return spark.read.schema(events.schema).parquet(f"{root}/kept")


@query("stream_dedupe_within", "SELECT * FROM events")
def stream_dedupe_within(spark, folder):
    """As ``stream_dedupe``, with keys in state for two days of event time; the first delivery is the later half."""
    root = work_dir(spark, "dedupe")
    events = table(spark, folder, "events")
    later = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for delivery in [events.where(later), events.where(F.col("event_type").isin("purchase", "error")), events]:
        delivery.write.mode("append").parquet(f"{root}/landing")
        rows = ingest.read_files(spark, f"{root}/landing", events.schema)
        stateful.keep_first_within(rows, ["event_id"], "ts", dt.timedelta(days=2), f"{root}/kept", f"{root}/checkpoint")
    return stateful.first_arrivals(events, f"{root}/kept")


@query(
    "stream_microbatch",
    "SELECT *, CAST(ts AS DATE) AS day FROM events QUALIFY row_number() OVER "
    "(PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_microbatch(spark, folder):
    """Latest event per day, user and type; late arrivals make their days be computed anew."""
    root = work_dir(spark, "microbatch")
    events = table(spark, folder, "events")
    late = (F.col("event_type") == "click") | (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    for delivery in [events.where(~late), events.where(late)]:
        delivery.write.mode("append").parquet(f"{root}/landing")
        ingest.replace_touched_days(
            ingest.read_files(spark, f"{root}/landing", events.schema),
            "ts",
            lambda: spark.read.schema(events.schema).parquet(f"{root}/landing"),
            lambda rows: keep_latest(rows, ["day", "user_id", "event_type"], ["ts", "event_id"]),
            f"{root}/latest",
            f"{root}/checkpoint",
        )
    return spark.read.parquet(f"{root}/latest")


@query(
    "stream_scd2",
    with_sql(history.DAYS, history.two_days(history.NO_END, f"TIMESTAMP '{history.NOW[1]}'")),
)
def stream_scd2(spark, folder):
    """Two arrivals of the whole source; the stream is stopped in between and picks up where it was."""
    root = work_dir(spark, "history")
    config = SnapshotConfig(keys=["o_orderkey"], updated_at="updated_at", hard_deletes="invalidate")
    for now, rows in zip(history.NOW, [history.day0(spark, folder), history.day1(spark, folder)]):
        arriving = rows.withColumn("run_time", F.lit(now).cast("timestamp_ntz"))
        arriving.write.mode("append").parquet(f"{root}/landing")
        stream = ingest.read_files(spark, f"{root}/landing", arriving.schema)
        ingest.stream_stored_history(stream, config, "run_time", f"{root}/history", f"{root}/checkpoint", buckets=8)
    return stored.history(spark, f"{root}/history")
