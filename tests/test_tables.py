"""Writers, lifecycle and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from periodica.operators.snapshot import SnapshotConfig
from periodica.plans import tables
from periodica.session import work_dir
from periodica.streaming import ingest


def test_swap_reads_what_it_replaces(spark, tmp_path):
    root = str(tmp_path)
    first = tables.swap_table(spark.range(3), "swap_t", root)
    second = tables.swap_table(first.unionByName(spark.range(3, 5)), "swap_t", root)
    assert second.count() == 5
    assert len(tables.remove_old_builds(spark, "swap_t", root)) == 1
    assert spark.table("swap_t").count() == 5
    tables.truncate_table(spark, "swap_t", root)
    assert spark.table("swap_t").count() == 0
    tables.drop_table(spark, "swap_t")


def test_failed_build_leaves_the_table(spark, tmp_path):
    tables.swap_table(spark.range(3), "kept_t", str(tmp_path))
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.swap_table(bad, "kept_t", str(tmp_path))
    assert spark.table("kept_t").count() == 3
    tables.drop_table(spark, "kept_t")


def test_incremental_lifecycle(spark, tmp_path):
    seen = []

    def model(existing):
        seen.append(existing is None)
        return spark.range(2).withColumn("v", F.lit(len(seen)))

    def run(**options):
        result = tables.run_incremental(spark, "life_t", str(tmp_path), model, "merge", keys=["id"], **options)
        return sorted(tuple(r) for r in result.collect())

    spark.range(1).createOrReplaceTempView("life_t")
    assert run() == [(0, 1), (1, 1)]
    assert run() == [(0, 2), (1, 2)]
    assert run(full_refresh=True) == [(0, 3), (1, 3)]
    assert seen == [True, False, True]
    tables.drop_table(spark, "life_t")


def test_seed_refill_and_view_in_the_way(spark, tmp_path):
    root = str(tmp_path)
    tables.write_seed(spark.range(2).withColumn("n", F.lit(1)), "seed_t", root)
    refilled = tables.write_seed(spark.range(5).withColumn("n", F.lit("2")), "seed_t", root)
    assert refilled.count() == 5 and dict(refilled.dtypes)["n"] == "int"
    rebuilt = tables.write_seed(spark.range(5).withColumn("n", F.lit("2")), "seed_t", root, full_refresh=True)
    assert dict(rebuilt.dtypes)["n"] == "string"
    tables.drop_table(spark, "seed_t")
    spark.range(1).createOrReplaceTempView("seed_view")
    with pytest.raises(ValueError, match="view"):
        tables.write_seed(spark.range(1), "seed_view", root)
    spark.catalog.dropTempView("seed_view")


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    tables.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_clustered_files_hold_ranges(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    tables.clustered_write(df, path, ["k"], files=4)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b"))
    spans = sorted((r.a, r.b) for r in spans.collect())
    assert len(spans) == 4 and all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def test_work_dir_is_new_each_time(spark):
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_ingest_takes_files_once(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for n in range(2):
        spark.range(3).write.mode("append").parquet(landing)
        ingest.ingest_once(ingest.read_files(spark, landing, spark.range(1).schema), out, mark)
    ingest.ingest_once(ingest.read_files(spark, landing, spark.range(1).schema), out, mark)
    assert spark.read.parquet(out).count() == 6


def events(spark, *data):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in data], "id int, ts timestamp_ntz")


def test_late_and_last_events_reach_their_windows(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "ck"))
    deliveries = [
        [(1, "2024-01-01 00:10"), (2, "2024-01-01 03:00")],
        [(3, "2024-01-01 02:30"), (4, "2024-01-01 00:20"), (5, "2024-01-01 06:00")],
    ]
    for delivery in deliveries:
        rows = events(spark, *delivery)
        rows.write.mode("append").parquet(landing)
        ingest.replace_touched_days(
            ingest.read_files(spark, landing, rows.schema),
            "ts",
            lambda: spark.read.parquet(landing),
            lambda df: ingest.windowed_totals(df, "ts", "1 hour", ["day"], [F.count(F.lit(1)).alias("n")]),
            out,
            mark,
        )
    got = sorted((r.window_start.hour, r.n) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (2, 1), (3, 1), (6, 1)]


def test_keep_first_across_batches(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "ck"))
    deliveries = [
        [(1, "2024-01-01 00:10"), (2, "2024-01-05 00:00")],
        [(1, "2024-01-01 00:20"), (3, "2024-01-06 00:30"), (3, "2024-01-06 00:40")],
        [(4, "2024-01-01 00:00"), (2, "2024-01-05 00:00")],
    ]
    for delivery in deliveries:
        rows = events(spark, *delivery)
        rows.write.mode("append").parquet(landing)
        ingest.keep_first(ingest.read_files(spark, landing, rows.schema), ["id"], out, mark)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_waiting_runs_are_applied_one_by_one(spark, tmp_path):
    landing, versions, mark = (str(tmp_path / n) for n in ("in", "versions", "ck"))
    cfg = SnapshotConfig(keys=["id"], updated_at="ts")
    for run in (2, 1):
        rows = events(spark, (1, f"2024-01-0{run} 00:00")).withColumn("run_time", F.lit(f"2025-01-0{run}").cast("timestamp_ntz"))
        rows.write.mode("append").parquet(landing)
    ingest.stream_history(ingest.read_files(spark, landing, rows.schema), cfg, "run_time", versions, mark)
    history = ingest.latest_version(spark, versions)
    assert sorted((r.ts.day, r.valid_to and r.valid_to.day) for r in history.collect()) == [(1, 2), (2, None)]
    rows.unionByName(rows).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="more than once"):
        ingest.stream_history(ingest.read_files(spark, landing, rows.schema), cfg, "run_time", versions, mark)


def test_replayed_batch_gives_the_same_days(spark, tmp_path):
    landing, out = (str(tmp_path / n) for n in ("in", "out"))
    rows = events(spark, (1, "2024-01-01 00:10"), (2, "2024-01-02 00:10"))
    rows.write.parquet(landing)
    for attempt in range(2):  # a new checkpoint makes the stream take the same files again
        ingest.replace_touched_days(
            ingest.read_files(spark, landing, rows.schema),
            "ts",
            lambda: spark.read.parquet(landing),
            lambda df: df,
            out,
            str(tmp_path / f"ck{attempt}"),
        )
    assert spark.read.parquet(out).count() == 2


def test_history_stream_keeps_its_last_two_versions(spark, tmp_path):
    landing, versions, mark = (str(tmp_path / n) for n in ("in", "versions", "ck"))
    cfg = SnapshotConfig(keys=["id"], updated_at="ts")
    deliveries = [
        [(1, "2024-01-01 00:00")],
        [(1, "2024-01-05 00:00"), (2, "2024-01-05 00:00")],
        [(1, "2024-01-05 00:00"), (2, "2024-01-05 00:00")],
    ]
    for run, delivery in enumerate(deliveries):
        rows = events(spark, *delivery).withColumn("run_time", F.lit(f"2025-01-0{run + 1}").cast("timestamp_ntz"))
        rows.write.mode("append").parquet(landing)
        ingest.stream_history(ingest.read_files(spark, landing, rows.schema), cfg, "run_time", versions, mark)
    history = ingest.latest_version(spark, versions)
    assert sorted((r.id, r.valid_to is None) for r in history.collect()) == [(1, False), (1, True), (2, True)]
    assert sorted(p.name for p in (tmp_path / "versions").iterdir()) == [f"version={v:012d}" for v in (1, 2)]
