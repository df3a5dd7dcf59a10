"""Streams with bounded state: whole results, late rows, and what a batch reads."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from periodica.streaming import ingest, stateful

SCHEMA = "id int, ts timestamp_ntz, kind string, v int"


class Landing:
    """Deliveries of files, the stream over them, and how often the files were read again."""

    def __init__(self, spark, folder: Path, schema: str = SCHEMA):
        self.spark, self.folder, self.schema, self.reads = spark, str(folder / "in"), schema, 0
        self.output, self.checkpoint = str(folder / "out"), str(folder / "ck")

    def deliver(self, *rows):
        moment = dt.datetime.fromisoformat
        data = [(i, t and moment(t), *rest) for i, t, *rest in rows]
        self.spark.createDataFrame(data, self.schema).write.mode("append").parquet(self.folder)

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return ingest.read_files(self.spark, self.folder, schema)

    def source(self):
        self.reads += 1
        return self.spark.read.schema(self.schema).parquet(self.folder)


def totals(**options):
    sums = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")]
    return stateful.Totals(**{"event_time": "ts", "width": "1 hour", "lateness": "1 hour", "keys": ["kind"], "aggregates": sums} | options)


def refresh(landing, rule=None, **options):
    return stateful.refresh_totals(
        landing.stream(), rule or totals(), landing.source, landing.output, landing.checkpoint, **options
    )


def held(landing):
    rows = landing.spark.read.parquet(landing.output).collect()
    return sorted(((str(r.window_start), r.kind, r.n, r.total) for r in rows), key=repr)


def expected(landing):
    rows = landing.spark.read.schema(landing.schema).parquet(landing.folder).where("ts IS NOT NULL")
    rows = rows.groupBy(F.date_trunc("hour", "ts").alias("w"), "kind").agg(F.count(F.lit(1)), F.sum("v")).collect()
    return sorted(((str(r[0].replace(tzinfo=None)), *r[1:]) for r in rows), key=repr)


FIRST = [(1, "2024-01-01 00:10", "a", 1), (2, "2024-01-01 03:00", "a", 2), (3, "2024-01-01 03:10", None, 3), (9, None, "a", 9)]


def test_on_time_batches_read_no_old_files(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver(*FIRST)
    refresh(landing)
    assert held(landing) == expected(landing)
    landing.deliver((4, "2024-01-01 03:20", None, 4), (5, "2024-01-01 02:59", "b", 5), (6, "2024-01-02 06:00", "a", 6))
    refresh(landing)
    assert held(landing) == expected(landing)
    assert landing.reads == 0


def test_late_rows_have_their_windows_computed_anew(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver(*FIRST)
    refresh(landing)
    for more in (
        [(4, "2024-01-01 00:20", "a", 4), (5, "2024-01-01 06:00", "a", 5)],
        [(6, "2024-01-01 00:30", None, 6), (7, "2023-12-30 23:59:59.999999", "a", 7), (8, "2024-01-01 06:01", "a", 8)],
    ):
        landing.deliver(*more)
        refresh(landing)
        assert held(landing) == expected(landing)
    # The first late row comes before its window's state is removed, which happens with the batch after the next.
    assert landing.reads == 1


def test_only_the_days_concerned_are_written(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver(*FIRST, (10, "2024-01-05 00:00", "a", 1))
    refresh(landing)
    before = {p: p.stat().st_mtime_ns for p in Path(landing.output).rglob("*.parquet")}
    landing.deliver((11, "2024-01-05 00:30", "a", 1))
    refresh(landing)
    after = {p: p.stat().st_mtime_ns for p in Path(landing.output).rglob("*.parquet")}
    assert {p.parent.name for p in before.keys() ^ after.keys()} == {"day=2024-01-05"}
    assert held(landing) == expected(landing)


def test_replayed_batch_leaves_the_same_totals(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver(*FIRST)
    refresh(landing)
    landing.checkpoint += "-2"  # a new checkpoint makes the stream take the same files again
    refresh(landing)
    assert held(landing) == expected(landing)


def test_lag_keeps_the_stream_running(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver(*FIRST)
    query = refresh(landing, lag="1 second")
    try:
        query.processAllAvailable()
        assert held(landing) == expected(landing)
        landing.deliver((4, "2024-01-01 05:20", "z", 4))
        query.processAllAvailable()
        assert held(landing) == expected(landing)
    finally:
        query.stop()


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_windows_over_midnight(spark, tmp_path, kind):
    landing = Landing(spark, tmp_path, SCHEMA.replace("timestamp_ntz", kind))
    rule = totals(width="10 hours", keys=[])
    landing.deliver(*FIRST)
    refresh(landing, rule)
    for late in ("2024-01-03 00:20", "2024-01-03 01:20"):
        landing.deliver((4, late, "z", 4))
        refresh(landing, rule)
    landing.deliver((5, "2023-12-31 23:50", "z", 5), (6, "2024-01-01 02:00", "z", 6))
    refresh(landing, rule)
    rows = spark.read.parquet(landing.output).collect()
    starts = {r.window_start for r in rows}
    assert sum(r.n for r in rows) == 7 and len(starts) == len(rows)
    assert all(r.window_end - r.window_start == dt.timedelta(hours=10) for r in rows)
    assert landing.reads == 1


def test_state_store_setting_is_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with ingest.state_in_rocksdb(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before


def dedupe(landing, lateness=dt.timedelta(hours=2), **options):
    return stateful.keep_first_within(landing.stream(), ["id", "kind"], "ts", lateness, landing.output, landing.checkpoint, **options)


def kept(landing):
    rows = stateful.first_arrivals(landing.spark.createDataFrame([], landing.schema), landing.output).collect()
    return sorted(((r.id, r.kind) for r in rows), key=repr)


def test_first_arrivals_within_lateness(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver((1, "2024-01-01 00:10", "a", 1), (1, "2024-01-01 00:20", "a", 2), (2, "2024-01-05 00:00", None, 1), (3, None, "a", 1))
    dedupe(landing)
    assert kept(landing) == sorted([(1, "a"), (2, None), (3, "a")], key=repr)
    landing.deliver(
        (1, "2024-01-01 01:00", "a", 3),  # a late copy
        (2, "2024-01-05 00:30", None, 2),  # a copy on time
        (3, None, "a", 2),
        (4, "2024-01-01 00:00", "a", 1),  # late and new, twice
        (4, "2024-01-01 00:00", "a", 1),
        (5, "2023-12-01 00:00", None, 1),
        (6, "2024-01-06 00:00", "b", 1),
    )
    dedupe(landing)
    want = [(1, "a"), (2, None), (3, "a"), (4, "a"), (5, None), (6, "b")]
    assert kept(landing) == sorted(want, key=repr)
    landing.deliver((4, "2024-01-01 00:00", "a", 1), (5, "2023-12-01 01:00", None, 1), (7, "2024-01-06 00:00", "b", 1))
    dedupe(landing)
    assert kept(landing) == sorted([*want, (7, "b")], key=repr)


def test_older_days_are_not_read(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver((1, "2024-01-01 00:10", "a", 1), (2, "2024-01-05 00:00", "a", 1))
    dedupe(landing)
    old = list(Path(landing.output).rglob("day=2024-01-01/*.parquet"))
    assert old
    for path in old:  # a file that cannot be read
        path.write_bytes(b"x" * 100)
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    landing.deliver((2, "2024-01-05 00:10", "a", 1), (3, "2024-01-05 00:10", "a", 1), (4, "2024-01-04 00:10", "a", 1))
    dedupe(landing)
    recent = spark.read.schema(f"{landing.schema}, day date, taken_in long").parquet(landing.output).where("day > DATE '2024-01-02'")
    assert sorted(r.id for r in recent.collect()) == [2, 3, 4]


def test_batch_that_is_run_again_replaces_its_rows(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.deliver((1, "2024-01-01 00:10", "a", 1), (2, "2024-01-05 00:00", "a", 1))
    dedupe(landing)
    landing.checkpoint += "-2"
    dedupe(landing)
    assert kept(landing) == [(1, "a"), (2, "a")]


def test_keep_first_forgets_no_key(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    for delivery in (
        [(1, "2024-01-01 00:10", "a", 1), (2, "2024-01-05 00:00", "a", 1)],
        [(1, "2020-01-01 00:20", "a", 1), (3, "2024-01-06 00:30", "a", 1), (3, "2024-01-06 00:40", "a", 1)],
        [(4, "2019-01-01 00:00", "a", 1), (2, "2029-01-05 00:00", "a", 1)],
    ):
        landing.deliver(*delivery)
        ingest.keep_first(landing.stream(), ["id"], landing.output, landing.checkpoint)
    assert sorted(r.id for r in spark.read.parquet(landing.output).collect()) == [1, 2, 3, 4]
    assert "taken_in" not in spark.read.parquet(landing.output).columns
