"""Histories in two stores: same rows as the pure operator, small writes, runs that failed in between."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from periodica.operators import snapshot
from periodica.operators.snapshot import MetaNames, SnapshotConfig
from periodica.plans import history as stored
from periodica.streaming import ingest

SCHEMA = "id int, v string, ts timestamp_ntz"
META = MetaNames()


def rows_of(spark, *data):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, v, None if d is None else day + dt.timedelta(days=d)) for i, v, d in data], SCHEMA)


# Keys change, vanish, come back with a new and with an old time; one row never changes; one key is NULL.
RUNS = [
    [(1, "a", 0), (2, "b", 0), (3, "c", 0), (4, "d", None), (None, "n", 0)],
    [(1, "A", 1), (2, "b", 0), (4, "d", None), (5, "e", 1)],
    [(1, "A", 1), (2, "b", 0), (3, "c", 5), (5, "e", 1), (None, "n", 0)],
    [(1, "a", 2), (3, "c", 5), (4, "x", 6), (5, "e", 1)],
    [(1, "a", 2), (2, "b", 0), (3, "c", 5), (4, "x", 6), (5, "E", 7)],
]


def now(run):
    return f"2025-01-0{run + 1} 00:00:00"


def plain(df):
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"hard_deletes": "new_record"},
        {"hard_deletes": "invalidate", "open_until": "2199-12-31 00:00:00"},
        {"strategy": "check", "updated_at": None, "check_columns": ["v"], "hard_deletes": "invalidate"},
    ],
)
def test_stored_runs_are_the_pure_runs(spark, tmp_path, options):
    cfg = SnapshotConfig(**{"keys": ["id"], "updated_at": "ts", **options})
    root, held = str(tmp_path), None
    for run, data in enumerate(RUNS):
        source = rows_of(spark, *data)
        held = snapshot.apply(held, source, cfg, now(run)) if held else snapshot.initial(source, cfg, now(run))
        held.write.parquet(f"{root}/pure/{run}")
        held = spark.read.parquet(f"{root}/pure/{run}")
        stored.advance(source, cfg, now(run), f"{root}/store", run, buckets=3)
        assert plain(stored.history(spark, f"{root}/store")) == plain(held)


def files(root, store):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root, store).rglob("*.parquet")}


def test_second_run_writes_only_what_changes(spark, tmp_path):
    cfg, root = SnapshotConfig(keys=["id"], updated_at="ts"), str(tmp_path)
    stored.advance(rows_of(spark, *[(i, "a", 0) for i in range(200)]), cfg, now(0), root, 0, buckets=16)
    before = files(root, "open")
    stored.advance(rows_of(spark, (7, "b", 1), (8, "a", 0), (900, "n", 1)), cfg, now(1), root, 1)
    changed = spark.read.parquet(f"{root}/changes").where("run = 1")
    assert sorted((r.id, r[snapshot.KIND]) for r in changed.collect()) == [(7, "closed"), (7, "opened"), (900, "opened")]
    buckets = {p.split("/")[1] for p in before.keys() ^ files(root, "open").keys()}
    assert 1 <= len(buckets) <= 2
    history = stored.history(spark, root)
    assert history.count() == 202 and history.where("valid_to IS NULL").count() == 201
    after = files(root, "open"), files(root, "changes")
    stored.advance(rows_of(spark, (7, "b", 1)), cfg, now(2), root, 2)
    assert files(root, "open") == after[0]


def test_closed_ids_are_looked_up_where_there_are_any(spark, tmp_path, monkeypatch):
    """The first two runs have no closed version; in the third run key 2 comes back with its old time and adds nothing."""
    cfg, root = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="invalidate"), str(tmp_path)
    spared, changes = [], snapshot.changes
    monkeypatch.setattr(snapshot, "changes", lambda *a: spared.append(a[3].versions_unique) or changes(*a))
    for run, data in enumerate([[(1, "a", 0), (2, "b", 0)], [(1, "a", 0)], [(1, "a", 0), (2, "b", 0)]]):
        stored.advance(rows_of(spark, *data), cfg, now(run), root, run, buckets=2)
    assert spared == [True, False]
    assert sorted((r.id, r.valid_to is None) for r in stored.history(spark, root).collect()) == [(1, True), (2, False)]


def test_vanished_rows_empty_their_bucket(spark, tmp_path):
    cfg, root = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="invalidate"), str(tmp_path)
    stored.advance(rows_of(spark, (1, "a", 0), (2, "b", 0)), cfg, now(0), root, 0, buckets=64)
    stored.advance(rows_of(spark).limit(0), cfg, now(1), root, 1)
    history = stored.history(spark, root)
    assert history.count() == 2 and history.where("valid_to IS NULL").count() == 0


@pytest.mark.parametrize("stop", ["staged", "applied", "half"])
def test_run_that_failed_is_finished_by_the_next_call(spark, tmp_path, monkeypatch, stop):
    cfg = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="new_record")
    root = str(tmp_path)
    for run in (0, 1):
        stored.advance(rows_of(spark, *RUNS[run]), cfg, now(run), f"{root}/whole", run, buckets=3)
    want = plain(stored.history(spark, f"{root}/whole"))
    root += "/broken"
    stored.advance(rows_of(spark, *RUNS[0]), cfg, now(0), root, 0, buckets=3)
    overwrite, mark = stored.overwrite_partitions, stored._mark

    def fail(*args):
        raise RuntimeError("lost")

    def half(rows, path, by):
        overwrite(rows.where(f"{stored.BUCKET} <> 1"), path, by)
        raise RuntimeError("lost")

    if stop == "staged":
        monkeypatch.setattr(stored, "overwrite_partitions", fail)
    elif stop == "half":
        monkeypatch.setattr(stored, "overwrite_partitions", half)
    else:
        monkeypatch.setattr(stored, "_mark", lambda *a: fail() if a[3] == stored.DONE else mark(*a))
    with pytest.raises(RuntimeError, match="lost"):
        stored.advance(rows_of(spark, *RUNS[1]), cfg, now(1), root, 1)
    monkeypatch.undo()
    stored.advance(rows_of(spark, (99, "not looked at", 0)), cfg, now(1), root, 1)
    assert plain(stored.history(spark, root)) == want
    stored.advance(rows_of(spark, *RUNS[2]), cfg, now(2), root, 2)
    stored.advance(rows_of(spark, *RUNS[2]), cfg, now(2), f"{tmp_path}/whole", 2)
    assert plain(stored.history(spark, root)) == plain(stored.history(spark, f"{tmp_path}/whole"))


def test_changes_that_were_not_complete_are_written_again(spark, tmp_path, monkeypatch):
    cfg, root = SnapshotConfig(keys=["id"], updated_at="ts"), str(tmp_path)
    stored.advance(rows_of(spark, *RUNS[0]), cfg, now(0), root, 0)
    mark = stored._mark
    monkeypatch.setattr(stored, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        stored.advance(rows_of(spark, (77, "x", 0)), cfg, now(1), root, 1)
    monkeypatch.setattr(stored, "_mark", mark)
    assert 77 not in {r.id for r in stored.history(spark, root).collect()}
    stored.advance(rows_of(spark, (78, "y", 0)), cfg, now(1), root, 1)
    assert {78} == {r.id for r in stored.history(spark, root).collect()} - {1, 2, 3, 4, None}


def test_new_columns_and_other_spelling(spark, tmp_path):
    cfg, root = SnapshotConfig(keys=["id"], updated_at="ts"), str(tmp_path)
    stored.advance(rows_of(spark, (1, "a", 0), (2, "b", 0)), cfg, now(0), root, 0, buckets=8)
    source = rows_of(spark, (1, "A", 1), (3, "c", 1)).withColumnRenamed("v", "V").withColumn("w", F.lit(5))
    stored.advance(source, cfg, now(1), root, 1)
    history = stored.history(spark, root)
    assert sorted((r.id, r.v, r.w) for r in history.collect() if r.w) == [(1, "A", 5), (3, "c", 5)]
    assert history.count() == 4 and "V" not in history.columns


def test_stream_of_runs(spark, tmp_path):
    cfg = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="invalidate")
    landing, root, mark = (str(tmp_path / n) for n in ("in", "history", "ck"))
    held = None
    for runs in ([0], [2, 1], [3, 4]):  # several runs of one delivery, not in order of their files
        for run in runs:
            rows = rows_of(spark, *RUNS[run]).where("id IS NOT NULL").withColumn("at", F.lit(now(run)).cast("timestamp_ntz"))
            rows.write.mode("append").parquet(landing)
        stream = ingest.read_files(spark, landing, rows.schema)
        ingest.stream_stored_history(stream, cfg, "at", root, mark, buckets=4)
    for run, data in enumerate(RUNS):
        source = rows_of(spark, *data).where("id IS NOT NULL")
        held = snapshot.apply(held, source, cfg, now(run)) if held else snapshot.initial(source, cfg, now(run))
    assert plain(stored.history(spark, root)) == plain(held)
    rows.unionByName(rows).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="more than once"):
        ingest.stream_stored_history(ingest.read_files(spark, landing, rows.schema), cfg, "at", root, mark)


def test_history_that_has_not_begun(spark, tmp_path):
    with pytest.raises(ValueError, match="no finished run"):
        stored.history(spark, str(tmp_path))
