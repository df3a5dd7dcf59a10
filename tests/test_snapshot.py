import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from periodica.operators.snapshot import MetaNames, SnapshotConfig, apply, initial, time_type_warning, vanished_keys

DAYS = [dt.datetime(2024, 1, d) for d in range(1, 10)]
NOW = [dt.datetime(2025, 1, d) for d in range(1, 10)]
LAYOUT = "id int, v string, updated_at timestamp_ntz"


def frame(spark, *data):
    return spark.createDataFrame(list(data), LAYOUT)


def periods(history, *more):
    names = ["id", "v", "valid_from", "valid_to", *more]
    return sorted((tuple(r) for r in history.select(*names).collect()), key=repr)


def test_timestamp_strategy(spark):
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at")
    history = initial(frame(spark, (1, "a", DAYS[0]), (2, "b", DAYS[0]), (3, "c", None)), cfg, NOW[0])
    source = frame(spark, (1, "A", DAYS[1]), (2, "not newer", DAYS[0]), (3, "no time", None), (4, "d", DAYS[1]))
    got = periods(apply(history, source, cfg, NOW[1]))
    assert got == sorted(
        [(1, "a", DAYS[0], DAYS[1]), (1, "A", DAYS[1], None), (2, "b", DAYS[0], None), (3, "c", None, None), (4, "d", DAYS[1], None)],
        key=repr,
    )
    again = apply(apply(history, source, cfg, NOW[1]), source, cfg, NOW[2])
    assert periods(again) == got


def test_check_strategy_is_null_safe(spark):
    cfg = SnapshotConfig(keys=["id"], strategy="check", check_columns=["v"])
    history = initial(frame(spark, (1, None, None), (2, "b", None), (3, None, None)), cfg, NOW[0])
    got = periods(apply(history, frame(spark, (1, "a", None), (2, None, None), (3, None, None)), cfg, NOW[1]))
    assert len(got) == 5
    assert (3, None, NOW[0], None) in got and (1, None, NOW[0], NOW[1]) in got and (2, None, NOW[1], None) in got


def test_check_all_columns_and_added_column(spark):
    cfg = SnapshotConfig(keys=["id"], strategy="check")
    source = frame(spark, (1, "a", DAYS[0]))
    history = initial(source, cfg, NOW[0])
    assert apply(history, source, cfg, NOW[1]).count() == 1
    wider = apply(history, source.withColumn("extra", F.lit(1)), cfg, NOW[1])
    assert sorted(r.extra or 0 for r in wider.collect()) == [0, 1]
    changed = apply(history, frame(spark, (1, "a", DAYS[1])), cfg, NOW[1])
    assert changed.count() == 2


def test_invalidate_and_return_with_the_old_time(spark):
    """A key that comes back unchanged repeats a closed version's id, so nothing is added."""
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", hard_deletes="invalidate")
    first = frame(spark, (1, "a", DAYS[0]), (2, "b", DAYS[0]))
    closed = apply(initial(first, cfg, NOW[0]), frame(spark, (2, "b", DAYS[0])), cfg, NOW[1])
    assert periods(closed) == [(1, "a", DAYS[0], NOW[1]), (2, "b", DAYS[0], None)]
    assert periods(apply(closed, first, cfg, NOW[2])) == periods(closed)
    back = apply(closed, frame(spark, (1, "a", DAYS[3]), (2, "b", DAYS[0])), cfg, NOW[2])
    assert (1, "a", DAYS[3], None) in periods(back)


@pytest.mark.parametrize("sentinel", [None, "9999-12-31 00:00:00"])
def test_new_record_life_cycle(spark, sentinel):
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", hard_deletes="new_record", open_until=sentinel)
    end = dt.datetime.fromisoformat(sentinel) if sentinel else None
    one, none = frame(spark, (1, "a", DAYS[0])), frame(spark)
    history = initial(one, cfg, NOW[0])
    history = apply(history, none, cfg, NOW[1])
    deleted = [(1, "a", DAYS[0], NOW[1], "False"), (1, "a", NOW[1], end, "True")]
    assert periods(history, "is_deleted") == sorted(deleted, key=repr)
    assert periods(apply(history, none, cfg, NOW[2]), "is_deleted") == sorted(deleted, key=repr)
    history = apply(history, frame(spark, (1, "b", DAYS[5])), cfg, NOW[3])
    history = apply(history, none, cfg, NOW[4])
    assert periods(history, "is_deleted") == sorted(
        [
            deleted[0],
            (1, "a", NOW[1], DAYS[5], "True"),
            (1, "b", DAYS[5], NOW[4], "False"),
            (1, "b", NOW[4], end, "True"),
        ],
        key=repr,
    )


def test_same_run_time_closes_without_reopening(spark):
    """Two check runs at one time would give both versions one id; only the first keeps it."""
    cfg = SnapshotConfig(keys=["id"], strategy="check", check_columns=["v"])
    history = initial(frame(spark, (1, "a", None)), cfg, NOW[0])
    assert periods(apply(history, frame(spark, (1, "b", None)), cfg, NOW[0])) == [(1, "a", NOW[0], NOW[0])]


def test_switched_off_hard_deletes_still_know_old_versions(spark):
    first = frame(spark, (1, "a", DAYS[0]))
    strict = SnapshotConfig(keys=["id"], updated_at="updated_at", hard_deletes="invalidate")
    closed = apply(initial(first, strict, NOW[0]), frame(spark), strict, NOW[1])
    relaxed = SnapshotConfig(keys=["id"], updated_at="updated_at")
    assert periods(apply(closed, first, relaxed, NOW[2])) == [(1, "a", DAYS[0], NOW[1])]


def test_trusted_versions_skip_the_look_up(spark):
    rows = frame(spark, (1, "a", DAYS[0]), (2, "b", DAYS[0]))
    newer = frame(spark, (1, "A", DAYS[1]), (3, "c", DAYS[1]))
    results = []
    for trusted in (False, True):
        cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", versions_unique=trusted)
        results.append(periods(apply(initial(rows, cfg, NOW[0]), newer, cfg, NOW[1])))
    assert results[0] == results[1]


def test_null_keys_never_match(spark):
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", hard_deletes="invalidate")
    rows = frame(spark, (None, "a", DAYS[0]), (None, "b", DAYS[1]))
    history = apply(initial(rows, cfg, NOW[0]), frame(spark, (None, "c", DAYS[2])), cfg, NOW[1])
    assert periods(history) == sorted(
        [(None, "a", DAYS[0], NOW[1]), (None, "b", DAYS[1], NOW[1]), (None, "c", DAYS[2], None)], key=repr
    )


def test_meta_names_and_vanished_keys(spark):
    names = MetaNames("f", "t", "i", "u", "d")
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", names=names)
    history = initial(frame(spark, (1, "a", DAYS[0]), (2, "b", DAYS[0])), cfg, NOW[0])
    assert history.columns == ["id", "v", "updated_at", "i", "u", "f", "t"]
    assert [r.id for r in vanished_keys(history, frame(spark, (1, "a", DAYS[0])), cfg).collect()] == [2]


def test_bad_configurations():
    for options in [{"strategy": "x"}, {}, {"strategy": "check", "check_columns": []}, {"updated_at": "u", "hard_deletes": "x"}]:
        with pytest.raises(ValueError):
            SnapshotConfig(keys=["id"], **options)


def test_time_type_warning(spark):
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at")
    source = frame(spark, (1, "a", DAYS[0]))
    assert time_type_warning(source, cfg) is None
    assert "date" in time_type_warning(source.withColumn("updated_at", F.to_date("updated_at")), cfg)


def simulate(runs, hard_deletes):
    """The rules one key at a time, in plain Python."""
    history, ids = [], set()
    for number, (now, source) in enumerate(runs):
        for key in sorted({r["id"] for r in history} | set(source)):
            opened = next((r for r in history if r["id"] == key and r["to"] is None), None)
            new = source.get(key)
            if new is None:
                if opened and hard_deletes != "ignore" and not opened["deleted"]:
                    opened["to"] = now
                    if hard_deletes == "new_record":
                        history.append({"id": key, "v": opened["v"], "from": now, "to": None, "deleted": True})
                continue
            value, time = new
            if opened is None or opened["from"] < time or opened["deleted"]:
                if opened:
                    opened["to"] = time
                if (key, time) not in ids:
                    ids.add((key, time))
                    history.append({"id": key, "v": value, "from": time, "to": None, "deleted": False})
    return sorted(((r["id"], r["v"], r["from"], r["to"]) for r in history), key=repr)


@pytest.mark.parametrize("hard_deletes", ["ignore", "invalidate", "new_record"])
def test_random_runs_against_simulation(spark, hard_deletes):
    """Random inserts, changes, deletes and returns; also at most one open row per key."""
    pick = random.Random(7)
    cfg = SnapshotConfig(keys=["id"], updated_at="updated_at", hard_deletes=hard_deletes)
    runs, history = [], None
    time = {k: DAYS[0] for k in range(30)}
    for run in range(4):
        for key in time:
            if pick.random() < 0.4:
                time[key] = DAYS[run + 1]
        source = {k: (f"v{k}-{time[k]:%d}", time[k]) for k in time if pick.random() < 0.7}
        runs.append((NOW[run], source))
        rows = frame(spark, *[(k, v, t) for k, (v, t) in source.items()])
        history = initial(rows, cfg, NOW[run]) if history is None else apply(history, rows, cfg, NOW[run])
        history = history.checkpoint() if spark.sparkContext.getCheckpointDir() else spark.createDataFrame(history.collect(), history.schema)
    assert periods(history) == simulate(runs, hard_deletes)
    assert history.where("valid_to IS NULL").groupBy("id").count().where("count > 1").count() == 0
