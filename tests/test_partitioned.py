"""Incremental runs that write only the partitions they touch."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from periodica.operators import incremental
from periodica.plans import partitioned, tables

SCHEMA = "k int, v string, at timestamp_ntz, p string"


def frame(spark, *data):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, v, day + dt.timedelta(days=d), p) for k, v, d, p in data], SCHEMA)


@pytest.fixture
def held(spark, tmp_path):
    """A table of four partitions, one of them NULL, one whose name needs escaping, one that looks like a number."""
    name = "held_" + tmp_path.name.replace("-", "_")
    rows = frame(spark, (1, "a", 0, "01"), (2, "b", 1, "01"), (3, "c", 2, "x='y'/\\z"), (4, "d", 3, None), (5, "e", 4, "q"))
    tables.run_incremental(spark, name, str(tmp_path), lambda _: rows, "merge", partition_by=["p"], keys=["k"])
    yield name
    tables.drop_table(spark, name)


def files(spark, name):
    root = Path(partitioned.location(spark, name).removeprefix("file:"))
    found = {}
    for path in root.rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def run(spark, name, source, strategy, root="no root is needed", **options):
    return tables.run_incremental(spark, name, root, lambda existing: source, strategy, **options)


def result(spark, name, *columns):
    return sorted((tuple(r) for r in spark.table(name).select(*(columns or ("k", "v", "p"))).collect()), key=repr)


def test_first_run_keeps_the_type_of_partitions(spark, held):
    assert spark.table(held).schema["p"].dataType.simpleString() == "string"
    assert (1, "a", "01") in result(spark, held) and (4, "d", None) in result(spark, held)


def test_merge_leaves_other_partitions_their_files(spark, held):
    before = files(spark, held)
    run(spark, held, frame(spark, (2, "B", 9, "01"), (6, "n", 9, "new")), "merge", keys=["k"])
    after = files(spark, held)
    assert result(spark, held) == sorted(
        [(1, "a", "01"), (2, "B", "01"), (3, "c", "x='y'/\\z"), (4, "d", None), (5, "e", "q"), (6, "n", "new")], key=repr
    )
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed == {"p=01", "p=new"}


def test_merge_moves_a_row_to_another_partition_and_empties_its_own(spark, held):
    before = files(spark, held)
    run(spark, held, frame(spark, (3, "C", 2, "01"), (4, "D", 3, "q")), "merge", keys=["k"])
    assert result(spark, held) == [(1, "a", "01"), (2, "b", "01"), (3, "C", "01"), (4, "D", "q"), (5, "e", "q")]
    left = {r.partition for r in spark.sql(f"SHOW PARTITIONS {held}").collect()}
    assert left == {"p=01", "p=q"}
    assert files(spark, held).keys() == {"p=01", "p=q"} and len(before) == 4
    run(spark, held, frame(spark, (7, "back", 0, None)), "append")
    assert (7, "back", None) in result(spark, held) and len(result(spark, held)) == 6


def test_append_adds_files_only(spark, held):
    before = files(spark, held)
    run(spark, held, frame(spark, (1, "again", 0, "01"), (8, "n", 0, "n")).drop("at"), "append", on_schema_change="append_new_columns")
    after = files(spark, held)
    assert all(before[p] <= after[p] for p in before) and after["p=q"] == before["p=q"]
    assert result(spark, held).count((1, "again", "01")) == 1 and len(result(spark, held)) == 7


def test_replacing_a_slice_empties_days_without_rows(spark, held):
    before = files(spark, held)
    options = {"event_time": "at", "start": dt.datetime(2024, 1, 2), "end": dt.datetime(2024, 1, 4)}
    run(spark, held, frame(spark, (9, "z", 1, "01")), "microbatch", **options)
    assert result(spark, held) == sorted([(1, "a", "01"), (9, "z", "01"), (4, "d", None), (5, "e", "q")], key=repr)
    after = files(spark, held)
    assert after["p=q"] == before["p=q"] and "p=__HIVE_DEFAULT_PARTITION__" in after and len(after) == 3


@pytest.mark.parametrize(
    ("strategy", "options"),
    [
        ("merge", {"keys": ["k"]}),
        ("merge", {"keys": ["k", "p"]}),
        ("merge", {"keys": ["k"], "only": ["v"]}),
        ("merge", {"keys": ["k"], "predicate": "v < 'c'"}),
        ("merge", {"keys": None}),
        ("delete_insert", {"keys": ["v"]}),
        ("delete_insert", {"keys": ["k"], "predicate": "p = '01'"}),
        ("insert_overwrite", {"predicate": "v >= 'c'"}),
        ("insert_overwrite", {"predicate": "p IS NULL"}),
        ("insert_overwrite", {}),
        ("append", {}),
    ],
)
def test_in_place_is_the_pure_strategy(spark, held, tmp_path, strategy, options):
    """What is written is what the strategy gives over the whole table."""
    if "predicate" in options:
        options = {**options, "predicate": F.expr(options["predicate"])}
    source = frame(spark, (2, "b", 5, "q"), (4, "c", 5, None), (None, "n", 5, "w"), (12, "e", 6, "01"))
    want = incremental.apply_strategy(strategy, spark.table(held), source, **options).select("k", "v", "p").collect()
    run(spark, held, source, strategy, str(tmp_path), **options)
    assert result(spark, held) == sorted((tuple(r) for r in want), key=repr)


def test_new_columns_are_added_in_place(spark, held):
    before = files(spark, held)
    source = frame(spark, (5, "E", 4, "q")).withColumn("extra", F.lit(7))
    run(spark, held, source, "merge", on_schema_change="append_new_columns", keys=["k"])
    assert files(spark, held)["p=01"] == before["p=01"]
    assert result(spark, held, "k", "extra") == [(1, None), (2, None), (3, None), (4, None), (5, 7)]


def test_retyped_columns_rebuild_the_table_with_its_partitions(spark, held, tmp_path):
    source = frame(spark, (5, "E", 4, "q")).withColumn("k", F.lit(2.5))
    tables.run_incremental(
        spark, held, str(tmp_path), lambda _: source, "merge", on_schema_change="sync_all_columns", keys=["k"]
    )
    assert partitioned.partition_columns(spark, held) == ["p"]
    assert len(result(spark, held)) == 6 and dict(spark.table(held).dtypes)["k"] == "double"


def test_failed_run_leaves_the_table(spark, held):
    before = files(spark, held), result(spark, held)
    twice = frame(spark, (5, "E", 4, "q"), (5, "F", 4, "q"))
    with pytest.raises(Exception, match="several source rows"):
        run(spark, held, twice, "merge", keys=["k"])
    assert (files(spark, held), result(spark, held)) == before


def test_source_may_read_the_table_it_changes(spark, held):
    def model(existing):
        return existing.where("k <= 2").withColumn("v", F.upper("v"))

    tables.run_incremental(spark, held, "no root is needed", model, "merge", keys=["k"])
    assert [r[1] for r in result(spark, held)][:3] == ["A", "B", "c"]


def test_only_touched_partitions_are_read(spark, held):
    target = spark.table(held)
    source = frame(spark, (5, "E", 4, "q"))
    wanted = partitioned.touched_partitions("merge", target, source, ["p"], {"keys": ["k"]})
    assert [tuple(r) for r in wanted] == [("q",)]
    pruned = target.where(partitioned.in_partitions(target.schema, ["p"], wanted))
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [struct(p" in text or "PartitionFilters: [named_struct" in text
    assert pruned.inputFiles() and {f.rsplit("/", 2)[-2] for f in pruned.inputFiles()} == {"p=q"}
    # A key that holds the partition needs no look at the target.
    keyed = partitioned.touched_partitions("merge", target.where(F.raise_error(F.lit("read")).cast("boolean")), source, ["p"], {"keys": ["k", "P"]})
    assert keyed == wanted


def test_append_to_a_table_without_partitions(spark, tmp_path):
    name, root = "flat_t", str(tmp_path)
    tables.run_incremental(spark, name, root, lambda _: spark.range(3), "append")
    before = files(spark, name)
    tables.run_incremental(spark, name, root, lambda _: spark.range(3, 5), "append")
    assert spark.table(name).count() == 5
    (old,), (new,) = before.values(), files(spark, name).values()
    assert old < new
    tables.drop_table(spark, name)


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(200_000).select(F.rand(1).alias("v"), F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("p"))
        tables.overwrite_partitions(rows, str(tmp_path / "t"), ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=hot").glob("*.parquet"))) > 1
