"""Physical plans: what is pushed down, combined before a shuffle, and not broadcast by force."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from periodica.operators import checks, incremental, joins
from periodica.operators.dedupe import attach_latest, keep_latest
from periodica.operators.series import add_metrics
from periodica.operators.snapshot import SnapshotConfig, apply, changes, initial
from periodica.plans import history as stored_history

PACKAGE = Path(__file__).resolve().parents[1] / "periodica"


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders") / "t")
    spark.range(2000).select(
        "id",
        (F.col("id") % 50).alias("k"),
        F.timestamp_add("DAY", F.col("id") % 900, F.lit("2020-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("id").cast("double").alias("v"),
        F.lit("text").alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_dedupe_limits_each_key_before_the_shuffle(orders):
    text = plan(keep_latest(orders.select("k", "ts", "id"), ["k"], ["ts", "id"]))
    assert "row_number(), 1, Partial" in text
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")
    assert "unused" not in text


def test_metrics_run_on_one_shuffle(orders):
    monthly = orders.groupBy("k", F.last_day("ts").alias("d")).agg(F.sum("v").alias("UNITS")).withColumn("f", F.lit("M"))
    assert exchanges(add_metrics(monthly, ["k"], "d", "f")) == exchanges(monthly) + 1


def test_small_source_does_not_shuffle_the_target(orders):
    source = orders.where("id < 10")
    text = plan(incremental.merge(orders, source, ["id"]))
    assert text.count("BroadcastHashJoin") >= 2


def test_merge_in_one_pass_shuffles_each_side_once(spark, orders, tight):
    merged = incremental.merge(orders, orders.where("k < 40"), ["id"], one_pass=True)
    assert exchanges(merged) == 2 and plan(merged).count("FullOuter") == 1


def test_history_passes_closed_rows_through(orders):
    cfg = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="invalidate")
    history = initial(orders, cfg, "2025-01-01")
    text = plan(apply(history, orders, cfg, "2025-01-02"))
    assert text.count("FullOuter") == 1


def test_small_source_moves_no_open_row(orders, tmp_path):
    """Where nothing can vanish, neither the whole history nor its changes shuffle the open rows."""
    cfg = SnapshotConfig(keys=["id"], updated_at="ts", versions_unique=True)
    path = str(tmp_path / "h")
    initial(orders, cfg, "2025-01-01").write.parquet(path)
    history = orders.sparkSession.read.parquet(path)
    source = orders.where("id < 4")
    for result in (apply(history, source, cfg, "2025-01-02"), changes(history, history.limit(0), source, cfg, "2025-01-02")):
        result.count()
        text = plan(result.select("v", "unused"))
        # Rows of the history have ``scd_id``; below an exchange they may only be scanned for their keys.
        for below in re.split(r"Exchange hashpartitioning", text)[1:]:
            assert "valid_from" not in below.split("\n")[0]
        assert "BroadcastHashJoin" in text


def test_stored_history_moves_each_row_once(orders, tight):
    """Ids and times of new versions are made after the join, and open rows are dealt out once to drop ended ones."""
    cfg = SnapshotConfig(keys=["id"], updated_at="ts", hard_deletes="invalidate")
    history = initial(orders, cfg, "2025-01-01")
    changed = changes(history.withColumn("valid_from", F.col("valid_from")), history.limit(0), orders, cfg, "2025-01-02")
    joined = plan(changed).split("FullOuter")[1].split("Exchange hashpartitioning(_new_id")[1]
    assert "md5" not in joined.split("FileScan")[0]
    rows = history.select("id", "scd_id", (F.col("id") % 3).alias("_was"), (F.col("id") % 8).cast("int").alias("bucket"))
    text = plan(stored_history._without_ended(rows, "scd_id"))
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning" in text


def test_not_null_checks_share_one_scan(orders):
    text = plan(checks.aggregated_not_null(orders, ["id", "k", "v"]))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_filters_reach_the_scan(orders):
    kept = incremental.replace_period(orders, orders.limit(0), "ts", F.lit("2020-02-01").cast("timestamp_ntz"), F.lit("2020-03-01").cast("timestamp_ntz"))
    assert "PushedFilters" in plan(kept)
    assert "GreaterThanOrEqual(ts" in plan(orders.where(F.col("ts") >= F.lit("2020-02-01").cast("timestamp_ntz")))


@pytest.fixture
def tight(spark):
    """Thresholds at which a few thousand rows count as skewed, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4kb",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_keys_are_split(spark, tight, tmp_path):
    """A third of the rows share one key; every row-side join splits its partition."""
    path = str(tmp_path / "hot")
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    spark.range(0, 60_000, 1, 12).select(key.alias("k"), "id", F.col("id").cast("string").alias("v")).write.parquet(path)
    hot = spark.read.parquet(path)
    source = hot.where("id % 2 = 1").dropDuplicates(["k"])
    want = hot.count()
    for result, rows in [
        (incremental.merge(hot, source, ["k"]), want),
        (attach_latest(hot, ["k"], ["id"], "v", "latest"), want),
        (joins.rows_without(hot, source.where("k > 0"), ["k"]), None),
        (joins.rows_with(hot, source, ["k"]), None),
        (incremental.delete_insert(hot, source, ["k"]), None),
    ]:
        count = len(result.collect())
        assert rows is None or count == rows
        assert "skew=true" in plan(result)


@pytest.mark.parametrize("pattern", [r"\bbroadcast\(", r"localCheckpoint", r"crossJoin", r"\.toPandas\(", r"\.collect\(\)", r"\.rdd\b"])
def test_library_avoids(pattern):
    found = [str(p) for p in PACKAGE.rglob("*.py") if "llm" not in p.parts and re.search(pattern, p.read_text())]
    assert found == []
