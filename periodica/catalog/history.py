"""Slowly changing history over the orders table.

Day 0 holds the orders up to the end of 1999. Day 1 finishes pending orders (a later update time),
adds the newer orders, and lacks the low-priority open ones; day 2 has those back with a still later
update time; day 3 is like day 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.catalog.bindings import TARGET_END, restated, with_sql
from periodica.catalog.registry import query
from periodica.functions.scalars import canonical_time, version_hash
from periodica.operators.snapshot import SnapshotConfig, apply, initial
from periodica.plans import history as stored
from periodica.plans.tables import replace_folder
from periodica.session import table, work_dir

NOW = ["2002-01-01 00:00:00", "2003-01-01 00:00:00", "2004-01-01 00:00:00", "2005-01-01 00:00:00"]
COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "updated_at"]


def _later(days: int):
    return F.timestamp_add("DAY", F.lit(days), F.col("o_orderdate"))


def _withdrawn():
    return (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O")


def day0(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders").where(
        F.col("o_orderdate") < F.lit(TARGET_END).cast("timestamp_ntz")
    )
    return orders.withColumn("updated_at", F.col("o_orderdate")).select(*COLUMNS)


def day1(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders").where(~_withdrawn())
    pending = F.col("o_orderstatus") == "P"
    timed = orders.withColumn("updated_at", F.when(pending, _later(400)).otherwise(F.col("o_orderdate")))
    return restated(timed).select(*COLUMNS)


def day2(spark, folder) -> DataFrame:
    back = table(spark, folder, "orders").where(_withdrawn()).withColumn("updated_at", _later(500))
    return day1(spark, folder).unionByName(back.select(*COLUMNS))


def _id(key: str, time: str) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|' || strftime({time}, '%Y-%m-%d %H:%M:%S.%f'))"


def _stamp(now: str) -> str:
    return f"TIMESTAMP '{now}'"


DAYS = f"""
base AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate, o_orderstatus = 'P' AS pending,
         o_orderpriority = '5-LOW' AND o_orderstatus = 'O' AS withdrawn, o_orderdate < TIMESTAMP '{TARGET_END}' AS early,
         CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status1,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 100.0 ELSE o_totalprice END AS price1,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS upd1,
         o_orderdate + INTERVAL 500 DAY AS upd2
  FROM orders)"""


def _row(status: str, price: str, upd: str, valid_to: str, where: str, extra: str = "") -> str:
    return (
        f"SELECT o_orderkey, {status} AS o_orderstatus, {price} AS o_totalprice, o_orderpriority, {upd} AS updated_at, "
        f"{_id('o_orderkey', upd)} AS scd_id, {upd} AS version_updated_at, {upd} AS valid_from, {valid_to} AS valid_to"
        f"{extra} FROM base WHERE {where}"
    )


NO_END = "CAST(NULL AS TIMESTAMP)"
NO_CLERK = ", CAST(NULL AS VARCHAR) AS o_clerk"
CLERK = ", 'clerk ' || o_orderpriority AS o_clerk"


def two_days(open_end: str, gone_end: str, extra: str = "") -> str:
    """History after days 0 and 1 for the timestamp strategy."""
    first = ("o_orderstatus", "o_totalprice", "o_orderdate")
    return "\nUNION ALL ".join(
        [
            _row(*first, open_end, "early AND NOT pending AND NOT withdrawn", extra),
            _row(*first, gone_end, "early AND withdrawn", extra),
            _row(*first, "upd1", "early AND pending", extra),
            _row("status1", "price1", "upd1", open_end, "early AND pending", extra),
            _row("status1", "price1", "upd1", open_end, "NOT early AND NOT withdrawn", extra),
        ]
    )


def _after_day1(spark, folder, config: SnapshotConfig) -> DataFrame:
    return apply(initial(day0(spark, folder), config, NOW[0]), day1(spark, folder), config, NOW[1])


def _config(**options) -> SnapshotConfig:
    return SnapshotConfig(keys=["o_orderkey"], updated_at="updated_at", **options)


@query("scd2_initial", with_sql(DAYS, _row("o_orderstatus", "o_totalprice", "o_orderdate", NO_END, "early")))
def scd2_initial(spark, folder):
    return initial(day0(spark, folder), _config(), NOW[0])


@query("scd2_timestamp", with_sql(DAYS, two_days(NO_END, NO_END)))
def scd2_timestamp(spark, folder):
    return _after_day1(spark, folder, _config())


@query("scd2_invalidate", with_sql(DAYS, two_days(NO_END, _stamp(NOW[1]))))
def scd2_invalidate(spark, folder):
    return _after_day1(spark, folder, _config(hard_deletes="invalidate"))


@query("scd2_sentinel", with_sql(DAYS, two_days("TIMESTAMP '2199-12-31'", _stamp(NOW[1]))))
def scd2_sentinel(spark, folder):
    return _after_day1(spark, folder, _config(hard_deletes="invalidate", open_until="2199-12-31 00:00:00"))


def _tombstone(before: str, upd: str, time: str, valid_to: str, where: str) -> str:
    return (
        f"SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, {upd} AS updated_at, "
        f"md5({before} || '|' || strftime({time}, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, {time} AS version_updated_at, "
        f"{time} AS valid_from, {valid_to} AS valid_to, 'True' AS is_deleted FROM base WHERE {where}"
    )


def _four_days() -> str:
    kept = ", 'False' AS is_deleted"
    original, again = _id("o_orderkey", "o_orderdate"), _id("o_orderkey", "upd2")
    return "\nUNION ALL ".join(
        [
            two_days(NO_END, _stamp(NOW[1]), kept),
            _tombstone(original, "o_orderdate", _stamp(NOW[1]), "upd2", "early AND withdrawn"),
            _row("o_orderstatus", "o_totalprice", "upd2", _stamp(NOW[3]), "withdrawn", kept),
            _tombstone(again, "upd2", _stamp(NOW[3]), NO_END, "withdrawn"),
        ]
    )


@query("scd2_new_record", with_sql(DAYS, _four_days()))
def scd2_new_record(spark, folder):
    """Four runs: keys vanish, come back and vanish again. Each run reads the table of the last."""
    config = _config(hard_deletes="new_record")
    root = work_dir(spark, "history")
    history = replace_folder(initial(day0(spark, folder), config, NOW[0]), f"{root}/run0")
    history = replace_folder(apply(history, day1(spark, folder), config, NOW[1]), f"{root}/run1")
    history = replace_folder(apply(history, day2(spark, folder), config, NOW[2]), f"{root}/run2")
    return apply(history, day1(spark, folder), config, NOW[3])


@query("snapshot_run", with_sql(DAYS, _four_days()))
def snapshot_run(spark, folder):
    """The runs of ``scd2_new_record`` over stored rows: closed versions are added, open rows replaced by bucket."""
    config = _config(hard_deletes="new_record")
    root = work_dir(spark, "snapshot")
    days = [day0(spark, folder), day1(spark, folder), day2(spark, folder), day1(spark, folder)]
    for run, (now, source) in enumerate(zip(NOW, days)):
        stored.advance(source, config, now, root, run, buckets=8)
    return stored.history(spark, root)


@query(
    "snapshot_run_columns",
    with_sql(
        DAYS,
        "\nUNION ALL ".join(
            [
                _row("o_orderstatus", "o_totalprice", "o_orderdate", NO_END, "early AND NOT pending", NO_CLERK),
                _row("o_orderstatus", "o_totalprice", "o_orderdate", "upd1", "early AND pending", NO_CLERK),
                _row("status1", "price1", "upd1", NO_END, "early AND pending", CLERK),
                _row("status1", "price1", "upd1", NO_END, "NOT early AND NOT withdrawn", CLERK),
            ]
        ),
    ),
)
def snapshot_run_columns(spark, folder):
    """A stored history to which the second run adds a column; it is run twice, as after a failure."""
    root = work_dir(spark, "snapshot")
    source = day1(spark, folder).withColumn("o_clerk", F.concat(F.lit("clerk "), "o_orderpriority"))
    stored.advance(day0(spark, folder), _config(), NOW[0], root, 0, buckets=8)
    for _ in range(2):
        stored.advance(source, _config(), NOW[1], root, 1)
    return stored.history(spark, root)


def _check_row(status: str, price: str, upd: str, now: str, valid_to: str, where: str) -> str:
    return (
        f"SELECT o_orderkey, {status} AS o_orderstatus, {price} AS o_totalprice, o_orderpriority, {upd} AS updated_at, "
        f"{_id('o_orderkey', _stamp(now))} AS scd_id, {_stamp(now)} AS version_updated_at, {_stamp(now)} AS valid_from, "
        f"{valid_to} AS valid_to FROM base WHERE {where}"
    )


@query(
    "scd2_check",
    with_sql(
        DAYS,
        "\nUNION ALL ".join(
            [
                _check_row("o_orderstatus", "o_totalprice", "o_orderdate", NOW[0], NO_END, "early AND NOT pending"),
                _check_row("o_orderstatus", "o_totalprice", "o_orderdate", NOW[0], _stamp(NOW[1]), "early AND pending"),
                _check_row("status1", "price1", "upd1", NOW[1], NO_END, "early AND pending"),
                _check_row("status1", "price1", "upd1", NOW[1], NO_END, "NOT early AND NOT withdrawn"),
            ]
        ),
    ),
)
def scd2_check(spark, folder):
    config = SnapshotConfig(
        keys=["o_orderkey"], strategy="check", check_columns=["o_orderstatus", "o_totalprice"]
    )
    return _after_day1(spark, folder, config)


@query(
    "scd2_new_column",
    with_sql(
        DAYS,
        "\nUNION ALL ".join(
            [
                _row("o_orderstatus", "o_totalprice", "o_orderdate", NO_END, "early AND NOT pending", NO_CLERK),
                _row("o_orderstatus", "o_totalprice", "o_orderdate", "upd1", "early AND pending", NO_CLERK),
                _row("status1", "price1", "upd1", NO_END, "early AND pending", CLERK),
                _row("status1", "price1", "upd1", NO_END, "NOT early AND NOT withdrawn", CLERK),
            ]
        ),
    ),
)
def scd2_new_column(spark, folder):
    """Day 1 brings a column the history does not have."""
    config = _config()
    source = day1(spark, folder).withColumn("o_clerk", F.concat(F.lit("clerk "), "o_orderpriority"))
    return apply(initial(day0(spark, folder), config, NOW[0]), source, config, NOW[1])


@query(
    "scd2_hash",
    "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || coalesce(nullif(o_orderstatus, 'P'), '') || '|' || "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id FROM orders",
)
def scd2_hash(spark, folder):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, folder, "orders").select(
        "o_orderkey", version_hash("o_orderkey", status, canonical_time("o_orderdate")).alias("scd_id")
    )
