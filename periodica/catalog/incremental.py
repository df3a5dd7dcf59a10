"""Incremental strategies over two versions of the orders and events tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from periodica.catalog.bindings import (
    SOURCE_START,
    TARGET_SOURCE,
    money,
    orders_source,
    orders_target,
    with_sql,
)
from periodica.catalog.registry import query
from periodica.operators import incremental
from periodica.plans import tables
from periodica.session import table, work_dir

ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
UNMATCHED = "SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)"
NEW = "SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)"


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("incr_append", with_sql(TARGET_SOURCE, "SELECT * FROM tgt UNION ALL SELECT * FROM src"))
def incr_append(spark, folder):
    return incremental.append(orders_target(spark, folder), orders_source(spark, folder))


@query("merge_upsert", with_sql(TARGET_SOURCE, f"{UNMATCHED} UNION ALL SELECT * FROM src"))
def merge_upsert(spark, folder):
    return incremental.merge(orders_target(spark, folder), orders_source(spark, folder), ["o_orderkey"])


@query("merge_one_pass", with_sql(TARGET_SOURCE, f"{UNMATCHED} UNION ALL SELECT * FROM src"))
def merge_one_pass(spark, folder):
    """The merge of ``merge_upsert`` in one join, for a source of the target's size."""
    target, source = orders_target(spark, folder), orders_source(spark, folder)
    return incremental.merge(target, source, ["o_orderkey"], one_pass=True)


@query(
    "merge_update_columns",
    with_sql(
        TARGET_SOURCE,
        f"""{UNMATCHED} UNION ALL {NEW} UNION ALL
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, s.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM tgt t JOIN src s ON t.o_orderkey = s.o_orderkey""",
    ),
)
def merge_update_columns(spark, folder):
    return incremental.merge(
        orders_target(spark, folder), orders_source(spark, folder), ["o_orderkey"], only=["o_totalprice"]
    )


@query(
    "merge_exclude_columns",
    with_sql(
        TARGET_SOURCE,
        f"""{UNMATCHED} UNION ALL {NEW} UNION ALL
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, t.o_totalprice, s.o_orderdate, s.o_orderpriority
FROM tgt t JOIN src s ON t.o_orderkey = s.o_orderkey""",
    ),
)
def merge_exclude_columns(spark, folder):
    return incremental.merge(
        orders_target(spark, folder), orders_source(spark, folder), ["o_orderkey"], exclude=["O_TOTALPRICE"]
    )


@query(
    "merge_predicate",
    with_sql(
        TARGET_SOURCE,
        "SELECT * FROM tgt WHERE o_orderdate < TIMESTAMP '1999-10-01' OR o_orderkey NOT IN "
        "(SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src",
    ),
)
def merge_predicate(spark, folder):
    return incremental.merge(
        orders_target(spark, folder),
        orders_source(spark, folder),
        ["o_orderkey"],
        predicate=F.col("o_orderdate") >= moment("1999-10-01"),
    )


@query("merge_no_key", with_sql(TARGET_SOURCE, "SELECT * FROM tgt UNION ALL SELECT * FROM src"))
def merge_no_key(spark, folder):
    return incremental.merge(orders_target(spark, folder), orders_source(spark, folder), None)


@query(
    "delete_insert",
    with_sql(
        f"""{TARGET_SOURCE},
t AS (SELECT * REPLACE (nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority) FROM tgt),
s AS (SELECT * REPLACE (nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority) FROM src)""",
        """SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE s.o_custkey = t.o_custkey AND s.o_orderpriority = t.o_orderpriority)
UNION ALL SELECT * FROM s""",
    ),
)
def delete_insert(spark, folder):
    """A composite key that repeats on both sides and is NULL in parts."""

    def blank(rows):
        return rows.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))

    return incremental.delete_insert(
        blank(orders_target(spark, folder)), blank(orders_source(spark, folder)), ["o_custkey", "o_orderpriority"]
    )


@query(
    "insert_overwrite_predicate",
    with_sql(
        TARGET_SOURCE,
        f"SELECT * FROM tgt WHERE o_orderdate < TIMESTAMP '{SOURCE_START}' UNION ALL SELECT * FROM src",
    ),
)
def insert_overwrite_predicate(spark, folder):
    return incremental.replace_where(
        orders_target(spark, folder),
        orders_source(spark, folder),
        F.col("o_orderdate") >= moment(SOURCE_START),
    )


@query(
    "insert_overwrite_partitions",
    with_sql(
        TARGET_SOURCE,
        "SELECT *, year(o_orderdate) AS order_year FROM tgt WHERE year(o_orderdate) NOT IN (SELECT year(o_orderdate) FROM src) "
        "UNION ALL SELECT *, year(o_orderdate) FROM src",
    ),
)
def insert_overwrite_partitions(spark, folder):
    """On disk: only the years that the source has rows for are replaced."""
    path = work_dir(spark, "partitions")
    tables.overwrite_partitions(by_year(orders_target(spark, folder)), path, ["order_year"])
    tables.overwrite_partitions(by_year(orders_source(spark, folder)), path, ["order_year"])
    return spark.read.parquet(path)


@query(
    "insert_overwrite_full",
    with_sql(
        TARGET_SOURCE,
        "SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice, "
        "CAST(NULL AS TIMESTAMP) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority FROM src",
    ),
)
def insert_overwrite_full(spark, folder):
    return incremental.overwrite(
        orders_target(spark, folder), orders_source(spark, folder), ["o_orderkey", "o_totalprice"]
    )


@query(
    "microbatch_replace",
    "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-20' UNION ALL "
    "SELECT * REPLACE (value + 1 AS value) FROM events WHERE ts >= TIMESTAMP '2024-01-10' "
    "AND ts < TIMESTAMP '2024-01-20' AND event_type <> 'error'",
)
def microbatch_replace(spark, folder):
    events = table(spark, folder, "events")
    start, end = moment("2024-01-10"), moment("2024-01-20")
    again = events.where((F.col("ts") >= start) & (F.col("ts") < end) & (F.col("event_type") != "error"))
    return incremental.replace_period(events, again.withColumn("value", F.col("value") + 1), "ts", start, end)


@query("incremental_lifecycle", with_sql(TARGET_SOURCE, f"{UNMATCHED} UNION ALL SELECT * FROM src"))
def incremental_lifecycle(spark, folder):
    """A view holds the name at first; run 1 builds the table, run 2 merges into it."""
    root = work_dir(spark, "lifecycle")
    name = "orders_" + root.rsplit("-", 1)[-1]
    orders_target(spark, folder).createOrReplaceTempView(name)

    def model(existing):
        return orders_target(spark, folder) if existing is None else orders_source(spark, folder)

    for _ in range(2):
        result = tables.run_incremental(spark, name, root, model, "merge", keys=["o_orderkey"])
    return result


def by_year(rows):
    return rows.withColumn("order_year", F.year("o_orderdate"))


def two_runs(spark, label, first, second, strategy, partition_by, **options):
    """An incremental table built from ``first``, and run again with ``second`` as its source."""
    root = work_dir(spark, label)
    name = f"{label}_" + root.rsplit("-", 1)[-1]
    for rows in (first, second):
        result = tables.run_incremental(spark, name, root, lambda _: rows, strategy, partition_by=partition_by, **options)
    return result


@query(
    "incremental_partitioned",
    with_sql(TARGET_SOURCE, f"SELECT *, year(o_orderdate) AS order_year FROM ({UNMATCHED} UNION ALL SELECT * FROM src)"),
)
def incremental_partitioned(spark, folder):
    """A merge into a table by year; years without matched or new orders keep their files."""
    target, source = orders_target(spark, folder), orders_source(spark, folder)
    return two_runs(spark, "by_year", by_year(target), by_year(source), "merge", ["order_year"], keys=["o_orderkey"])


@query(
    "incremental_partitioned_delete",
    with_sql(
        TARGET_SOURCE,
        "SELECT *, year(o_orderdate) AS order_year FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src "
        "WHERE src.o_custkey = tgt.o_custkey AND src.o_orderstatus = tgt.o_orderstatus AND tgt.o_orderdate >= TIMESTAMP '1998-01-01') "
        "UNION ALL SELECT *, year(o_orderdate) FROM src",
    ),
)
def incremental_partitioned_delete(spark, folder):
    """Target rows from 1998 on go when their customer has new orders of that state."""
    return two_runs(
        spark,
        "by_customer",
        by_year(orders_target(spark, folder)),
        by_year(orders_source(spark, folder)),
        "delete_insert",
        ["order_year"],
        keys=["o_custkey", "o_orderstatus"],
        predicate=F.col("o_orderdate") >= moment("1998-01-01"),
    )


@query(
    "incremental_partitioned_slice",
    "SELECT *, CAST(ts AS DATE) AS day FROM events WHERE ts < TIMESTAMP '2024-01-10 06:00:00' OR ts >= TIMESTAMP '2024-01-20' UNION ALL "
    "SELECT * REPLACE (value + 1 AS value), CAST(ts AS DATE) FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' "
    "AND ts < TIMESTAMP '2024-01-15' AND event_type <> 'error'",
)
def incremental_partitioned_slice(spark, folder):
    """A slice of ten days, one of them cut in two, is replaced; half of its days are left without events."""
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    start, end = moment("2024-01-10 06:00:00"), moment("2024-01-20")
    again = events.where((F.col("ts") >= start) & (F.col("ts") < moment("2024-01-15")) & (F.col("event_type") != "error"))
    again = again.withColumn("value", F.col("value") + 1)
    return two_runs(spark, "by_day", events, again, "microbatch", ["day"], event_time="ts", start=start, end=end)


@query(
    "incremental_partitioned_columns",
    with_sql(
        TARGET_SOURCE,
        "SELECT * EXCLUDE (o_orderpriority), NULL AS o_orderpriority, year(o_orderdate) AS order_year FROM tgt "
        "UNION ALL SELECT * EXCLUDE (o_orderpriority), o_orderpriority, year(o_orderdate) FROM src",
    ),
)
def incremental_partitioned_columns(spark, folder):
    """An append that brings a column the table lacks; it adds files and a column, and reads nothing."""
    target = by_year(orders_target(spark, folder)).drop("o_orderpriority")
    source = by_year(orders_source(spark, folder))
    return two_runs(spark, "columns", target, source, "append", ["order_year"], on_schema_change="append_new_columns")


@query(
    "incremental_high_watermark",
    "SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')",
)
def incremental_high_watermark(spark, folder):
    events = table(spark, folder, "events")
    target = events.where((F.col("event_type") == "signup") & (F.col("ts") < moment("2024-01-15")))
    return incremental.newer_than_target(events, target, "ts")


@query(
    "schema_change_append",
    with_sql(
        TARGET_SOURCE,
        """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL
SELECT s.o_orderkey, t.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority
FROM src s LEFT JOIN tgt t ON s.o_orderkey = t.o_orderkey""",
    ),
)
def schema_change_append(spark, folder):
    """The source brings a column the target lacks and lacks one the target has."""
    return incremental.apply_strategy(
        "merge",
        orders_target(spark, folder).drop("o_orderpriority"),
        orders_source(spark, folder).drop("o_custkey"),
        on_schema_change="append_new_columns",
        keys=["o_orderkey"],
    )


@query(
    "schema_change_sync",
    with_sql(
        TARGET_SOURCE,
        """
SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM src""",
    ),
)
def schema_change_sync(spark, folder):
    """One column added, one removed, one of another type."""
    target = orders_target(spark, folder).drop("o_orderpriority")
    return incremental.apply_strategy(
        "merge",
        target.withColumn("o_totalprice", money("o_totalprice")),
        orders_source(spark, folder).drop("o_custkey"),
        on_schema_change="sync_all_columns",
        keys=["o_orderkey"],
    )


@query(
    "schema_change_ignore",
    with_sql(
        TARGET_SOURCE,
        f"SELECT * EXCLUDE (o_orderpriority) FROM ({UNMATCHED} UNION ALL SELECT * FROM src)",
    ),
)
def schema_change_ignore(spark, folder):
    return incremental.apply_strategy(
        "merge",
        orders_target(spark, folder).drop("o_orderpriority"),
        orders_source(spark, folder),
        on_schema_change="ignore",
        keys=["o_orderkey"],
    )


# --- tables -----------------------------------------------------------------------------------


@query("table_overwrite", with_sql(TARGET_SOURCE, "SELECT * FROM src"))
def table_overwrite(spark, folder):
    path = f"{work_dir(spark, 'overwrite')}/orders"
    tables.replace_folder(orders_target(spark, folder), path)
    return tables.replace_folder(orders_source(spark, folder), path)


@query("table_swap", with_sql(TARGET_SOURCE, "SELECT * FROM tgt UNION ALL SELECT * FROM src"))
def table_swap(spark, folder):
    """The second build reads the table it replaces."""
    root = work_dir(spark, "swap")
    name = "orders_" + root.rsplit("-", 1)[-1]
    held = tables.swap_table(orders_target(spark, folder), name, root)
    return tables.swap_table(held.unionByName(orders_source(spark, folder)), name, root)


@query("clone_table", "SELECT * FROM lineitem")
def clone_table(spark, folder):
    """A table, its clone, and a view over the clone."""
    root = work_dir(spark, "clone")
    name = "lineitem_" + root.rsplit("-", 1)[-1]
    tables.swap_table(table(spark, folder, "lineitem"), name, root)
    tables.clone_table(spark, name, f"{name}_copy", root)
    return tables.clone_table(spark, f"{name}_copy", f"{name}_view", root, as_view=True)


@query("export_table", with_sql(TARGET_SOURCE, "SELECT * FROM src"))
def export_table(spark, folder):
    root = work_dir(spark, "export")
    name = "orders_" + root.rsplit("-", 1)[-1]
    tables.swap_table(orders_source(spark, folder), name, root)
    return spark.read.parquet(tables.export_table(spark, name, f"{root}/extract"))


@query("clustered_write", "SELECT * FROM lineitem")
def clustered_write(spark, folder):
    path = f"{work_dir(spark, 'clustered')}/lineitem"
    return tables.clustered_write(
        table(spark, folder, "lineitem"), path, ["l_shipdate", "l_orderkey"], ["l_returnflag"]
    )


@query("seed_load", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def seed_load(spark, folder):
    """A CSV seed, loaded twice: built, then refilled."""
    from periodica.sources.files import load_seed

    root = work_dir(spark, "seed")
    table(spark, folder, "supplier").write.option("header", True).csv(f"{root}/csv")
    seed = load_seed(spark, f"{root}/csv", {"s_suppkey": "string"})
    name = "supplier_" + root.rsplit("-", 1)[-1]
    tables.write_seed(seed, name, root)
    tables.truncate_table(spark, name, root)
    return tables.write_seed(seed, name, root)
