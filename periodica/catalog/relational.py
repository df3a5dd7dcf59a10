"""Projections, joins, aggregates, sets, limits, calendars."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.catalog.bindings import TARGET_SOURCE, money, orders_source, orders_target, with_sql
from periodica.catalog.registry import query
from periodica.functions.scalars import equals_null_safe
from periodica.operators import calendars, dedupe, incremental, joins, schema, snapshot, triage
from periodica.session import table

# --- projections and schemas ------------------------------------------------------------------


@query(
    "conform_schema",
    "SELECT l_shipdate, CAST(NULL AS VARCHAR) AS l_comment, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "l_orderkey, CAST(NULL AS DOUBLE) AS l_rebate FROM lineitem",
)
def conform_schema(spark, folder):
    contract = T.StructType(
        [
            T.StructField("l_shipdate", T.TimestampNTZType()),
            T.StructField("l_comment", T.StringType()),
            T.StructField("l_linenumber", T.LongType()),
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_rebate", T.DoubleType()),
        ]
    )
    return schema.conform(table(spark, folder, "lineitem"), contract)


DECLARED_ORDERS = T.StructType(
    [
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query(
    "contract_select",
    "SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def contract_select(spark, folder):
    return schema.enforce_contract(table(spark, folder, "orders"), DECLARED_ORDERS)


@query(
    "contract_diff",
    """
SELECT 'o_orderkey' AS column_name, 'ok' AS change, 'bigint' AS source_type, 'bigint' AS target_type, count(o_orderkey) AS n_values FROM orders
UNION ALL SELECT 'o_totalprice', 'type mismatch', 'double', 'decimal(28,6)', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_comment', 'missing', NULL, 'string', 0
UNION ALL SELECT 'o_custkey', 'undeclared', 'bigint', NULL, count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'undeclared', 'string', NULL, count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', 'undeclared', 'timestamp_ntz', NULL, count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'undeclared', 'string', NULL, count(o_orderpriority) FROM orders""",
)
def contract_diff(spark, folder):
    declared = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DecimalType(28, 6)),
            T.StructField("o_comment", T.StringType()),
        ]
    )
    orders = table(spark, folder, "orders")
    return schema.changes_with_counts(orders, schema.contract_changes(orders.schema, declared))


@query(
    "schema_diff",
    """
SELECT 'o_orderstatus' AS column_name, 'retyped' AS change, 'string' AS source_type, 'int' AS target_type, count(o_orderstatus) AS n_values FROM orders
UNION ALL SELECT 'o_orderpriority', 'added', 'string', NULL, count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_clerk', 'removed', NULL, 'string', 0""",
)
def schema_diff(spark, folder):
    held = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.IntegerType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_clerk", T.StringType()),
        ]
    )
    orders = table(spark, folder, "orders")
    return schema.changes_with_counts(orders, schema.schema_changes(orders.schema, held))


@query(
    "typed_nulls",
    "SELECT c_custkey, CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus, "
    "CAST(NULL AS TIMESTAMP) AS o_orderdate FROM customer "
    "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')",
)
def typed_nulls(spark, folder):
    """Customers without a recent order, padded with the order columns."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    recent = orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    recent = recent.withColumnRenamed("o_custkey", "c_custkey")
    idle = joins.rows_without(table(spark, folder, "customer"), recent, ["c_custkey"])
    return idle.select("c_custkey", *schema.typed_nulls(orders.drop("o_custkey").schema))


@query("empty_like", "SELECT * FROM orders")
def empty_like(spark, folder):
    """A first merge, into a table that has the columns but no rows."""
    orders = table(spark, folder, "orders")
    return incremental.merge(schema.empty_like(orders), orders, ["o_orderkey"])


@query(
    "alter_column_type",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
    "o_orderpriority FROM orders",
)
def alter_column_type(spark, folder):
    return schema.alter_column_type(table(spark, folder, "orders"), "o_custkey", "string")


# --- joins ------------------------------------------------------------------------------------


@query(
    "null_safe_equals",
    "SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE nullif(l_returnflag, 'N') "
    "IS NOT DISTINCT FROM nullif(l_linestatus, 'O')) AS same FROM lineitem GROUP BY 1",
)
def null_safe_equals(spark, folder):
    same = equals_null_safe(
        F.nullif(F.col("l_returnflag"), F.lit("N")), F.nullif(F.col("l_linestatus"), F.lit("O"))
    )
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("same"))
    )


@query(
    "keys_vanished",
    with_sql(
        TARGET_SOURCE,
        "SELECT o_orderkey, o_orderstatus, o_orderdate AS valid_from FROM tgt "
        "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)",
    ),
)
def keys_vanished(spark, folder):
    config = snapshot.SnapshotConfig(keys=["o_orderkey"], updated_at="o_orderdate")
    history = snapshot.initial(orders_target(spark, folder), config, None)
    gone = snapshot.vanished_keys(history, orders_source(spark, folder), config)
    return gone.select("o_orderkey", "o_orderstatus", "valid_from")


@query(
    "semi_join_keys",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem l WHERE EXISTS (SELECT 1 FROM orders o "
    "WHERE o.o_orderkey = l.l_orderkey AND o.o_orderdate = l.l_shipdate - INTERVAL 1 DAY)",
)
def semi_join_keys(spark, folder):
    """Lines shipped the day after their order: a composite key that rarely matches."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.date_sub("l_shipdate", 1).alias("day"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").alias("day")
    )
    met = joins.rows_with(lines, orders, ["orderkey", "day"])
    return met.select(F.col("orderkey").alias("l_orderkey"), "l_partkey", "l_suppkey", "l_quantity")


@query(
    "composite_key_join",
    """
WITH bought AS (
  SELECT o_custkey, nullif(o_orderpriority, '3-MEDIUM') AS priority, count(*) AS n_orders FROM orders
  WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
pending AS (
  SELECT o_custkey, nullif(o_orderpriority, '3-MEDIUM') AS priority, count(*) AS n_pending FROM orders
  WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT b.o_custkey, b.priority, n_orders, n_pending FROM bought b JOIN pending p
ON b.o_custkey IS NOT DISTINCT FROM p.o_custkey AND b.priority IS NOT DISTINCT FROM p.priority""",
)
def composite_key_join(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "priority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))
    )

    def counted(rows, name):
        return rows.groupBy("o_custkey", "priority").agg(F.count(F.lit(1)).alias(name))

    bought = counted(orders.where("o_orderstatus <> 'P'"), "n_orders")
    pending = counted(orders.where("o_orderstatus = 'P'"), "n_pending").withColumnsRenamed(
        {"o_custkey": "_custkey", "priority": "_priority"}
    )
    named = pending.select(F.col("_custkey").alias("o_custkey"), F.col("_priority").alias("priority"), "n_pending")
    on = joins.key_condition(bought, named, ["o_custkey", "priority"], null_safe=True)
    return bought.join(named, on).select(bought["o_custkey"], bought["priority"], "n_orders", "n_pending")


@query(
    "using_join",
    """
WITH a AS (SELECT o_custkey AS custkey, last_day(o_orderdate) AS month_end, count(*) AS n_finished
           FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
b AS (SELECT o_custkey AS custkey, last_day(o_orderdate) AS month_end, count(*) AS n_open
      FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
SELECT custkey, month_end, n_finished, n_open FROM a JOIN b USING (custkey, month_end)""",
)
def using_join(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), F.last_day("o_orderdate").alias("month_end"), "o_orderstatus"
    )

    def counted(status, name):
        rows = orders.where(F.col("o_orderstatus") == status)
        return rows.groupBy("custkey", "month_end").agg(F.count(F.lit(1)).alias(name))

    return counted("F", "n_finished").join(counted("O", "n_open"), ["custkey", "month_end"])


# --- aggregates -------------------------------------------------------------------------------


@query(
    "listagg_ordered",
    """
WITH used AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)
SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM used GROUP BY 1""",
)
def listagg_ordered(spark, folder):
    used = table(spark, folder, "orders").select("o_custkey", "o_orderpriority").distinct()
    return triage.joined_text(used, ["o_custkey"], "o_orderpriority", "o_orderpriority", ", ", "priorities")


@query(
    "listagg_limit",
    """
WITH ranked AS (
  SELECT l_partkey, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS rn FROM lineitem)
SELECT l_partkey, string_agg(CAST(l_orderkey AS VARCHAR), '|' ORDER BY l_orderkey) AS first_orders
FROM ranked WHERE rn <= 3 GROUP BY 1""",
)
def listagg_limit(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_orderkey", F.col("l_orderkey").cast("string").alias("label")
    )
    return triage.joined_text(lines, ["l_partkey"], "label", "l_orderkey", "|", "first_orders", limit=3)


@query(
    "array_agg_sorted",
    """
WITH used AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT user_id, array_agg(event_type ORDER BY event_type) AS event_types FROM used GROUP BY 1""",
)
def array_agg_sorted(spark, folder):
    """Sets combine inside each task, so a user's many events arrive as a few types."""
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set("event_type")).alias("event_types"))
    )


@query(
    "array_agg",
    "SELECT o_custkey, o_orderstatus, array_agg(o_orderpriority ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1, 2",
)
def array_agg(spark, folder):
    """Every order's priority per customer and state, repeats kept."""
    return triage.array_agg(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"], "o_orderpriority", "priorities")


@query(
    "any_value_const",
    "SELECT l_suppkey, any_value(s_name) AS s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "GROUP BY 1",
)
def any_value_const(spark, folder):
    """Lines are counted per supplier before the join, so a supplier of many lines is one row there."""
    counted = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    named = table(spark, folder, "supplier").groupBy("s_suppkey").agg(F.any_value("s_name").alias("s_name"))
    return counted.join(named, F.col("l_suppkey") == F.col("s_suppkey")).select("l_suppkey", "s_name", "n")


@query(
    "bool_or_agg",
    "SELECT lang, bool_or(toxic = 1) AS any_toxic, bool_or(n_chars > 30000) AS any_long FROM documents "
    "JOIN labels ON documents.doc_id = labels.doc_id GROUP BY 1",
)
def bool_or_agg(spark, folder):
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    return labelled.groupBy("lang").agg(
        F.bool_or(F.col("toxic") == 1).alias("any_toxic"), F.bool_or(F.col("n_chars") > 30000).alias("any_long")
    )


@query("distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(spark, folder):
    return dedupe.distinct_keys(table(spark, folder, "lineitem"), ["l_suppkey", "l_returnflag"])


# --- sets and limits --------------------------------------------------------------------------


@query(
    "union_all",
    "SELECT o_custkey AS custkey, o_orderstatus AS flag FROM orders "
    "UNION ALL SELECT l_suppkey, l_linestatus FROM lineitem",
)
def union_all(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("flag")
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("flag"), F.col("l_suppkey").alias("custkey")
    )
    return orders.unionByName(lines)


@query(
    "except_distinct",
    "SELECT o_orderkey AS orderkey, o_orderdate AS day FROM orders EXCEPT SELECT l_orderkey, l_shipdate - INTERVAL 1 DAY "
    "FROM lineitem",
)
def except_distinct(spark, folder):
    return _order_days(spark, folder).subtract(_shipped_days(spark, folder))


@query(
    "intersect_distinct",
    "SELECT o_orderkey AS orderkey, o_orderdate AS day FROM orders INTERSECT "
    "SELECT l_orderkey, l_shipdate - INTERVAL 1 DAY FROM lineitem",
)
def intersect_distinct(spark, folder):
    return _order_days(spark, folder).intersect(_shipped_days(spark, folder))


def _order_days(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("day")
    )


def _shipped_days(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.date_sub("l_shipdate", 1).cast("timestamp_ntz").alias("day"),
    )


@query(
    "concat_by_name",
    "SELECT s_nationkey AS nationkey, s_name AS name, s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS segment FROM supplier "
    "UNION ALL SELECT c_nationkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def concat_by_name(spark, folder):
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
    )
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query("limit_ordered", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limit_ordered(spark, folder):
    """Preview of a result: the limit is the feature."""
    return table(spark, folder, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


# --- calendars --------------------------------------------------------------------------------


@query(
    "date_spine",
    """
WITH spans AS (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
steps AS (
  SELECT o_custkey, lo, unnest(generate_series(1, date_diff('day', date_trunc('week', lo), date_trunc('week', hi)) // 7)) AS n
  FROM spans)
SELECT o_custkey, lo + to_days(CAST(7 * (n - 1) AS INTEGER)) AS date_week FROM steps""",
)
def date_spine(spark, folder):
    spans = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    )
    return calendars.date_spine(spans, "week", F.col("lo"), F.col("hi"), "date_week").select(
        "o_custkey", "date_week"
    )


@query(
    "number_series",
    """
WITH n AS (SELECT o_custkey, count(*) AS orders_held FROM orders GROUP BY 1)
SELECT o_custkey, unnest(generate_series(1, orders_held)) AS generated_number FROM n""",
)
def number_series(spark, folder):
    counted = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders_held"))
    return calendars.number_series(counted, F.col("orders_held"), "generated_number").drop("orders_held")


@query(
    "dates_in_range",
    """
WITH spans AS (
  SELECT user_id, event_type, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events GROUP BY 1, 2)
SELECT user_id, event_type, strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM spans""",
)
def dates_in_range(spark, folder):
    """Partition text 'yyyyMMdd,yyyyMMdd' per user and event type, or one date for a single day."""
    lo, hi = F.date_format(F.min("ts"), "yyyyMMdd"), F.date_format(F.max("ts"), "yyyyMMdd")
    spans = (
        table(spark, folder, "events")
        .groupBy("user_id", "event_type")
        .agg(F.when(lo == hi, lo).otherwise(F.concat_ws(",", lo, hi)).alias("span"))
    )
    return calendars.dates_in_range(spans, F.col("span"), "day", out_format="yyyy-MM-dd").drop("span")


@query(
    "month_labels",
    """
WITH spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1),
steps AS (
  SELECT o_custkey, hi, unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS m
  FROM spans)
SELECT o_custkey, strftime(m, '%B_%Y') AS label FROM steps WHERE last_day(m) <= hi""",
)
def month_labels(spark, folder):
    spans = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    )
    return calendars.month_labels(spans, F.col("lo"), F.col("hi"), "label").select("o_custkey", "label")


@query(
    "monthly_revenue",
    "SELECT n_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM orders "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def monthly_revenue(spark, folder):
    """Monthly sum per nation; orders are summed per customer before the join."""
    spent = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("month"))
        .agg(F.sum(money("o_totalprice")).alias("spent"))
    )
    homes = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = spent.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return triage.monthly_sum(joined, "n_name", "month", "spent", "revenue").withColumn(
        "revenue", F.col("revenue").cast("double")
    )
