"""Inputs of the registered queries, derived from the given tables, as Spark and as SQL.

Car makers are played by market segments, regions by nations, registrations by orders. A month is
reported first without pending orders and again, restated with them, a year later; this is what
makes releases overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.operators.series import densify_months, monthly_mean
from periodica.session import table
from periodica.sources.files import period_label

LOADED_AT = "2025-01-15T08:00:00"


def money(column: str | Column) -> Column:
    """Exact amount, so that sums do not depend on their order."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


# --- overlapping releases ---------------------------------------------------------------------


def monthly_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per segment, nation and month, without and with pending ones.

    Orders are first counted per customer and month, so the join moves counts instead of orders.
    """
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("m"))
        .agg(
            F.count_if(F.col("o_orderstatus") != "P").alias("first_units"),
            F.count(F.lit(1)).alias("all_units"),
        )
    )
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(
        F.col("c_mktsegment").alias("manufacturer"), F.col("n_name").alias("region"), "m"
    ).agg(F.sum("first_units").alias("first_units"), F.sum("all_units").alias("all_units"))


def raw_facts(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all releases, as a raw table holds them."""
    counts = monthly_counts(spark, folder)
    newest = table(spark, folder, "orders").select(F.trunc(F.max("o_orderdate"), "MM"))
    in_year = Window.partitionBy("manufacturer", "region", F.year("m")).orderBy("m")
    again = F.add_months("m", 12)
    releases = F.array(
        F.struct(
            F.lit("M").alias("frequency"), F.col("first_units").alias("units"), F.col("m").alias("release")
        ),
        F.struct(F.lit("M").alias("frequency"), F.col("all_units").alias("units"), again.alias("release")),
        F.struct(F.lit("YTD").alias("frequency"), F.col("_ytd").alias("units"), F.col("m").alias("release")),
    )
    rows = counts.withColumn("_ytd", F.sum("first_units").over(in_year)).select(
        "manufacturer", "region", "m", F.inline(releases)
    )
    return rows.where(F.col("release") <= newest.scalar()).select(
        "manufacturer",
        "frequency",
        period_label(F.col("m")).alias("month"),
        F.col("units").cast("double").alias("units"),
        "region",
        period_label(F.col("release")).alias("pdf"),
        F.lit(LOADED_AT).alias("inserted_at"),
    )


RAW_FACTS = f"""
counts AS (
  SELECT c_mktsegment AS manufacturer, n_name AS region, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
         count(*) FILTER (WHERE o_orderstatus <> 'P') AS first_units, count(*) AS all_units
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
last_release AS (SELECT max(m) AS lm FROM counts),
raw_facts AS (
  SELECT manufacturer, 'M' AS frequency, strftime(m, '%b-%y') AS month, CAST(first_units AS DOUBLE) AS units,
         region, strftime(m, '%b-%y') AS pdf, m AS release_month, '{LOADED_AT}' AS inserted_at
  FROM counts
  UNION ALL
  SELECT manufacturer, 'M', strftime(m, '%b-%y'), CAST(all_units AS DOUBLE), region,
         strftime(m + INTERVAL 12 MONTH, '%b-%y'), CAST(m + INTERVAL 12 MONTH AS DATE), '{LOADED_AT}'
  FROM counts, last_release WHERE m + INTERVAL 12 MONTH <= lm
  UNION ALL
  SELECT manufacturer, 'YTD', strftime(m, '%b-%y'),
         CAST(sum(first_units) OVER (PARTITION BY manufacturer, region, year(m) ORDER BY m) AS DOUBLE),
         region, strftime(m, '%b-%y'), m, '{LOADED_AT}'
  FROM counts)"""

DEDUPED = f"""{RAW_FACTS},
deduped AS (
  SELECT region, manufacturer, frequency, month, arg_max(units, release_month) AS units,
         arg_max(pdf, release_month) AS pdf_name, '{LOADED_AT}' AS inserted_at,
         md5(manufacturer || '-' || month || '-' || frequency || '-' || region) AS id
  FROM raw_facts GROUP BY region, manufacturer, frequency, month)"""


MONTHLY_SPENT = """
m AS (
  SELECT o_custkey AS custkey, last_day(o_orderdate) AS month_end,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS spent
  FROM orders GROUP BY 1, 2)"""


# --- series per customer ----------------------------------------------------------------------


def customer_series(spark: SparkSession, folder: str) -> DataFrame:
    """Dense monthly order counts per customer, with a frequency that decides the yearly lag."""
    counted = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.last_day("o_orderdate").alias("month_end"))
        .agg(F.count(F.lit(1)).cast("double").alias("units"))
    )
    return densify_months(counted, ["custkey"], "month_end", "units")


def customer_frequency(spark: SparkSession, folder: str) -> DataFrame:
    monthly = F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.when(monthly, "M").otherwise("Q").alias("frequency")
    )


CUSTOMER_SERIES = """
monthly AS (
  SELECT o_custkey AS custkey, last_day(o_orderdate) AS month_end, CAST(count(*) AS DOUBLE) AS units
  FROM orders GROUP BY 1, 2),
span AS (
  SELECT custkey, date_trunc('month', min(month_end)) AS lo, date_trunc('month', max(month_end)) AS hi
  FROM monthly GROUP BY 1),
steps AS (SELECT custkey, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS step FROM span),
cal AS (SELECT custkey, last_day(step) AS month_end FROM steps),
series AS (
  SELECT cal.custkey, cal.month_end,
         last_value(monthly.units IGNORE NULLS) OVER (PARTITION BY cal.custkey ORDER BY cal.month_end) AS units
  FROM cal LEFT JOIN monthly ON cal.custkey = monthly.custkey AND cal.month_end = monthly.month_end)"""

FREQUENCIES = """
frequencies AS (
  SELECT c_custkey AS custkey,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'M' ELSE 'Q' END AS frequency
  FROM customer)"""


def part_quantity(spark: SparkSession, folder: str) -> DataFrame:
    """Mean quantity per part and month, gaps filled."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("partkey"),
        F.to_date("l_shipdate").alias("month_end"),
        F.col("l_quantity").alias("quantity"),
    )
    monthly = monthly_mean(lines, ["partkey"], "month_end", "quantity")
    return densify_months(monthly, ["partkey"], "month_end", "quantity", filled_flag="is_filled")


# --- two versions of a table ------------------------------------------------------------------
# The target knows orders up to the end of 1999. The source brings everything from mid-1999 on and
# restates what it brings: pending orders are finished and cost 100 more.

TARGET_END = "2000-01-01"
SOURCE_START = "1999-07-01"


def orders_target(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").where(
        F.col("o_orderdate") < F.lit(TARGET_END).cast("timestamp_ntz")
    )


def restated(orders: DataFrame) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    return orders.withColumn(
        "o_totalprice", F.when(pending, F.col("o_totalprice") + 100.0).otherwise(F.col("o_totalprice"))
    ).withColumn("o_orderstatus", F.when(pending, F.lit("F")).otherwise(F.col("o_orderstatus")))


def orders_source(spark: SparkSession, folder: str) -> DataFrame:
    recent = table(spark, folder, "orders").where(
        F.col("o_orderdate") >= F.lit(SOURCE_START).cast("timestamp_ntz")
    )
    return restated(recent)


RESTATED = """
restated AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders)"""

TARGET_SOURCE = f"""{RESTATED},
tgt AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_END}'),
src AS (SELECT * FROM restated WHERE o_orderdate >= TIMESTAMP '{SOURCE_START}')"""


def with_sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"
