"""Models, series, dedupe and triage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from periodica.catalog.bindings import (
    CUSTOMER_SERIES,
    DEDUPED,
    FREQUENCIES,
    MONTHLY_SPENT,
    RAW_FACTS,
    customer_frequency,
    customer_series,
    money,
    part_quantity,
    raw_facts,
    with_sql,
)
from periodica.catalog.registry import query
from periodica.fixed_values import SURROGATE_KEY_NULL
from periodica.functions.scalars import month_end, not_equal_keep_null, surrogate_key
from periodica.operators import triage
from periodica.operators.dedupe import attach_latest, keep_latest
from periodica.operators.joins import rows_with
from periodica.operators.series import growth, to_long, trailing_sum, year_to_date, yearly_growth
from periodica.plans import models
from periodica.session import table

MART = f"""{DEDUPED},
points AS (
  SELECT manufacturer, frequency, region, last_day(strptime(month, '%b-%y')) AS date, avg(units) AS units
  FROM deduped WHERE frequency IS DISTINCT FROM 'YTD' GROUP BY 1, 2, 3, 4),
span AS (
  SELECT manufacturer, frequency, region, date_trunc('month', min(date)) AS lo, date_trunc('month', max(date)) AS hi
  FROM points GROUP BY 1, 2, 3),
steps AS (
  SELECT manufacturer, frequency, region, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS step FROM span),
cal AS (SELECT manufacturer, frequency, region, last_day(step) AS date FROM steps),
dense AS (
  SELECT c.manufacturer, c.frequency, c.region, c.date,
         last_value(p.units IGNORE NULLS) OVER (
           PARTITION BY c.manufacturer, c.frequency, c.region ORDER BY c.date) AS units
  FROM cal c LEFT JOIN points p ON c.manufacturer = p.manufacturer AND c.frequency = p.frequency
       AND c.region = p.region AND c.date = p.date),
cuts AS (
  SELECT *, sum(units) OVER (PARTITION BY manufacturer, frequency, region, year(date) ORDER BY date) AS ytd,
         sum(units) OVER (PARTITION BY manufacturer, frequency, region ORDER BY date
                          ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ttm
  FROM dense),
lagged AS (
  SELECT *, lag(units) OVER s AS u1, lag(ytd) OVER s AS y1, lag(ttm) OVER s AS t1,
         lag(units, 12) OVER s AS u12, lag(ytd, 12) OVER s AS y12, lag(ttm, 12) OVER s AS t12
  FROM cuts WINDOW s AS (PARTITION BY manufacturer, frequency, region ORDER BY date)),
wide AS (
  SELECT manufacturer, region, frequency, date, units AS "UNITS", ytd AS "YTD", ttm AS "TTM",
         units / nullif(u1, 0) - 1 AS "UNITS_PoP", ytd / nullif(y1, 0) - 1 AS "YTD_PoP",
         ttm / nullif(t1, 0) - 1 AS "TTM_PoP", units / nullif(u12, 0) - 1 AS "UNITS_YoY",
         ytd / nullif(y12, 0) - 1 AS "YTD_YoY", ttm / nullif(t12, 0) - 1 AS "TTM_YoY"
  FROM lagged),
mart AS (
  SELECT manufacturer, region, frequency, date, measure, value
  FROM wide UNPIVOT INCLUDE NULLS (value FOR measure IN (
    "UNITS", "YTD", "TTM", "UNITS_PoP", "YTD_PoP", "TTM_PoP", "UNITS_YoY", "YTD_YoY", "TTM_YoY")))"""


@query("metrics_mart", with_sql(MART, "SELECT * FROM mart"))
def metrics_mart(spark, folder):
    return models.metrics_mart(models.deduplicate(models.stage(raw_facts(spark, folder))))


@query(
    "stage_rename",
    with_sql(
        RAW_FACTS, "SELECT region, manufacturer, frequency, month, units, pdf AS pdf_name, inserted_at FROM raw_facts"
    ),
)
def stage_rename(spark, folder):
    return models.stage(raw_facts(spark, folder))


@query(
    "dedupe_latest",
    "SELECT * FROM events QUALIFY row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def dedupe_latest(spark, folder):
    return keep_latest(table(spark, folder, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "first_value_latest",
    "SELECT event_id, user_id, event_type, ts, value, first_value(value) OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS latest_value FROM events",
)
def first_value_latest(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return attach_latest(events, ["user_id", "event_type"], ["ts", "event_id"], "value", "latest_value")


def _key_part(value: str) -> str:
    return f"coalesce({value}, '{SURROGATE_KEY_NULL}')"


@query(
    "surrogate_key",
    f"SELECT o_orderkey, md5({_key_part('CAST(o_custkey AS VARCHAR)')} || '-' || "
    f"{_key_part("nullif(o_orderstatus, 'P')")} || '-' || {_key_part("strftime(o_orderdate, '%b-%y')")}) AS id FROM orders",
)
def surrogate_key_query(spark, folder):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    label = F.date_format("o_orderdate", "MMM-yy")
    return table(spark, folder, "orders").select(
        "o_orderkey", surrogate_key("o_custkey", status, label).alias("id")
    )


@query(
    "month_end",
    "SELECT o_orderkey, last_day(strptime(strftime(o_orderdate, '%b-%y'), '%b-%y')) AS month_end FROM orders",
)
def month_end_query(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", month_end(F.date_format("o_orderdate", "MMM-yy")).alias("month_end")
    )


@query(
    "filter_not_equal",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders "
    "WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'O'",
)
def filter_not_equal(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")
    )
    return orders.where(not_equal_keep_null("status", "O"))


# --- series -----------------------------------------------------------------------------------


@query(
    "resample_ffill",
    with_sql(
        """
points AS (
  SELECT l_partkey AS partkey, last_day(l_shipdate) AS month_end, avg(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
span AS (
  SELECT partkey, date_trunc('month', min(month_end)) AS lo, date_trunc('month', max(month_end)) AS hi
  FROM points GROUP BY 1),
steps AS (SELECT partkey, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS step FROM span),
cal AS (SELECT partkey, last_day(step) AS month_end FROM steps)""",
        """
SELECT cal.partkey, cal.month_end,
       last_value(points.q IGNORE NULLS) OVER (PARTITION BY cal.partkey ORDER BY cal.month_end) AS quantity,
       points.q IS NULL AS is_filled
FROM cal LEFT JOIN points ON cal.partkey = points.partkey AND cal.month_end = points.month_end""",
    ),
)
def resample_ffill(spark, folder):
    return part_quantity(spark, folder)


@query(
    "ytd",
    with_sql(
        CUSTOMER_SERIES,
        "SELECT *, sum(units) OVER (PARTITION BY custkey, year(month_end) ORDER BY month_end) AS ytd FROM series",
    ),
)
def ytd(spark, folder):
    series = customer_series(spark, folder)
    return series.withColumn("ytd", year_to_date(["custkey"], "month_end", "units"))


@query(
    "ttm",
    with_sql(
        CUSTOMER_SERIES,
        "SELECT *, sum(units) OVER (PARTITION BY custkey ORDER BY month_end "
        "ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ttm FROM series",
    ),
)
def ttm(spark, folder):
    return customer_series(spark, folder).withColumn("ttm", trailing_sum(["custkey"], "month_end", "units"))


@query(
    "pop_growth",
    with_sql(
        CUSTOMER_SERIES,
        "SELECT *, units / nullif(lag(units) OVER (PARTITION BY custkey ORDER BY month_end), 0) - 1 AS pop FROM series",
    ),
)
def pop_growth(spark, folder):
    return customer_series(spark, folder).withColumn("pop", growth(["custkey"], "month_end", "units"))


YOY = f"""{CUSTOMER_SERIES},{FREQUENCIES},
tagged AS (SELECT series.*, frequency FROM series JOIN frequencies ON series.custkey = frequencies.custkey),
based AS (
  SELECT *, CASE WHEN frequency = 'M' THEN lag(units, 12) OVER w ELSE lag(units, 4) OVER w END AS base
  FROM tagged WINDOW w AS (PARTITION BY custkey ORDER BY month_end))"""


@query(
    "yoy_growth",
    with_sql(YOY, "SELECT custkey, month_end, units, frequency, units / nullif(base, 0) - 1 AS yoy FROM based"),
)
def yoy_growth(spark, folder):
    tagged = customer_series(spark, folder).join(customer_frequency(spark, folder), "custkey")
    return tagged.withColumn("yoy", yearly_growth(["custkey"], "month_end", "units", "frequency"))


@query(
    "melt_metrics",
    with_sql(
        CUSTOMER_SERIES,
        """
, cuts AS (
  SELECT custkey, month_end, units, lag(units) OVER w AS before,
         sum(units) OVER (PARTITION BY custkey ORDER BY month_end ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ttm
  FROM series WINDOW w AS (PARTITION BY custkey ORDER BY month_end))
SELECT custkey, month_end, 'units' AS measure, units AS value FROM cuts
UNION ALL SELECT custkey, month_end, 'ttm', ttm FROM cuts
UNION ALL SELECT custkey, month_end, 'before', before FROM cuts""",
    ),
)
def melt_metrics(spark, folder):
    from pyspark.sql import Window

    in_order = Window.partitionBy("custkey").orderBy("month_end")
    wide = customer_series(spark, folder).select(
        "custkey",
        "month_end",
        "units",
        trailing_sum(["custkey"], "month_end", "units").alias("ttm"),
        F.lag("units").over(in_order).alias("before"),
    )
    return to_long(wide, ["custkey", "month_end"], ["units", "ttm", "before"])


# --- triage -----------------------------------------------------------------------------------


@query(
    "monthly_sum",
    with_sql(
        MART,
        "SELECT manufacturer, CAST(date_trunc('month', date) AS DATE) AS month, sum(value) AS ytd_units FROM mart "
        "WHERE measure = 'YTD' AND frequency = 'M' GROUP BY 1, 2",
    ),
)
def monthly_sum(spark, folder):
    mart = metrics_mart(spark, folder).where((F.col("measure") == "YTD") & (F.col("frequency") == "M"))
    return triage.monthly_sum(mart, "manufacturer", "date", "value", "ytd_units")


@query(
    "data_profile",
    "SELECT count(*) AS row_count, count(DISTINCT o_custkey) AS entities, CAST(min(o_orderdate) AS DATE) AS month_start, "
    "CAST(max(o_orderdate) AS DATE) AS month_end, 12 AS top_n FROM orders",
)
def data_profile(spark, folder):
    orders = table(spark, folder, "orders").withColumn("month", F.to_date("o_orderdate"))
    return triage.profile(orders, "o_custkey", "month", 12)


@query(
    "latest_rows",
    "SELECT o_orderkey, o_custkey, last_day(o_orderdate) AS month_end FROM orders "
    "WHERE last_day(o_orderdate) = (SELECT last_day(max(o_orderdate)) FROM orders)",
)
def latest_rows(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.last_day("o_orderdate").alias("month_end")
    )
    return triage.latest_rows(orders, "month_end")


@query(
    "topn_latest",
    with_sql(
        MONTHLY_SPENT
        + """,
leaders AS (
  SELECT custkey FROM m WHERE month_end = (SELECT max(month_end) FROM m) ORDER BY spent DESC, custkey LIMIT 12)""",
        "SELECT m.* FROM m WHERE custkey IN (SELECT custkey FROM leaders)",
    ),
)
def topn_latest(spark, folder):
    monthly = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.last_day("o_orderdate").alias("month_end"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("spent"))
    )
    return triage.top_entities(monthly, "custkey", "month_end", "spent", 12)


@query(
    "freshness",
    "SELECT max(ts) AS max_loaded_at, TIMESTAMP '2024-02-01 00:00:00' AS snapshotted_at FROM events "
    "WHERE event_type <> 'error'",
)
def freshness(spark, folder):
    return triage.freshness(
        table(spark, folder, "events"), "ts", "2024-02-01 00:00:00", F.col("event_type") != "error"
    )


@query(
    "freshness_of_query",
    "SELECT max(o_orderdate) AS max_loaded_at, TIMESTAMP '2002-01-01 00:00:00' AS snapshotted_at "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'",
)
def freshness_of_query(spark, folder):
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    newest = rows_with(table(spark, folder, "orders"), returned, ["o_orderkey"]).agg(F.max("o_orderdate"))
    return triage.freshness_of_query(newest, "2002-01-01 00:00:00")


@query("model_chain", with_sql(MART, "SELECT * FROM mart WHERE measure = 'TTM'"))
def model_chain(spark, folder):
    """The three models by name: two views and a lazy mart on top of them."""
    raw_facts(spark, folder).createOrReplaceTempView("periodica_raw")
    models.stage(spark.table("periodica_raw")).createOrReplaceTempView("periodica_staged")
    models.deduplicate(spark.table("periodica_staged")).createOrReplaceTempView("periodica_deduped")
    return models.metrics_mart(spark.table("periodica_deduped")).where("measure = 'TTM'")
