"""Function families, one query each, and user functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.catalog.bindings import CUSTOMER_SERIES, FREQUENCIES, customer_frequency, customer_series, with_sql
from periodica.catalog.registry import query
from periodica.functions import scalars as S
from periodica.functions.user_functions import (
    grouped_apply,
    in_pieces,
    python_aggregate,
    python_scalar,
    sql_aggregate,
    sql_scalar,
)
from periodica.session import table


@query(
    "string_functions",
    "SELECT p_partkey, p_name || ' / ' || nullif(p_type, 'SMALL') AS joined, length(p_name) AS n, "
    "position('e' IN p_name) AS at_e, replace(p_name, 'e', 'EE') AS swapped, right(p_brand, 2) AS tail, "
    "right(p_brand, 0) AS nothing FROM part",
)
def string_functions(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        S.concat_text("p_name", F.lit(" / "), F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("joined"),
        F.length("p_name").alias("n"),
        S.position("e", "p_name").alias("at_e"),
        S.replace_text("p_name", "e", "EE").alias("swapped"),
        S.right_text("p_brand", 2).alias("tail"),
        S.right_text("p_brand", 0).alias("nothing"),
    )


@query(
    "split_part",
    "SELECT c_custkey, split_part(c_name, '#', 1) AS first_part, split_part(c_name, '#', -1) AS last_part, "
    "split_part(c_name, '#', 5) AS beyond FROM customer",
)
def split_part(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        S.split_part("c_name", "#", 1).alias("first_part"),
        S.split_part("c_name", "#", -1).alias("last_part"),
        S.split_part("c_name", "#", 5).alias("beyond"),
    )


@query(
    "regex_functions",
    r"""
SELECT page_id, upper(trim(url)) AS shout, starts_with(url, 'https') AS secure, contains(url, 'page=') AS paged,
       coalesce(regexp_extract(url, '[0-9]+'), '') AS first_number, len(regexp_extract_all(url, '[0-9]+')) AS n_numbers,
       regexp_matches(split_part(url, '/', 4), '^[A-Za-z]+$') AS alpha_part,
       regexp_matches(split_part(url, '/', 4), '^[0-9]+$') AS digit_part
FROM pages""",
)
def regex_functions(spark, folder):
    url = F.col("url")
    part = S.split_part(url, "/", 4)
    return table(spark, folder, "pages").select(
        "page_id",
        F.upper(F.trim(url)).alias("shout"),
        url.startswith("https").alias("secure"),
        url.contains("page=").alias("paged"),
        F.coalesce(F.regexp_substr(url, F.lit("[0-9]+")), F.lit("")).alias("first_number"),
        F.size(F.regexp_extract_all(url, F.lit("[0-9]+"), F.lit(0))).alias("n_numbers"),
        part.rlike("^[A-Za-z]+$").alias("alpha_part"),
        part.rlike("^[0-9]+$").alias("digit_part"),
    )


@query(
    "sanitize_label",
    r"""
SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(trim(url)), '[^\p{L}\p{N}_-]', '_', 'g'), '_'), ''), 'triage') AS label
FROM pages""",
)
def sanitize_label(spark, folder):
    return table(spark, folder, "pages").select("page_id", S.sanitize_label("url").alias("label"))


@query(
    "clean_label",
    r"""
WITH marked AS (
  SELECT o_orderkey, ' ' || o_orderpriority || '  ' || CAST(o_custkey AS VARCHAR) || ' ' AS label FROM orders)
SELECT o_orderkey,
       trim(rtrim(rtrim(rtrim(rtrim(rtrim(replace(trim(label), '  ', ' '), '1'), '2'), '3'), '4'), '5')) AS label
FROM marked""",
)
def clean_label(spark, folder):
    """Labels that end in digits of all kinds: the priority followed by the customer number."""
    label = F.concat(F.lit(" "), "o_orderpriority", F.lit("  "), F.col("o_custkey").cast("string"), F.lit(" "))
    return table(spark, folder, "orders").select("o_orderkey", S.clean_label(label).alias("label"))


@query(
    "parse_number",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) END AS units "
    "FROM orders",
)
def parse_number(spark, folder):
    """Amounts printed with thousands commas; pending ones printed as n/a."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    printed = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.format_number(cents, 0))
    return table(spark, folder, "orders").select("o_orderkey", S.parse_number(printed).alias("units"))


@query(
    "hash_function",
    "SELECT doc_id, md5(text) AS text_hash, md5(CAST(n_chars AS VARCHAR)) AS size_hash FROM documents",
)
def hash_function(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", S.hash_text("text").alias("text_hash"), S.hash_text("n_chars").alias("size_hash")
    )


@query(
    "cast_functions",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS key_text, CAST(o_totalprice AS DECIMAL(28, 6)) AS price, "
    "TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, TRY_CAST(o_orderstatus AS INTEGER) AS unreadable, "
    "CAST(o_orderstatus = 'P' AS VARCHAR) AS pending FROM orders",
)
def cast_functions(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(28,6)").alias("price"),
        S.safe_cast(F.left("o_orderpriority", F.lit(1)), "int").alias("priority"),
        S.safe_cast("o_orderstatus", "int").alias("unreadable"),
        S.bool_to_text(F.col("o_orderstatus") == "P").alias("pending"),
    )


@query(
    "null_functions",
    "SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') AS flag, "
    "coalesce(nullif(l_returnflag, 'N'), l_linestatus) AS known FROM lineitem",
)
def null_functions(spark, folder):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", flag.alias("flag"), F.coalesce(flag, "l_linestatus").alias("known")
    )


@query(
    "date_functions",
    "SELECT event_id, make_date(year(ts), month(ts), 1) AS first_day, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, "
    "date_trunc('hour', ts) AS hour_start, ts + INTERVAL 1 MONTH AS next_month, ts + INTERVAL 90 MINUTE AS later, "
    "ts - INTERVAL 3 QUARTER AS earlier FROM events",
)
def date_functions(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        S.make_date(F.year("ts"), F.month("ts"), 1).alias("first_day"),
        S.trunc_to("week", "ts").alias("week_start"),
        S.trunc_to("hour", "ts").alias("hour_start"),
        S.add_interval("month", 1, "ts").alias("next_month"),
        S.add_interval("minute", 90, "ts").alias("later"),
        S.add_interval("quarter", -3, "ts").alias("earlier"),
    )


SPANS = ["day", "week", "month", "quarter", "year", "hour"]


@query(
    "datediff_boundaries",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"date_diff('{p}', o_orderdate, l_shipdate) AS {p}s" for p in SPANS if p != "week")
    + ", date_diff('day', date_trunc('week', o_orderdate), date_trunc('week', l_shipdate)) // 7 AS weeks"
    + " FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
def datediff_boundaries(spark, folder):
    shipped = table(spark, folder, "orders").join(
        table(spark, folder, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return shipped.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[S.boundaries_between(p, "o_orderdate", "l_shipdate").alias(f"{p}s") for p in SPANS],
    )


@query(
    "last_day_parts",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CAST(date_trunc('{p}', o_orderdate) + {step} - INTERVAL 1 DAY AS DATE) AS {p}_end"
        for p, step in [
            ("week", "INTERVAL 7 DAY"),
            ("month", "INTERVAL 1 MONTH"),
            ("quarter", "INTERVAL 3 MONTH"),
            ("year", "INTERVAL 1 YEAR"),
        ]
    )
    + " FROM orders",
)
def last_day_parts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        *[S.last_day_of(p, "o_orderdate").alias(f"{p}_end") for p in ["week", "month", "quarter", "year"]],
    )


@query(
    "array_functions",
    "SELECT vec_id, list_concat(list_append(embedding[1:2], CAST(label AS FLOAT)), embedding[3:4]) AS mixed, "
    "len(CAST([] AS FLOAT[])) AS empty_size, array_to_string([CAST(label AS VARCHAR), CAST(vec_id AS VARCHAR)], '-') AS tag "
    "FROM embeddings",
)
def array_functions(spark, folder):
    label = F.col("label")
    first = F.array_append(F.slice("embedding", 1, 2), label.cast("float"))
    tag = F.array(label.cast("string"), F.col("vec_id").cast("string"), F.lit("cut"))
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.concat(first, F.slice("embedding", 3, 2)).alias("mixed"),
        F.size(S.typed_array([], "float")).alias("empty_size"),
        S.array_slice_join(tag, 2, "-").alias("tag"),
    )


# --- user functions ---------------------------------------------------------------------------


@query(
    "sql_udf",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS taxed, "
    "l_extendedprice * (1 - l_discount) * (1 + 0.0) AS untaxed FROM lineitem",
)
def sql_udf(spark, folder):
    sql_scalar(
        spark,
        "periodica_net_price",
        [("price", "DOUBLE", None), ("discount", "DOUBLE", None), ("tax", "DOUBLE", "0.0D")],
        "DOUBLE",
        "price * (1 - discount) * (1 + tax)",
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.expr("periodica_net_price(l_extendedprice, l_discount, l_tax)").alias("taxed"),
        F.expr("periodica_net_price(l_extendedprice, l_discount)").alias("untaxed"),
    )


@query(
    "pandas_scalar_udf",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "CASE WHEN l_quantity >= 25 THEN l_quantity * 2 ELSE l_quantity + 1 END AS scaled FROM lineitem",
)
def pandas_scalar_udf(spark, folder):
    def scale(quantity: pd.Series) -> pd.Series:
        return (quantity * 2).where(quantity >= 25, quantity + 1)

    scaled = python_scalar(scale, "double")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", scaled("l_quantity").alias("scaled")
    )


def spread_handler() -> type:
    """Distance between the greatest and least value: state, accumulate, merge, finish."""

    class Spread:
        def __init__(self):
            self.state = None

        def accumulate(self, values):
            known = values[~np.isnan(values)]
            if len(known):
                self.merge((float(known.min()), float(known.max())))

        def merge(self, other):
            if other is None:
                return
            mine = self.state or other
            self.state = (min(mine[0], other[0]), max(mine[1], other[1]))

        def finish(self):
            return None if self.state is None else self.state[1] - self.state[0]

    return Spread


@query(
    "pandas_udaf",
    "SELECT l_suppkey, l_returnflag, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY 1, 2",
)
def pandas_udaf(spark, folder):
    return python_aggregate(
        table(spark, folder, "lineitem"),
        ["l_suppkey", "l_returnflag"],
        ["l_quantity"],
        spread_handler(),
        "spread",
        T.DoubleType(),
    )


WIDE_KEY = "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE 9007199254740992 + l_suppkey END"
SPREAD_BY_WIDE_KEY = f"SELECT {WIDE_KEY} AS wide_key, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY 1"


@query("python_aggregate_keys", SPREAD_BY_WIDE_KEY)
def python_aggregate_keys(spark, folder):
    """Keys that no float can hold, beside NULL."""
    rows = table(spark, folder, "lineitem").select(F.expr(WIDE_KEY).cast("long").alias("wide_key"), "l_quantity")
    return python_aggregate(rows, ["wide_key"], ["l_quantity"], spread_handler(), "spread", T.DoubleType())


@query("sql_python_aggregate", SPREAD_BY_WIDE_KEY)
def sql_python_aggregate(spark, folder):
    """A Python aggregate called from SQL, over pieces of large groups and then over their states."""
    sql_aggregate(spark, "spread", spread_handler(), T.DoubleType())
    rows = table(spark, folder, "lineitem").select(F.expr(WIDE_KEY).alias("wide_key"), "l_quantity")
    in_pieces(rows, ["wide_key"]).createOrReplaceTempView("spread_input")
    return spark.sql(
        """
        SELECT wide_key, spread(state) AS spread
        FROM (SELECT wide_key, spread_state(l_quantity) AS state FROM spread_input GROUP BY wide_key, piece)
        GROUP BY wide_key"""
    )


@query(
    "volatile_function",
    "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_totalprice * 2 > 100000",
)
def volatile_function(spark, folder):
    """A volatile function runs once per row: a filter on its result is not pushed below it."""
    double = python_scalar(lambda price: price * 2, "double", volatile=True)
    return table(spark, folder, "orders").select("o_orderkey", double("o_totalprice").alias("doubled")).where("doubled > 100000")


@query(
    "grouped_apply",
    with_sql(
        f"""{CUSTOMER_SERIES},{FREQUENCIES},
tagged AS (SELECT series.*, frequency FROM series JOIN frequencies ON series.custkey = frequencies.custkey),
based AS (
  SELECT *, CASE WHEN frequency = 'M' THEN lag(units, 12) OVER w ELSE lag(units, 4) OVER w END AS base
  FROM tagged WINDOW w AS (PARTITION BY custkey ORDER BY month_end))""",
        "SELECT custkey, month_end, frequency, units / nullif(base, 0) - 1 AS yoy FROM based",
    ),
)
def grouped_apply_query(spark, folder):
    """Yearly growth by a pandas function per series; a series has one row per calendar month."""
    tagged = customer_series(spark, folder).join(customer_frequency(spark, folder), "custkey")
    # Dates would become Python objects in pandas, day numbers stay a vector.
    numbered = tagged.withColumn("day", F.unix_date("month_end")).drop("month_end")

    def yearly(group: pd.DataFrame) -> pd.DataFrame:
        day, units = group["day"].to_numpy(), group["units"].to_numpy()
        order = np.argsort(day)
        units = units[order]
        lag = 12 if group["frequency"].iloc[0] == "M" else 4
        growth = np.full(len(units), np.nan)
        base = units[:-lag]
        np.divide(units[lag:], base, out=growth[lag:], where=base != 0)
        columns = {"custkey": group["custkey"].to_numpy(), "frequency": group["frequency"].to_numpy()}
        return pd.DataFrame({**columns, "day": day[order], "yoy": growth - 1})

    grown = grouped_apply(
        numbered, ["custkey", "frequency"], yearly, "custkey bigint, frequency string, day int, yoy double"
    )
    return grown.select(
        "custkey", F.date_from_unix_date("day").alias("month_end"), "frequency", F.nanvl("yoy", F.lit(None)).alias("yoy")
    )
