"""Data checks over the given tables and the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.catalog.bindings import DEDUPED, TARGET_END, orders_source, orders_target, raw_facts, with_sql
from periodica.catalog.registry import query
from periodica.operators import checks, suites
from periodica.plans import models
from periodica.plans.tables import replace_folder
from periodica.session import table, work_dir


def _orders_with_gaps(spark, folder):
    """Orders whose pending status and medium priority are missing."""
    return (
        table(spark, folder, "orders")
        .withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))
        .withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))
    )


GAPS = """
gaps AS (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus, nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority)
         FROM orders)"""


@query(
    "check_unique",
    "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL "
    "GROUP BY 1 HAVING count(*) > 1",
)
def check_unique(spark, folder):
    return checks.unique(table(spark, folder, "orders"), "o_custkey")


@query("check_not_null", with_sql(GAPS, "SELECT * FROM gaps WHERE o_orderstatus IS NULL"))
def check_not_null(spark, folder):
    return checks.not_null(_orders_with_gaps(spark, folder), "o_orderstatus")


@query(
    "check_accepted_values",
    with_sql(
        GAPS,
        "SELECT o_orderpriority AS value_field, count(*) AS n_records FROM gaps "
        "WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1",
    ),
)
def check_accepted_values(spark, folder):
    return checks.accepted_values(_orders_with_gaps(spark, folder), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "check_relationships",
    f"SELECT l_orderkey AS from_field FROM lineitem WHERE l_orderkey NOT IN "
    f"(SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_END}')",
)
def check_relationships(spark, folder):
    return checks.relationships(
        table(spark, folder, "lineitem"), "l_orderkey", orders_target(spark, folder), "o_orderkey"
    )


@query(
    "check_with_where",
    "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders "
    "WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1 HAVING count(*) > 1",
)
def check_with_where(spark, folder):
    rows = checks.with_where(
        table(spark, folder, "orders"), "o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"
    )
    return checks.unique(rows, "o_custkey")


WATCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
REPEATED = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS unique_field, count(*) AS n_records FROM lineitem "
    f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    for c in WATCHED
)


@query("check_aggregated_unique", REPEATED)
def check_aggregated_unique(spark, folder):
    return checks.aggregated_unique(table(spark, folder, "lineitem"), [*WATCHED, "l_tax"], skip=["l_tax"])


@query(
    "check_aggregated_not_null",
    with_sql(
        GAPS,
        "SELECT 'o_orderstatus' AS column_name FROM gaps WHERE o_orderstatus IS NULL "
        "UNION ALL SELECT 'o_orderpriority' FROM gaps WHERE o_orderpriority IS NULL",
    ),
)
def check_aggregated_not_null(spark, folder):
    return checks.aggregated_not_null(
        _orders_with_gaps(spark, folder), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    )


@query(
    "check_summary",
    f"SELECT column_name, count(*) AS failures, count(*) > 0 AS should_warn, count(*) > 0 AS should_error "
    f"FROM ({REPEATED}) GROUP BY 1",
)
def check_summary(spark, folder):
    return checks.summary_by_column(checks.aggregated_unique(table(spark, folder, "lineitem"), WATCHED))


@query(
    "check_verdict",
    "SELECT CAST(sum(n_records) AS BIGINT) AS failures, sum(n_records) > 10 AS should_warn, "
    "sum(n_records) > 1000000000 AS should_error FROM "
    "(SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1)",
)
def check_verdict(spark, folder):
    return checks.verdict(check_unique(spark, folder), "sum(n_records)", "> 10", "> 1000000000")


@query(
    "check_store_failures",
    with_sql(
        GAPS,
        "SELECT count(*) AS failures, count(*) <> 0 AS should_warn, count(*) <> 0 AS should_error FROM gaps "
        "WHERE o_orderpriority IS NULL",
    ),
)
def check_store_failures(spark, folder):
    failing = checks.not_null(_orders_with_gaps(spark, folder), "o_orderpriority")
    return checks.verdict(checks.store_failures(failing, f"{work_dir(spark, 'failures')}/not_null"))


@query(
    "unit_diff",
    """
WITH src AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'),
tgt AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT *, 'actual' AS actual_or_expected FROM (SELECT * FROM src EXCEPT ALL SELECT * FROM tgt)
UNION ALL SELECT *, 'expected' FROM (SELECT * FROM tgt EXCEPT ALL SELECT * FROM src)""",
)
def unit_diff(spark, folder):
    return checks.unit_diff(
        orders_source(spark, folder), orders_target(spark, folder), ["o_orderkey", "o_orderstatus", "o_totalprice"]
    )


@query(
    "fixture_rows",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, 'actual' AS actual_or_expected FROM orders GROUP BY 1, 2
UNION ALL SELECT * FROM (VALUES ('F', '1-URGENT', 1000, 'expected'), ('P', NULL, NULL, 'expected'))""",
)
def fixture_rows(spark, folder):
    """Unit-test report: order counts beside two expected rows, one of them incomplete."""
    actual = (
        table(spark, folder, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    )
    layout = T.StructType([T.StructField(f.name, f.dataType) for f in actual.schema])
    expected = checks.fixture_rows(
        spark,
        [
            {"O_ORDERSTATUS": "F", "o_orderpriority": "1-URGENT", "n_orders": 1000},
            {"o_orderstatus": "P"},
        ],
        layout,
    )
    return checks.labelled_union(actual, expected, layout.names)


def _suite_sql() -> str:
    rows = []
    for model, source, declared in [
        ("staged", "staged", models.STAGE_CHECKS),
        ("deduped", "deduped", models.DEDUPED_CHECKS),
        ("mart", "points", models.MART_CHECKS),
    ]:
        for column, kinds in declared.items():
            for kind in kinds:
                failing = (
                    f"(SELECT count(*) FROM {source} WHERE {column} IS NULL)"
                    if kind == "not_null"
                    else f"(SELECT count(*) FROM (SELECT {column} FROM {source} GROUP BY 1 HAVING count(*) > 1))"
                )
                rows.append(f"SELECT '{model}' AS model, '{kind}' AS check_name, '{column}' AS column_name, {failing} AS failures")
    return "SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM (" + "\nUNION ALL ".join(rows) + ")"


@query(
    "check_suite",
    with_sql(
        f"""{DEDUPED},
staged AS (SELECT *, pdf AS pdf_name FROM raw_facts),
points AS (SELECT manufacturer, region, frequency, last_day(strptime(month, '%b-%y')) AS date FROM deduped
           WHERE frequency <> 'YTD')""",
        _suite_sql(),
    ),
)
def check_suite(spark, folder):
    """The declared checks of all three models, one verdict row each, on the models' tables."""
    root = work_dir(spark, "suite")
    staged = replace_folder(models.stage(raw_facts(spark, folder)), f"{root}/staged")
    deduped = replace_folder(models.deduplicate(staged), f"{root}/deduped")
    mart = replace_folder(models.metrics_mart(deduped), f"{root}/mart")
    parts = [
        checks.run_suite(rows, name, checks.declared_suite(declared))
        for rows, name, declared in [
            (staged, "staged", models.STAGE_CHECKS),
            (deduped, "deduped", models.DEDUPED_CHECKS),
            (mart, "mart", models.MART_CHECKS),
        ]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _full_suite(spark, folder) -> dict[str, tuple[DataFrame, list[suites.Check]]]:
    def of(name: str) -> DataFrame:
        return table(spark, folder, name)

    orders = of("orders").withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))
    return {
        "orders": (
            orders,
            [
                suites.Check("not_null", "o_orderkey"),
                suites.Check("not_null", "o_orderpriority", warn_if="> 1000000", error_if="> 2000000"),
                suites.Check("not_null", "o_orderpriority", where="o_orderstatus = 'P'", fail_calc="sum(o_custkey)", name="unset_pending"),
                suites.Check("not_null", "o_orderpriority", where="o_orderstatus = 'X'", fail_calc="max(o_custkey)", name="unset_none"),
                suites.Check("unique", "o_orderkey"),
                suites.Check("unique", "o_custkey", fail_calc="sum(n_records)", name="repeated_customers"),
                suites.Check("unique", "o_custkey", where="o_orderstatus = 'P'", limit=10, name="repeated_pending"),
                suites.Check("accepted_values", "o_orderstatus", values=("F", "O")),
                suites.Check("accepted_values", "o_orderpriority", values=("1-URGENT",), fail_calc="max(n_records)", error_if="< 0"),
                suites.Check("relationships", "o_custkey", to=of("customer"), field="c_custkey"),
                suites.Check("relationships", "o_orderkey", to=of("lineitem"), field="l_orderkey", where="o_orderstatus <> 'F'"),
                suites.Check("relationships", "o_custkey", to=of("supplier"), field="s_suppkey", limit=100, name="customers_supply"),
                suites.Check(
                    "relationships", "o_custkey", to=of("supplier"), field="s_suppkey", fail_calc="max(from_field)", name="last_customer"
                ),
            ],
        ),
        "lineitem": (
            of("lineitem"),
            [
                suites.Check("not_null", "l_shipdate"),
                suites.Check("unique", "l_orderkey", where="l_linenumber > 1", warn_if=">= 0", error_if="< 0"),
                suites.Check("accepted_values", "l_linenumber", values=(1, 2, 3)),
                suites.Check("relationships", "l_partkey", to=of("part"), field="p_partkey"),
                suites.Check("relationships", "l_suppkey", to=of("supplier").where("s_acctbal > 0"), field="s_suppkey"),
            ],
        ),
    }


def _full_suite_sql() -> str:
    """Every check counted for itself, as its own subquery."""
    part = "(SELECT {} FROM ({}))"
    nulls = "SELECT * FROM o WHERE o_orderpriority IS NULL AND {}"
    repeated = "SELECT {0} AS value, count(*) AS n_records FROM {1} WHERE {2} GROUP BY 1 HAVING count(*) > 1"
    outside = "SELECT {0} AS value, count(*) AS n_records FROM {1} WHERE {0} NOT IN ({2}) GROUP BY 1"
    orphans = "SELECT {0} AS value FROM {1} WHERE {2} AND {0} NOT IN (SELECT {3} FROM {4})"
    ten = repeated.format("o_custkey", "o", "o_orderstatus = 'P'")
    supply = orphans.format("o_custkey", "o", "true", "s_suppkey", "supplier")
    rows = [
        ("orders", "not_null_o_orderkey", "not_null", "o_orderkey", part.format("count(*)", "SELECT * FROM o WHERE o_orderkey IS NULL"), "false", "<> 0", "<> 0"),
        ("orders", "not_null_o_orderpriority", "not_null", "o_orderpriority", part.format("count(*)", nulls.format("true")), "false", "> 1000000", "> 2000000"),
        ("orders", "unset_pending", "not_null", "o_orderpriority", part.format("sum(o_custkey)", nulls.format("o_orderstatus = 'P'")), "false", "<> 0", "<> 0"),
        ("orders", "unset_none", "not_null", "o_orderpriority", "NULL", "false", "<> 0", "<> 0"),
        ("orders", "unique_o_orderkey", "unique", "o_orderkey", part.format("count(*)", repeated.format("o_orderkey", "o", "true")), "false", "<> 0", "<> 0"),
        ("orders", "repeated_customers", "unique", "o_custkey", part.format("sum(n_records)", repeated.format("o_custkey", "o", "true")), "false", "<> 0", "<> 0"),
        ("orders", "repeated_pending", "unique", "o_custkey", part.format("least(count(*), 10)", ten), part.format("count(*) > 10", ten), "<> 0", "<> 0"),
        ("orders", "accepted_values_o_orderstatus", "accepted_values", "o_orderstatus", part.format("count(*)", outside.format("o_orderstatus", "o", "'F', 'O'")), "false", "<> 0", "<> 0"),
        ("orders", "accepted_values_o_orderpriority", "accepted_values", "o_orderpriority", part.format("max(n_records)", outside.format("o_orderpriority", "o", "'1-URGENT'")), "false", "<> 0", "< 0"),
        ("orders", "relationships_o_custkey", "relationships", "o_custkey", part.format("count(*)", orphans.format("o_custkey", "o", "true", "c_custkey", "customer")), "false", "<> 0", "<> 0"),
        ("orders", "relationships_o_orderkey", "relationships", "o_orderkey", part.format("count(*)", orphans.format("o_orderkey", "o", "o_orderstatus <> 'F'", "l_orderkey", "lineitem")), "false", "<> 0", "<> 0"),
        ("orders", "customers_supply", "relationships", "o_custkey", part.format("least(count(*), 100)", supply), part.format("count(*) > 100", supply), "<> 0", "<> 0"),
        ("orders", "last_customer", "relationships", "o_custkey", part.format("max(value)", supply), "false", "<> 0", "<> 0"),
        ("lineitem", "not_null_l_shipdate", "not_null", "l_shipdate", part.format("count(*)", "SELECT * FROM lineitem WHERE l_shipdate IS NULL"), "false", "<> 0", "<> 0"),
        ("lineitem", "unique_l_orderkey", "unique", "l_orderkey", part.format("count(*)", repeated.format("l_orderkey", "lineitem", "l_linenumber > 1")), "false", ">= 0", "< 0"),
        ("lineitem", "accepted_values_l_linenumber", "accepted_values", "l_linenumber", part.format("count(*)", outside.format("l_linenumber", "lineitem", "1, 2, 3")), "false", "<> 0", "<> 0"),
        ("lineitem", "relationships_l_partkey", "relationships", "l_partkey", part.format("count(*)", orphans.format("l_partkey", "lineitem", "true", "p_partkey", "part")), "false", "<> 0", "<> 0"),
        ("lineitem", "relationships_l_suppkey", "relationships", "l_suppkey", part.format("count(*)", orphans.format("l_suppkey", "lineitem", "true", "s_suppkey", "supplier WHERE s_acctbal > 0")), "false", "<> 0", "<> 0"),
    ]
    selects = [
        f"SELECT '{m}' AS model, '{name}' AS check_name, '{kind}' AS kind, '{column}' AS column_name, failures, {cut} AS limited, "
        f"failures {warn} AS should_warn, failures {error} AS should_error FROM (SELECT CAST({value} AS DOUBLE) AS failures)"
        for m, name, kind, column, value, cut, warn, error in rows
    ]
    return with_sql("o AS (SELECT * REPLACE (nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority) FROM orders)", "\nUNION ALL ".join(selects))


@query("check_suite_full", _full_suite_sql())
def check_suite_full(spark, folder):
    """All kinds of checks over orders and line items, with conditions, limits and measures, failures stored."""
    root = work_dir(spark, "failures")
    parts = [suites.run(rows, name, suite, f"{root}/{name}") for name, (rows, suite) in _full_suite(spark, folder).items()]
    return parts[0].unionByName(parts[1])


@query(
    "check_report_order",
    """
SELECT * FROM (
  SELECT 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS unique_field, count(*) AS n_records FROM orders GROUP BY 2
  UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2)
WHERE n_records > 1 ORDER BY column_name, n_records DESC, unique_field""",
)
def check_report_order(spark, folder):
    """Repeated values of three columns in the order of a report."""
    failing = checks.aggregated_unique(table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])
    return checks.ordered(failing)
