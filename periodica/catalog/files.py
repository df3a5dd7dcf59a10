"""Release files and report lines, written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.catalog.bindings import LOADED_AT, MONTHLY_SPENT, RAW_FACTS, money, raw_facts, with_sql
from periodica.catalog.registry import query
from periodica.fixed_values import FOOTER_PREFIX, FOOTNOTE_WORDS
from periodica.functions.scalars import month_end
from periodica.operators.schema import conform
from periodica.plans.tables import replace_folder
from periodica.session import table, work_dir
from periodica.sources import files
from periodica.sources.release_lines import explode_records, is_noise, parse_lines

# --- release CSVs -----------------------------------------------------------------------------


def write_releases(spark, folder) -> str:
    """The facts as CSV, one folder per release, beside text files a scan has to pass over.

    The rebalance hint gives each release its own files and splits a release that is too large.
    """
    root = work_dir(spark, "releases")
    facts = raw_facts(spark, folder).select(
        F.col("manufacturer").alias("Manufacturer"),
        F.col("frequency").alias("Frequency"),
        F.col("month").alias("Month"),
        F.format_number("units", 0).alias("Units"),
        F.col("region").alias("Region"),
        F.col("pdf").alias("PDF"),
        F.concat(
            F.lit("Press_release_car_registrations_"), F.date_format(month_end("pdf"), "MMMM_yyyy")
        ).alias("release"),
    )
    (
        facts.hint("rebalance", "release")
        .write.partitionBy("release")
        .option("header", True)
        .csv(f"{root}/csv")
    )
    table(spark, folder, "nation").select("n_name").write.text(f"{root}/csv/notes")
    return f"{root}/csv"


def scanned(spark, folder) -> DataFrame:
    rows = files.scan_csv(spark, write_releases(spark, folder), files.RELEASE_SCHEMA, "*.csv", one_layout=True)
    return rows.withColumn("release", F.regexp_extract("file_path", "/release=([^/]+)/", 1))


RELEASE_NAME = "'Press_release_car_registrations_' || strftime(release_month, '%B_%Y')"


@query(
    "scan_csv_glob",
    with_sql(
        RAW_FACTS,
        f"SELECT manufacturer AS \"Manufacturer\", frequency AS \"Frequency\", month AS \"Month\", "
        f"format('{{:,}}', CAST(units AS BIGINT)) AS \"Units\", region AS \"Region\", pdf AS \"PDF\", {RELEASE_NAME} AS release "
        "FROM raw_facts",
    ),
)
def scan_csv_glob(spark, folder):
    return scanned(spark, folder).drop("file_path", "file_name")


@query(
    "scan_csv_by_name",
    with_sql(
        RAW_FACTS,
        f"""SELECT manufacturer AS "Manufacturer", frequency AS "Frequency", month AS "Month",
       format('{{:,}}', CAST(units AS BIGINT)) AS "Units",
       CASE WHEN month(release_month) % 3 <> 1 THEN region END AS "Region", pdf AS "PDF", {RELEASE_NAME} AS release
FROM raw_facts""",
    ),
)
def scan_csv_by_name(spark, folder):
    """Every third release has its columns in another order and case, every third lacks the region and has a note."""
    root = work_dir(spark, "layouts")
    rows = scanned(spark, folder).drop("file_path", "file_name")
    turn = F.month(files.period_from_name("release")) % 3
    reordered = [F.col("PDF").alias("pdf"), "Units", F.col("Region").alias("REGION"), "Month", "Frequency", "Manufacturer"]
    layouts = [["Manufacturer", "Frequency", "Month", "Units", "Region", "PDF"]]
    layouts += [[F.lit("a, note").alias("Note"), "Manufacturer", "Month", "Frequency", "PDF", "Units"], reordered]
    for number, columns in enumerate(layouts):
        some = rows.where(turn == number).select(*columns, "release")
        some.write.mode("append").partitionBy("release").option("header", True).csv(f"{root}/csv")
    read = files.scan_csv(spark, f"{root}/csv", files.RELEASE_SCHEMA, "*.csv")
    read = read.withColumn("release", F.regexp_extract("file_path", "/release=([^/]+)/", 1))
    return read.drop("file_path", "file_name")


@query(
    "load_raw",
    with_sql(
        RAW_FACTS,
        "SELECT manufacturer, frequency, month, units, region, pdf, inserted_at, CAST(NULL AS VARCHAR) AS note FROM raw_facts",
    ),
)
def load_raw(spark, folder):
    """Files to raw table: scan, clean numbers, stamp, conform to the table's columns."""
    loaded = files.load_raw(scanned(spark, folder), LOADED_AT)
    texts = ["manufacturer", "frequency", "month", "region", "pdf", "inserted_at", "note"]
    raw_table = T.StructType(
        [T.StructField(c, T.StringType()) for c in texts] + [T.StructField("units", T.DoubleType())]
    )
    return conform(loaded, raw_table)


@query(
    "file_manifest",
    with_sql(RAW_FACTS, f"SELECT {RELEASE_NAME} AS release, count(*) AS n_rows, 6 AS n_cols FROM raw_facts GROUP BY 1"),
)
def file_manifest(spark, folder):
    return files.manifest(scanned(spark, folder), "release", len(files.RELEASE_SCHEMA))


@query(
    "period_from_name",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, "
    "strftime(o_orderdate, '%b-%y') AS label, strftime(o_orderdate - INTERVAL 12 MONTH, '%b-%y') AS label_before FROM orders",
)
def period_from_name(spark, folder):
    name = F.concat(
        F.lit("Press_release_order_"),
        F.col("o_orderkey").cast("string"),
        F.lit("x_"),
        F.date_format("o_orderdate", "MMMM_yyyy"),
        F.lit(".pdf"),
    )
    period = files.period_from_name(name)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        period.alias("period"),
        files.period_label(period).alias("label"),
        files.period_label(files.year_before(period)).alias("label_before"),
    )


@query("load_extract", with_sql(MONTHLY_SPENT, "SELECT custkey, month_end, spent FROM m"))
def load_extract(spark, folder):
    path = f"{work_dir(spark, 'extract')}/csv"
    monthly = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"), F.last_day("o_orderdate").alias("month_end"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("spent"))
    )
    monthly.write.option("header", True).csv(path)
    layout = T.StructType([T.StructField(f.name, f.dataType) for f in monthly.schema])
    return files.load_extract(spark, path, layout, "custkey", "month_end")


# --- report lines -----------------------------------------------------------------------------
# One report per nation and month. Regions are played by order statuses, makers by segments.


def monthly_amounts(spark, folder) -> DataFrame:
    """Spending per nation, status, segment and month: month, year-to-date, and both a year before."""
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderstatus", F.trunc("o_orderdate", "MM").alias("m"))
        .agg(F.sum(money("o_totalprice")).alias("spent"))
    )
    homes = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    group = ["n_name", "o_orderstatus", "c_mktsegment"]
    summed = (
        per_customer.join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(*group, "m")
        .agg(F.floor(F.sum("spent")).cast("bigint").alias("cur"))
    )
    in_year = Window.partitionBy(*group, F.year("m")).orderBy("m")
    running = summed.withColumn("ytd", F.sum("cur").over(in_year))
    before = running.select(
        *group, F.add_months("m", 12).alias("m"), F.col("cur").alias("prev"), F.col("ytd").alias("ytd_prev")
    )
    return running.join(before, [*group, "m"], "left").fillna(0, ["prev", "ytd_prev"])


AMOUNTS = """
summed AS (
  SELECT n_name, o_orderstatus, c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
         CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS BIGINT) AS cur
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
running AS (
  SELECT *, CAST(sum(cur) OVER (PARTITION BY n_name, o_orderstatus, c_mktsegment, year(m) ORDER BY m) AS BIGINT) AS ytd
  FROM summed),
amounts AS (
  SELECT r.*, coalesce(b.cur, 0) AS prev, coalesce(b.ytd, 0) AS ytd_prev
  FROM running r LEFT JOIN running b ON r.n_name = b.n_name AND r.o_orderstatus = b.o_orderstatus
       AND r.c_mktsegment = b.c_mktsegment AND r.m = b.m + INTERVAL 12 MONTH),
labelled AS (
  SELECT *, 'Press_release_' || n_name || '_' || strftime(m, '%B_%Y') || '.pdf' AS doc,
         CASE o_orderstatus WHEN 'F' THEN 'European Union (EU)' WHEN 'O' THEN 'EFTA' ELSE 'EU + EFTA + UK' END AS region,
         strftime(m, '%b-%y') AS pdf, strftime(m - INTERVAL 12 MONTH, '%b-%y') AS pdf_before
  FROM amounts),
records AS (
  SELECT doc, m, c_mktsegment AS manufacturer, 'M' AS frequency, pdf AS month, cur AS amount, region, pdf FROM labelled
  UNION ALL SELECT doc, m, c_mktsegment, 'M', pdf_before, prev, region, pdf FROM labelled
  UNION ALL SELECT doc, m, c_mktsegment, 'YTD', pdf, ytd, region, pdf FROM labelled
  UNION ALL SELECT doc, m, c_mktsegment, 'YTD', pdf_before, ytd_prev, region, pdf FROM labelled)"""


def report_name() -> F.Column:
    return F.concat(
        F.lit("Press_release_"), "n_name", F.lit("_"), F.date_format("m", "MMMM_yyyy"), F.lit(".pdf")
    )


def report_lines(spark, folder) -> DataFrame:
    """The reports as stored text lines, with every kind of line a parser has to step over."""
    amounts = monthly_amounts(spark, folder).withColumn("doc", report_name())
    section = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    amounts = amounts.withColumn("base", section * 100)
    maker = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("BUILDING2")).otherwise(F.col("c_mktsegment"))
    figures = F.concat_ws(
        " ",
        F.lit("12.3 11.9"),
        F.format_number("cur", 0),
        F.format_number("prev", 0),
        F.lit("+4.1 10.0 9.8"),
        F.format_number("ytd", 0),
        F.format_number("ytd_prev", 0),
        F.lit("-1.0"),
    )
    data = amounts.select(
        "doc",
        "m",
        (F.col("base") + F.ascii("c_mktsegment") - 50).alias("line_no"),
        F.concat_ws(" ", maker, figures).alias("line"),
    )
    header = (
        F.when(F.col("base") == 0, F.lit("EUROPEAN UNION (EU)"))
        .when(F.col("base") == 100, F.lit("EFTA countries"))
        .otherwise(F.lit("EU + EFTA + UK"))
    )
    year = F.year("m")
    furniture = [
        (1, header),
        (2, F.lit("New car registrations by manufacturer")),
        (3, F.lit("% share 1 2 3 4 5 6 7 8 9 10")),
        (4, F.concat_ws(" ", year, year - 1, F.lit("1 2 3 4 5 6 7 8 9"))),
        (5, F.lit("JANUARY 1 2 3 4 5 6 7 8 9 10")),
        (6, F.lit("(EU)")),
        (7, F.lit("  ")),
        (50, F.lit("Others 1.0 1.0 11 12 +1.0 1.0 1.0 13 14 -1.0")),
        (51, F.lit("Too short 1 2 3 4 5 6 7 8")),
        (60, F.lit("1 Includes 2 makers 3 4 5 6 7 8 9 10 11 12")),
        (70, F.lit("Page 3 of 7 with 1 2 3 4 5 6 7 8 9")),
    ]
    lines = F.array(
        *[F.struct((F.col("base") + F.lit(n)).alias("line_no"), text.alias("line")) for n, text in furniture]
    )
    frame = amounts.select("doc", "m", "base").distinct().select("doc", "m", F.inline(lines))
    return replace_folder(data.unionByName(frame), f"{work_dir(spark, 'lines')}/reports")


def parsed(lines: DataFrame) -> DataFrame:
    period = files.period_from_name("doc")
    year_header = F.concat_ws(" ", F.year("period"), F.year("period") - 1)
    return parse_lines(lines.withColumn("period", period), "doc", "line_no", "line", "period", year_header, block=100)


RECORD = "doc, manufacturer, frequency, month, format('{:,}', amount) AS units, region, pdf"


@query("parse_report_lines", with_sql(AMOUNTS, f"SELECT {RECORD} FROM records"))
def parse_report_lines(spark, folder):
    return parsed(report_lines(spark, folder).drop("m"))


@query(
    "fallback_source",
    with_sql(
        AMOUNTS,
        f"SELECT {RECORD}, CASE WHEN year(m) < 1998 THEN 'secondary' ELSE 'primary' END AS source FROM records",
    ),
)
def fallback_source(spark, folder):
    """Reports before 1998 lost their table header in the first text source."""
    lines = report_lines(spark, folder)
    lost = (F.year("m") < 1998) & F.col("line").startswith("New car")
    primary = parsed(lines.where(~lost).drop("m")).withColumn("source", F.lit("primary"))
    primary = replace_folder(primary, f"{work_dir(spark, 'primary')}/records")
    left = files.lines_without_records(lines.drop("m"), primary, "doc")
    return primary.unionByName(parsed(left).withColumn("source", F.lit("secondary")))


MONTHLY_RECORDS = f"""{AMOUNTS},
monthly AS (
  SELECT 'Press_release_' || strftime(m, '%B_%Y') || '.txt' AS file, manufacturer, frequency, month, region, pdf,
         CAST(sum(amount) AS BIGINT) AS amount
  FROM records GROUP BY ALL)"""


def write_reports(spark, folder) -> str:
    """One text file per month, all nations together, in a folder per year; the first line tells its name."""
    lines = report_lines(spark, folder)
    name = F.concat(F.lit("Press_release_"), F.date_format("m", "MMMM_yyyy"))
    is_data = F.col("line").rlike("^[A-Z]+2? 12.3 11.9")
    figures = F.split(F.regexp_replace("line", ",", ""), " ")
    spent = F.transform(F.array(*[figures[i] for i in (3, 4, 8, 9)]), lambda v: v.cast("bigint"))
    data = lines.where(is_data).select("m", "line_no", figures[0].alias("maker"), spent.alias("v"))
    data = data.groupBy("m", "line_no", "maker").agg(*[F.format_number(F.sum(F.col("v")[i]), 0).alias(f"v{i}") for i in range(4)])
    text = F.concat_ws(" ", "maker", F.lit("12.3 11.9"), "v0", "v1", F.lit("+4.1 10.0 9.8"), "v2", "v3", F.lit("-1.0"))
    rows = data.select("m", "line_no", text.alias("line"))
    rows = rows.unionByName(lines.where(~is_data).select("m", "line_no", "line").distinct())
    # A file is the text of one month, bounded by the number of its makers and sections.
    whole = rows.groupBy("m").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
    whole = whole.select(F.year("m").alias("year"), name.alias("release"), F.concat_ws("\n", "lines.line").alias("value"))
    root = work_dir(spark, "reports")
    whole.repartition("year").write.partitionBy("year", "release").text(root)
    return root


@query(
    "file_discovery",
    "SELECT 'year=' || year(o_orderdate) || '/release=Press_release_' || strftime(o_orderdate, '%B_%Y') AS folder, 1 AS n_files, "
    "true AS sorted FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def file_discovery(spark, folder):
    """The report files found in nested folders, by path; their order is checked against their names."""
    found = files.list_files(spark, write_reports(spark, folder), "*.txt")
    placed = found.withColumn("place", F.monotonically_increasing_id())
    before = F.lag("path").over(Window.partitionBy(F.regexp_extract("path", "(year=[0-9]+)/", 1)).orderBy("place"))
    in_order = placed.withColumn("sorted", F.coalesce(before < F.col("path"), F.lit(True)))
    return in_order.groupBy(F.regexp_extract("path", "(year=[^/]+/release=[^/]+)/", 1).alias("folder")).agg(
        F.count(F.lit(1)).cast("int").alias("n_files"), F.every("sorted").alias("sorted")
    )


@query(
    "parse_report_files",
    with_sql(
        MONTHLY_RECORDS, "SELECT file, manufacturer, frequency, month, format('{:,}', amount) AS units, region, pdf FROM monthly"
    ),
)
def parse_report_files(spark, folder):
    """Reports read from text files of the same name in nested folders, line by line with their byte positions."""
    lines = files.scan_lines(spark, write_reports(spark, folder))
    named = lines.withColumn("file", F.concat(F.regexp_extract("file_path", "/release=([^/]+)/", 1), F.lit(".txt")))
    period = files.period_from_name("file")
    year_header = F.concat_ws(" ", F.year("period"), F.year("period") - 1)
    return parse_lines(named.withColumn("period", period), "file", "line_no", "line", "period", year_header, block=4 << 20)


@query("explode_records", with_sql(AMOUNTS, f"SELECT {RECORD} FROM records"))
def explode_records_query(spark, folder):
    amounts = monthly_amounts(spark, folder).withColumn("doc", report_name())
    region = (
        F.when(F.col("o_orderstatus") == "O", "EFTA").when(F.col("o_orderstatus") == "P", "EU + EFTA + UK")
    )
    blank = F.lit("0")
    figures = [
        blank,
        blank,
        F.format_number("cur", 0),
        F.format_number("prev", 0),
        blank,
        blank,
        blank,
        F.format_number("ytd", 0),
        F.format_number("ytd_prev", 0),
    ]
    wide = amounts.select(
        "doc", "m", region.alias("_region"), F.col("c_mktsegment").alias("_name"), F.array(*figures).alias("_numbers")
    )
    return explode_records(wide, "doc", "m")


@query(
    "filter_noise_lines",
    rf"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
tested AS (SELECT doc_id, line, lower(line) AS low, regexp_replace(line, '^\s+', '') AS bare FROM lines)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE
         starts_with(lower(bare), '{FOOTER_PREFIX}') OR (low LIKE '%page%' AND low LIKE '%of%')
         OR (regexp_matches(bare, '^[1-9] ') AND regexp_matches(low,
             '{'|'.join(FOOTNOTE_WORDS)}'))) AS n_noise
FROM tested GROUP BY 1""",
)
def filter_noise_lines(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(is_noise(F.col("line"))).alias("n_noise")
    )
