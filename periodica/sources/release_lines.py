"""Text lines of a monthly release -> typed records.

A region header and the table header apply to the lines after them. That state is carried by
aggregates over blocks of lines, so a release of any length is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.fixed_values import (
    FOOTER_PREFIX,
    FOOTNOTE_WORDS,
    HEADER_LINES,
    HEADER_PREFIXES,
    MIN_NUMBERS,
    MONTH_NAMES,
    NUMBER_PATTERN,
    REGION_ALL,
    REGION_EFTA,
    REGION_EU,
    REMAINDER_LABEL,
    SECTION_HEADER,
    YEAR_HEADER,
)
from periodica.functions.scalars import clean_label, compute_once, let, strip_space
from periodica.sources.files import period_label, year_before

BLOCK_LINES = 10_000


def _alternatives(texts: Sequence[str]) -> str:
    return "|".join(rf"\Q{t}\E" for t in texts)


NOISE_PATTERN = (
    rf"(?Us)^\s*\Q{FOOTER_PREFIX}\E"
    r"|^(?=.*page)(?=.*of)"
    rf"|^\s*[1-9] (?=.*(?:{_alternatives(FOOTNOTE_WORDS)}))"
)
COLUMN_HEADER_PATTERN = (
    rf"^(?:{_alternatives([*HEADER_PREFIXES, *[m.upper() for m in MONTH_NAMES]])})"
    rf"|^(?:{_alternatives(HEADER_LINES)})$"
)


def is_noise(line: Column) -> Column:
    """Footers, page marks and footnotes; blank lines are not noise."""
    return F.lower(line).rlike(NOISE_PATTERN)


def region_mark(upper: Column) -> Column:
    """Region an upper-cased header line opens, else NULL; the widest label is tested first."""
    return (
        F.when(F.contains(upper, F.lit(REGION_ALL)), F.lit(REGION_ALL))
        .when(F.contains(upper, F.lit("EUROPEAN UNION")), F.lit(REGION_EU))
        .when(F.startswith(upper, F.lit(REGION_EFTA)), F.lit(REGION_EFTA))
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    marks: Mapping[str, str],
    block: int = BLOCK_LINES,
    marked: DataFrame | None = None,
) -> DataFrame:
    """Last non-NULL value of columns up to and including each row, in ``order`` within the keys.

    ``marks`` maps input column to output column; ``order`` is an integer column and keys are not
    NULL. Rows are windowed inside blocks of ``block`` order values; what enters a block comes from
    one summary row per block. No task sees more than a block of rows, however long a group is.
    ``marked`` is a cheaper frame with at least the rows of ``df`` to take the summary from.
    """
    keys = list(keys)
    numbered = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    summarised = (df if marked is None else marked).withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    ends = summarised.groupBy(*keys, "_block").agg(
        *[F.max_by(m, F.when(F.col(m).isNotNull(), F.col(order))).alias(f"_end_{m}") for m in marks]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entering = ends.select(
        *keys, "_block", *[F.last(f"_end_{m}", ignorenulls=True).over(before).alias(f"_in_{m}") for m in marks]
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    seen = numbered.withColumns(
        {out: F.last(m, ignorenulls=True).over(inside) for m, out in marks.items()}
    )
    joined = seen.join(entering, [*keys, "_block"], "left")
    return joined.select(
        *[c for c in df.columns if c not in marks.values()],
        *[F.coalesce(F.col(out), F.col(f"_in_{m}")).alias(out) for m, out in marks.items()],
    )


def parse_lines(
    lines: DataFrame,
    document: str,
    order: str,
    line: str,
    period: str,
    year_header: str | Column = YEAR_HEADER,
    block: int = BLOCK_LINES,
) -> DataFrame:
    """Records of all releases: four per data line (month and year-to-date, this and last year).

    ``period`` is a date column with the release's month. Output carries the document and the
    contract's six columns, units as printed.
    """
    stripped = compute_once(
        lines.where(F.col(line).isNotNull()),
        [document, order, period],
        _line=strip_space(F.col(line)),
        _noise=is_noise(F.col(line)),
    )
    plain = compute_once(
        stripped.where((F.col("_line") != "") & ~F.col("_noise")), [document, order, period, "_line"], _upper=F.upper("_line")
    )
    pattern = F.lit(NUMBER_PATTERN)
    header_year = F.lit(year_header) if isinstance(year_header, str) else year_header
    column_header = F.col("_upper").rlike(COLUMN_HEADER_PATTERN) | F.startswith("_upper", header_year)
    region = region_mark(F.col("_upper"))
    is_table = F.contains("_upper", F.lit(SECTION_HEADER))
    kinds = compute_once(
        plain,
        [document, order, period, "_line"],
        _region_mark=region,
        _table_mark=F.when(region.isNull() & is_table, F.lit(True)),
        _at=F.when(region.isNull() & ~is_table & ~column_header, F.regexp_instr("_line", pattern)),
    )
    is_mark = F.col("_region_mark").isNotNull() | F.col("_table_mark").isNotNull()
    kinds = kinds.where(is_mark | (F.col("_at") > 1))

    # A number glued to a letter is a footnote mark: neither part of the name nor a figure.
    glued = F.substr("_line", F.col("_at") - 1, F.lit(1)).rlike(r"^\p{L}$")
    first_number = F.regexp_substr("_line", pattern)
    start = F.when(glued, F.col("_at") + F.length(first_number)).otherwise(F.col("_at"))
    name = strip_space(F.substr("_line", F.lit(1), F.col("_at") - 1))
    state = [document, order, period, "_region_mark", "_table_mark"]
    fields = compute_once(
        kinds,
        state,
        _name=F.when(F.col("_at") > 1, let(name, lambda n: F.when(n != "", clean_label(n)))),
        _numbers=F.when(F.col("_at") > 1, F.regexp_extract_all(F.substr("_line", start), pattern, F.lit(0))),
    )
    is_data = (F.size("_numbers") >= MIN_NUMBERS) & (F.col("_name") != REMAINDER_LABEL)
    # Everything that depends on one line alone is done; only marks and data lines are moved.
    placed = carry_forward(
        fields.where(is_mark | is_data),
        [document],
        order,
        {"_region_mark": "_region", "_table_mark": "_in_table"},
        block,
        marked=kinds.select(*state),
    )
    return explode_records(placed.where(F.col("_in_table") & F.col("_name").isNotNull()), document, period)


def explode_records(named: DataFrame, document: str, period: str) -> DataFrame:
    """One wide row -> four typed records."""
    this_year = period_label(F.col(period))
    last_year = period_label(year_before(F.col(period)))
    numbers = F.col("_numbers")

    def record(frequency: str, month: Column, place: int) -> Column:
        return F.struct(
            F.lit(frequency).alias("frequency"), month.alias("month"), numbers[place].alias("units")
        )

    records = F.array(
        record("M", this_year, 2),
        record("M", last_year, 3),
        record("YTD", this_year, 7),
        record("YTD", last_year, 8),
    )
    return named.select(
        document,
        F.col("_name").alias("manufacturer"),
        F.coalesce("_region", F.lit(REGION_EU)).alias("region"),
        this_year.alias("pdf"),
        F.inline(records),
    ).select(document, "manufacturer", "frequency", "month", "units", "region", "pdf")
