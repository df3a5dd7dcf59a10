"""Date and number series, generated inside Spark from columns of a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.functions.scalars import add_interval, boundaries_between


def date_spine(df: DataFrame, part: str, start: Column, end: Column, output: str) -> DataFrame:
    """For each row the dates start, start + 1 part, ...: as many as period boundaries lie before ``end``.

    No date where none is crossed. Long spans are filled in blocks, like any ``number_series``.
    """
    begin, stop = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    counted = df.withColumn("_begin", begin).withColumn("_periods", boundaries_between(part, begin, stop))
    numbered = number_series(counted.where("_periods > 0"), F.col("_periods"), "_period")
    dated = numbered.withColumn(output, add_interval(part, F.col("_period") - 1, F.col("_begin")))
    return dated.drop("_begin", "_periods", "_period")


def number_series(df: DataFrame, upper: Column, output: str, block: int = 1_000_000) -> DataFrame:
    """For each row the numbers 1..upper; an upper bound below 1 is an error.

    A long series is first cut into blocks, which are spread over all tasks before they are filled.
    """
    bound = F.when(upper >= 1, upper).otherwise(
        F.raise_error(F.lit("upper bound must be positive")).cast("bigint")
    )
    bounded = df.withColumn("_upper", bound.cast("bigint"))
    blocks = bounded.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_upper") - 1) / F.lit(block))))
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, *blocks.columns)
    first = F.col("_block") * block + 1
    last = F.least(F.col("_upper"), (F.col("_block") + 1) * block)
    return spread.withColumn(output, F.explode(F.sequence(first, last))).drop("_upper", "_block")


def dates_in_range(
    df: DataFrame, spec: Column, output: str, in_format: str = "yyyyMMdd", out_format: str = "yyyyMMdd"
) -> DataFrame:
    """For each row the days of a 'start[,end]' text, both ends included, formatted.

    More than two parts, unreadable dates and an end before the start are errors.
    """
    parts = F.split(spec.cast("string"), ",")
    first = F.to_date(F.trim(parts[0]), in_format)
    last = F.to_date(F.trim(F.try_element_at(parts, F.size(parts))), in_format)

    def fail(message: str) -> Column:
        return F.raise_error(F.concat(F.lit(message), spec.cast("string"))).cast("array<date>")

    days = (
        F.when(F.size(parts) > 2, fail("expected start[,end], got "))
        .when(last < first, fail("start is after end in "))
        .otherwise(F.sequence(first, last, F.expr("interval 1 day")))
    )
    return df.withColumn(output, F.explode(days)).withColumn(output, F.date_format(output, out_format))


def month_labels(
    df: DataFrame, start: Column, end: Column, output: str, label_format: str = "MMMM_yyyy"
) -> DataFrame:
    """For each row the labels of all month-ends between ``start`` and ``end``."""
    first = F.trunc(start.cast("date"), "MM")
    last = F.trunc(end.cast("date"), "MM")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    spread = df.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    labelled = spread.withColumn("_month", F.explode(months)).where(
        (F.last_day("_month") <= end.cast("date")) & (F.last_day("_month") >= start.cast("date"))
    )
    return labelled.withColumn(output, F.date_format("_month", label_format)).drop(
        "_first", "_last", "_month"
    )


def shift_back_a_year(value: Column) -> Column:
    return add_interval("month", -12, value)
