"""Monthly time series: densify, running totals, growth, long form.

Everything after ``monthly_mean`` works on one row per (series, month), so the rows of a window
partition are bounded by the calendar, however many raw rows a series has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.functions.scalars import all_known


def monthly_mean(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Mean per series and month, dated on the month's last day; rows with a NULL key drop out."""
    known = df.where(all_known([*keys, date]))
    return known.groupBy(*keys, F.last_day(date).alias(date)).agg(F.avg(value).alias(value))


def densify_months(
    df: DataFrame, keys: Sequence[str], date: str, value: str, filled_flag: str | None = None
) -> DataFrame:
    """Every month between a series' own first and last, gaps taking the value before them.

    Input holds one row per (series, month). Each row is repeated until the month before the
    series' next row, which needs one window and no calendar join. A NULL takes the last value
    known in the same series; NULLs at its start stay.
    """
    in_order = Window.partitionBy(*keys).orderBy(date)
    start = F.trunc(date, "MM")
    following = F.trunc(F.lead(date).over(in_order), "MM")
    filled = df.select(
        *keys,
        F.last(value, ignorenulls=True).over(in_order).alias(value),
        start.alias("_start"),
        F.coalesce(F.add_months(following, -1), start).alias("_stop"),
    )
    months = filled.withColumn(
        "_month", F.explode(F.sequence("_start", "_stop", F.expr("interval 1 month")))
    )
    columns = [*[F.col(k) for k in keys], F.last_day("_month").alias(date), F.col(value)]
    if filled_flag:
        columns.append((F.col("_month") != F.col("_start")).alias(filled_flag))
    return months.select(*columns)


def year_to_date(keys: Sequence[str], date: str, value: str) -> Column:
    """Running sum that starts over each year; NULL where the value is NULL."""
    frame = (
        Window.partitionBy(*keys, F.year(date))
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.when(F.col(value).isNotNull(), F.sum(value).over(frame))


def trailing_sum(keys: Sequence[str], date: str, value: str, rows: int = 12) -> Column:
    """Sum of the last ``rows`` rows, over fewer at the start of a series."""
    frame = Window.partitionBy(*keys).orderBy(date).rowsBetween(1 - rows, Window.currentRow)
    return F.sum(value).over(frame)


def growth(keys: Sequence[str], date: str, value: str, lag: int = 1) -> Column:
    """Relative change against ``lag`` rows before; NULL for a missing or zero base."""
    base = F.lag(value, lag).over(Window.partitionBy(*keys).orderBy(date))
    return F.try_divide(F.col(value), base) - 1


def yearly_growth(
    keys: Sequence[str],
    date: str,
    value: str,
    frequency: str,
    lags: Mapping[str, int] | None = None,
    default_lag: int = 4,
) -> Column:
    """Growth over a year's worth of rows, whose number depends on the series' frequency."""
    result = growth(keys, date, value, default_lag)
    for name, lag in (lags or {"M": 12}).items():
        result = F.when(F.col(frequency) == name, growth(keys, date, value, lag)).otherwise(result)
    return result


def add_metrics(
    df: DataFrame, keys: Sequence[str], date: str, frequency: str, value: str = "UNITS"
) -> DataFrame:
    """Year-to-date, trailing-twelve-month and growth columns beside ``value``.

    The series key is the prefix of every window partition, so all of them run on one shuffle. The
    year-to-date total comes first, because it alone wants the rows in another order.
    """
    cuts = [value, "YTD", "TTM"]
    totals = df.withColumn("YTD", year_to_date(keys, date, value)).withColumn(
        "TTM", trailing_sum(keys, date, value)
    )
    change = {f"{c}_PoP": growth(keys, date, c) for c in cuts}
    change |= {f"{c}_YoY": yearly_growth(keys, date, c, frequency) for c in cuts}
    return totals.withColumns(change)


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "measure", value: str = "value"
) -> DataFrame:
    """Wide to long; NULL values keep their row."""
    return df.unpivot(list(ids), list(values), name, value)
