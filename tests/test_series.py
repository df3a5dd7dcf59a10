import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from periodica.fixed_values import METRICS
from periodica.operators import calendars
from periodica.operators.dedupe import attach_latest, keep_latest
from periodica.operators.series import (
    add_metrics,
    densify_months,
    growth,
    monthly_mean,
    to_long,
    trailing_sum,
    year_to_date,
    yearly_growth,
)
from periodica.plans import models


def day(text):
    return dt.date.fromisoformat(text)


def ends(start, count):
    return [d.date() for d in pd.date_range(start, periods=count, freq="ME")]


def test_gap_takes_value_before_it_and_leading_null_stays(spark, rows):
    data = [
        ("a", day("2024-02-29"), 10.0),
        ("a", day("2024-03-31"), 0.0),
        ("a", day("2024-05-31"), 30.0),
        ("b", day("2024-02-29"), None),
        ("b", day("2024-03-31"), 5.0),
    ]
    df = spark.createDataFrame(data, "k string, d date, u double")
    dense = densify_months(df, ["k"], "d", "u", filled_flag="filled")
    assert rows(dense) == [
        ("a", day("2024-02-29"), 10.0, False),
        ("a", day("2024-03-31"), 0.0, False),
        ("a", day("2024-04-30"), 0.0, True),
        ("a", day("2024-05-31"), 30.0, False),
        ("b", day("2024-02-29"), None, False),
        ("b", day("2024-03-31"), 5.0, False),
    ]
    grown = dense.withColumn("g", growth(["k"], "d", "u")).where("k = 'a'").orderBy("d")
    assert [r.g for r in grown.collect()] == [None, -1.0, None, None]


def test_null_in_the_middle_is_filled(spark, rows):
    data = [("a", day("2024-01-31"), 1.0), ("a", day("2024-02-29"), None), ("a", day("2024-04-30"), 4.0)]
    dense = densify_months(spark.createDataFrame(data, "k string, d date, u double"), ["k"], "d", "u")
    assert [r[2] for r in rows(dense)] == [1.0, 1.0, 1.0, 4.0]


def test_mean_within_month_drops_null_keys(spark, rows):
    data = [("a", day("2024-01-03"), 1.0), ("a", day("2024-01-30"), 4.0), (None, day("2024-01-30"), 9.0)]
    df = spark.createDataFrame(data, "k string, d date, u double")
    assert rows(monthly_mean(df, ["k"], "d", "u")) == [("a", day("2024-01-31"), 2.5)]


def test_totals_and_lags_match_pandas(spark):
    series = {"M": ends("2023-06-30", 20), "Q": ends("2023-06-30", 8)}
    data = [
        ("maker", frequency, "eu", date, None if (frequency == "M" and i == 3) else float((i * 7) % 11))
        for frequency, dates in series.items()
        for i, date in enumerate(dates)
    ]
    keys = ["manufacturer", "frequency", "region"]
    df = spark.createDataFrame(data, "manufacturer string, frequency string, region string, date date, UNITS double")
    got = add_metrics(df, keys, "date", "frequency").toPandas().sort_values(["frequency", "date"]).reset_index(drop=True)

    want = pd.DataFrame(data, columns=[*keys, "date", "UNITS"]).sort_values(["frequency", "date"]).reset_index(drop=True)
    year = pd.to_datetime(want["date"]).dt.year
    want["YTD"] = want.groupby([*keys, year])["UNITS"].cumsum()
    want["TTM"] = want.groupby(keys)["UNITS"].transform(lambda x: x.rolling(12, min_periods=1).sum())
    for cut in ["UNITS", "YTD", "TTM"]:
        for name, lags in [("PoP", {"M": 1, "Q": 1}), ("YoY", {"M": 12, "Q": 4})]:
            base = pd.concat([g[cut].shift(lags[f[1]]) for f, g in want.groupby(keys)])
            want[f"{cut}_{name}"] = want[cut] / base.where(base != 0) - 1
    for column in METRICS:
        pd.testing.assert_series_equal(got[column], want[column], check_names=False, check_dtype=False)


def test_partial_ttm_and_yearly_reset(spark):
    data = [("a", d, 1.0) for d in ends("2023-02-28", 14)]
    df = spark.createDataFrame(data, "k string, d date, u double")
    out = df.select("d", trailing_sum(["k"], "d", "u").alias("t"), year_to_date(["k"], "d", "u").alias("y"))
    ordered = out.orderBy("d").collect()
    assert [r.t for r in ordered] == [float(min(i, 12)) for i in range(1, 15)]
    assert [r.y for r in ordered] == [float(i) for i in range(1, 12)] + [1.0, 2.0, 3.0]


def test_yearly_lag_is_a_parameter(spark):
    data = [("a", "W", d, float(i)) for i, d in enumerate(ends("2023-01-31", 4), start=1)]
    df = spark.createDataFrame(data, "k string, f string, d date, u double")
    out = df.withColumn("g", yearly_growth(["k"], "d", "u", "f", lags={"W": 2}))
    assert [r.g for r in out.orderBy("d").collect()] == [None, None, 2.0, 1.0]


def test_long_form_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, 2.0), ("b", 3.0, None)], "k string, x double, y double")
    assert to_long(df, ["k"], ["x", "y"]).count() == 4


def raw(spark, data):
    return spark.createDataFrame(
        data, "manufacturer string, frequency string, month string, units double, region string, pdf string, inserted_at string"
    )


def test_newest_release_wins_although_its_label_sorts_lower(spark, rows):
    facts = raw(
        spark,
        [
            ("X", "M", "Sep-24", 1.0, "eu", "Sep-24", "t"),
            ("X", "M", "Sep-24", 2.0, "eu", "Apr-25", "t"),
            ("X", "M", "Sep-24", 3.0, "eu", None, "t"),
        ],
    )
    newest = models.deduplicate(models.stage(facts))
    assert rows(newest, "units", "pdf_name") == [(2.0, "Apr-25")]


def test_dedupe_is_idempotent_and_breaks_ties(spark, rows):
    data = [("k", 1, 1, "a"), ("k", 1, 2, "b"), ("k", None, 9, "c"), (None, 1, 1, "d"), (None, 2, 1, "e")]
    df = spark.createDataFrame(data, "k string, version int, seq int, v string")
    once = keep_latest(df, ["k"], ["version", "seq"])
    assert rows(once, "v") == [("b",), ("e",)]
    assert rows(keep_latest(once, ["k"], ["version", "seq"])) == rows(once)
    attached = attach_latest(df, ["k"], ["version", "seq"], "v", "latest")
    assert rows(attached, "v", "latest") == [("a", "b"), ("b", "b"), ("c", "b"), ("d", "e"), ("e", "e")]


def test_mart_has_nine_rows_per_month_and_no_gaps(spark):
    facts = raw(
        spark,
        [
            ("X", "M", "Nov-98", 4.0, "eu", "Nov-98", "t"),
            ("X", "M", "Feb-99", 6.0, "eu", "Feb-99", "t"),
            ("X", "YTD", "Feb-99", 99.0, "eu", "Feb-99", "t"),
            (None, "M", "Feb-99", 5.0, "eu", "Feb-99", "t"),
        ],
    )
    mart = models.metrics_mart(models.deduplicate(models.stage(facts)))
    got = mart.where("measure = 'UNITS'").orderBy("date").collect()
    assert [r.date for r in got] == ends("1998-11-30", 4)
    assert [r.value for r in got] == [4.0, 4.0, 4.0, 6.0]
    assert mart.count() == 4 * 9


def test_spine_is_half_open(spark, rows):
    spans = spark.createDataFrame(
        [("same", "2024-01-01", "2024-01-01"), ("leap", "2024-02-28", "2024-03-01"), ("month", "2024-01-31", "2024-04-30")],
        "k string, a string, b string",
    )

    def spine(part):
        out = calendars.date_spine(spans, part, F.to_date("a"), F.to_date("b"), "d")
        return rows(out.select("k", F.date_format("d", "MM-dd")))

    assert [r for r in spine("day") if r[0] != "month"] == [("leap", "02-28"), ("leap", "02-29")]
    assert [r[1] for r in spine("month") if r[0] == "month"] == ["01-31", "02-29", "03-31"]


def test_series_and_ranges_reject_bad_bounds(spark):
    one = spark.range(1)
    assert calendars.number_series(one, F.lit(3), "n").count() == 3
    blocks = calendars.number_series(one, F.lit(25), "n", block=7)
    assert sorted(r.n for r in blocks.collect()) == list(range(1, 26))
    with pytest.raises(Exception, match="upper bound must be positive"):
        calendars.number_series(one, F.lit(0), "n").collect()
    with pytest.raises(Exception, match="start is after end"):
        calendars.dates_in_range(one, F.lit("20240102,20240101"), "d").collect()
    with pytest.raises(Exception, match="expected start"):
        calendars.dates_in_range(one, F.lit("20240101,20240102,20240103"), "d").collect()
    days = calendars.dates_in_range(one, F.lit("20240228, 20240301"), "d").collect()
    assert [r.d for r in days] == ["20240228", "20240229", "20240301"]
    assert [r.d for r in calendars.dates_in_range(one, F.lit("20240228"), "d").collect()] == ["20240228"]


def test_month_labels_stop_at_the_last_complete_month(spark, rows):
    span = spark.createDataFrame([("2024-01-15", "2024-03-30")], "a string, b string")
    out = calendars.month_labels(span, F.to_date("a"), F.to_date("b"), "label")
    assert rows(out, "label") == [("February_2024",), ("January_2024",)]
