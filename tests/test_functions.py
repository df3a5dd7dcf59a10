import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.fixed_values import SURROGATE_KEY_NULL
from periodica.functions import scalars as S
from periodica.functions.user_functions import (
    grouped_apply,
    in_pieces,
    python_aggregate,
    python_scalar,
    sql_aggregate,
    sql_scalar,
)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column).first()[0]


@pytest.mark.parametrize(
    "text, clean", [("X1", "X"), ("X21", "X"), ("X12", "X1"), ("A  B", "A B"), (" C ", "C"), ("X 1", "X"), ("\tY ", "Y")]
)
def test_clean_label(spark, text, clean):
    assert one(spark, text, S.clean_label("v")) == clean


@pytest.mark.parametrize("text, number", [("105,408", 105408.0), (None, None), ("n/a", None), ("-1.5", -1.5)])
def test_parse_number(spark, text, number):
    assert one(spark, text, S.parse_number("v")) == number


def test_strict_number_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "n/a", S.parse_number("v", strict=True))


@pytest.mark.parametrize("text, label", [(" Öl & Gas ", "öl___gas"), ("__", "triage"), ("", "triage"), ("a-b_c", "a-b_c")])
def test_sanitize_label(spark, text, label):
    assert one(spark, text, S.sanitize_label("v")) == label


@pytest.mark.parametrize(
    "text, date",
    [("Oct-25", dt.date(2025, 10, 31)), ("Feb-24", dt.date(2024, 2, 29)), ("Jan-95", dt.date(1995, 1, 31)),
     ("Jan-69", dt.date(1969, 1, 31)), ("Jan-68", dt.date(2068, 1, 31)), (None, None)],
)
def test_month_end(spark, text, date):
    assert one(spark, text, S.month_end("v")) == date


@pytest.mark.parametrize("text", ["2025", "Sept-24", ""])
def test_month_end_names_an_unreadable_label(spark, text):
    with pytest.raises(Exception, match=f"unreadable month label: {text}"):
        one(spark, text, S.month_end("v"))


@pytest.mark.parametrize(
    "part, start, end, count",
    [("month", "2024-01-31", "2024-02-01", 1), ("year", "2024-12-31", "2025-01-01", 1), ("week", "2024-01-07", "2024-01-08", 1),
     ("week", "2024-01-08", "2024-01-07", -1), ("quarter", "2024-03-31", "2024-04-01", 1), ("day", "2024-02-28", "2024-03-01", 2),
     ("week", "1969-12-28", "1969-12-29", 1)],
)
def test_boundaries_between(spark, part, start, end, count):
    assert one(spark, start, S.boundaries_between(part, F.to_date("v"), F.lit(end).cast("date"))) == count


def test_hour_boundaries(spark):
    column = S.boundaries_between("hour", F.to_timestamp_ntz("v"), F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    assert one(spark, "2024-01-01 00:59:59", column) == 2


def test_surrogate_key_marks_null(spark):
    import hashlib

    want = hashlib.md5(f"a-{SURROGATE_KEY_NULL}".encode()).hexdigest()
    assert one(spark, "a", S.surrogate_key("v", F.lit(None).cast("string"))) == want


def test_version_hash_and_right(spark):
    import hashlib

    assert one(spark, "a", S.version_hash("v", F.lit(None).cast("string"))) == hashlib.md5(b"a|").hexdigest()
    assert one(spark, "abc", S.right_text("v", 0)) == ""
    assert one(spark, "a,b,c", S.split_part("v", ",", -1)) == "c"


def test_let_and_compute_once_agree(spark):
    df = spark.createDataFrame([("ab",)], "v string")
    assert df.select(S.let(F.upper("v"), lambda x: F.concat(x, x))).first()[0] == "ABAB"
    assert S.compute_once(df, ["v"], u=F.upper("v")).where("u = 'AB'").count() == 1


def test_sql_function_default(spark):
    sql_scalar(spark, "plus_tax", [("price", "INT", None), ("tax", "INT", "2")], "INT", "price + tax")
    assert spark.sql("SELECT plus_tax(1), plus_tax(1, 5)").first()[:] == (3, 6)


def test_volatile_function_is_marked(spark):
    def same(values: pd.Series) -> pd.Series:
        return values

    assert python_scalar(same, "long").deterministic
    assert not python_scalar(same, "long", volatile=True).deterministic
    assert spark.range(3).select(python_scalar(same, "long")("id")).count() == 3


def mean_handler():
    class Mean:
        def __init__(self):
            self.state = (0.0, 0)

        def accumulate(self, values):
            self.merge((float(values.sum()), len(values)))

        def merge(self, other):
            self.state = (self.state[0] + other[0], self.state[1] + other[1])

        def finish(self):
            return self.state[0] / self.state[1] if self.state[1] else None

    return Mean


def test_python_aggregate_with_one_hot_key(spark, rows):
    """One key holds nine tenths of the rows and is spread over many tasks; NULL is a key too."""
    df = spark.range(0, 20_000, 1, 16).select(
        F.when(F.col("id") % 10 != 0, "hot").when(F.col("id") % 20 == 0, "cold").alias("k"), F.col("id").cast("double").alias("v")
    )
    got = {r[0]: r[1] for r in python_aggregate(df, ["k"], ["v"], mean_handler(), "m", T.DoubleType()).collect()}
    want = {r[0]: r[1] for r in df.groupBy("k").agg(F.avg("v")).collect()}
    assert got.keys() == want.keys() == {"hot", "cold", None}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_python_aggregate_without_keys(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    got = python_aggregate(df, [], ["v"], mean_handler(), "m", T.DoubleType())
    assert got.columns == ["m"] and [tuple(r) for r in got.collect()] == [(49.5,)]


def test_grouped_apply_sees_whole_groups(spark):
    """Groups reach over Arrow batches and must not be cut there."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(200).select((F.col("id") % 9).alias("k"), "id")

        def count(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"k": [group["k"].iloc[0]], "n": [len(group)], "s": [group["id"].sum()]})

        got = {tuple(r) for r in grouped_apply(df, ["k"], count, "k long, n long, s long").collect()}
        want = {tuple(r) for r in df.groupBy("k").agg(F.count("*"), F.sum("id")).collect()}
        assert got == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


WIDE = 2**53 + 1


def test_aggregate_keys_keep_type_and_value(spark):
    """No key is rounded beside a NULL; NULL, NaN and zero are three keys, both zeros are one."""
    rows = [(WIDE, 0.0, 1.0), (WIDE - 1, -0.0, 3.0), (None, float("nan"), 5.0), (None, None, 7.0), (WIDE, 0.0, 9.0)]
    df = spark.createDataFrame(rows, "k long, f double, v double")
    got = {tuple(r) for r in python_aggregate(df, ["k"], ["v"], mean_handler(), "m", T.DoubleType()).collect()}
    assert got == {(WIDE, 5.0), (WIDE - 1, 3.0), (None, 6.0)}
    got = {str(r[0]): r[1] for r in python_aggregate(df, ["f"], ["v"], mean_handler(), "m", T.DoubleType()).collect()}
    assert got == {"0.0": 13 / 3, "nan": 5.0, "None": 7.0}
    empty = python_aggregate(df.where("k = 5"), ["k"], ["v"], mean_handler(), "m", T.DoubleType())
    assert empty.columns == ["k", "m"] and not empty.collect()


def test_aggregate_keys_of_several_types(spark):
    df = spark.sql(
        "SELECT id % 3 AS a, IF(id % 2 = 0, NULL, date'2020-01-01') AS b, cast(id % 2 AS decimal(30, 2)) AS c,"
        " timestamp_ntz'2020-01-01 00:00:00.000001' AS d, cast(id AS double) AS v FROM range(60)"
    )
    keys = ["a", "b", "c", "d"]
    got = sorted(map(str, python_aggregate(df, keys, ["v"], mean_handler(), "m", T.DoubleType()).collect()))
    assert got == sorted(map(str, df.groupBy(*keys).agg(F.avg("v").alias("m")).collect()))


def test_python_aggregate_called_from_sql(spark):
    sql_aggregate(spark, "py_mean", mean_handler(), T.DoubleType())
    spark.createDataFrame([(WIDE, 1.0), (None, 2.0), (WIDE, 4.0), (WIDE - 1, 8.0)], "k long, v double").createOrReplaceTempView("py_in")
    got = spark.sql(
        "SELECT k, py_mean(s) AS m FROM (SELECT k, py_mean_state(v) AS s FROM"
        " (SELECT *, monotonically_increasing_id() DIV 2 AS piece FROM py_in) GROUP BY k, piece) GROUP BY k"
    )
    assert {tuple(r) for r in got.collect()} == {(WIDE, 2.5), (None, 2.0), (WIDE - 1, 8.0)}


def test_only_large_groups_are_cut(spark, rows):
    """Rows of 500 small keys lie all over the tasks, between those of two large ones; NULL is a large one."""
    df = spark.range(0, 20_000, 1, 8).selectExpr(
        "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN -1 ELSE id % 500 END AS k", "cast(id AS double) AS v"
    )
    cut = in_pieces(df, ["k"], rows=1_000)
    assert cut.columns == ["k", "v", "piece"]
    assert rows(cut.drop("piece")) == rows(df)
    counts = cut.groupBy("k", "piece").count().groupBy("k").agg(F.count("*").alias("n"), F.max("count").alias("most"))
    pieces = {r.k: r.n for r in counts.collect()}
    assert len(pieces) == 252 and {k: n for k, n in pieces.items() if n > 1} == {None: 5, -1: 5}
    assert all(r.most < 1_200 for r in counts.collect())


def test_sql_query_hands_over_each_small_group_once(spark, tmp_path):
    """One call per key of a table in many files, not one per key and file."""
    from periodica.catalog import QUERIES

    lines = spark.range(0, 6_000, 1, 6).selectExpr("id AS l_orderkey", "id % 300 AS l_suppkey", "cast(id % 50 AS double) AS l_quantity")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = QUERIES["sql_python_aggregate"](spark, str(tmp_path))
    assert got.count() == 301
    assert spark.table("spread_input").groupBy("wide_key", "piece").count().count() == 301


def test_grouped_apply_tells_null_from_nan(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 2), (float("nan"), 3), (1.0, 4)], "k double, v int")

    def count(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(group)], "s": [int(group["v"].sum())]})

    assert {tuple(r) for r in grouped_apply(df, ["k"], count, "n long, s long").collect()} == {(1, 1), (2, 5), (1, 4)}
