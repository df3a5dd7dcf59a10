import pytest

from periodica.operators import checks, triage


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", None), (None, "c", 2.0), (None, None, 3.0), (2, "z", 4.0)], "k int, s string, v double"
    )


@pytest.fixture(scope="module")
def clean(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")


def test_unique_and_not_null(data, clean, rows):
    assert rows(checks.unique(data, "k")) == [(1, 2)]
    assert rows(checks.unique(clean, "k")) == []
    assert rows(checks.not_null(data, "s"), "v") == [(3.0,)]
    assert checks.not_null(data, "s", keep_columns=False).columns == ["s"]


def test_accepted_values_pass_null(data, clean, rows):
    assert rows(checks.accepted_values(data, "s", ["a", "b", "c"])) == [("z", 1)]
    assert rows(checks.accepted_values(clean, "s", ["a", "b"])) == []


def test_relationships_keep_copies_and_pass_null(spark, clean, rows):
    child = spark.createDataFrame([(9,), (9,), (1,), (None,)], "k int")
    assert rows(checks.relationships(child, "k", clean, "k")) == [(9,), (9,)]


def test_aggregated(data, rows):
    assert rows(checks.aggregated_unique(data, ["k", "s", "v"])) == [("k", "1", 2)]
    assert rows(checks.aggregated_unique(data, ["k"], skip=["k"])) == []
    assert rows(checks.aggregated_not_null(data, ["k", "s", "v"])) == [("k",), ("k",), ("s",), ("v",)]
    summary = checks.summary_by_column(checks.aggregated_not_null(data, ["k", "s"]))
    assert rows(summary) == [("k", 2, True, True), ("s", 1, True, True)]


def test_verdicts(data, clean, rows):
    failing = checks.not_null(data, "k")
    assert rows(checks.verdict(failing)) == [(2, True, True)]
    assert rows(checks.verdict(failing, warn_if="> 1", error_if="> 2")) == [(2, True, False)]
    assert rows(checks.verdict(failing, limit=1)) == [(1, True, True)]
    assert rows(checks.verdict(checks.not_null(clean, "k"))) == [(0, False, False)]


def test_suite(data, rows):
    suite = checks.declared_suite({"k": ["unique", "not_null"], "v": ["not_null"]})
    got = rows(checks.run_suite(data, "m", suite), "check_name", "column_name", "failures", "should_error")
    assert got == [("not_null", "k", 2, True), ("not_null", "v", 1, True), ("unique", "k", 1, True)]
    with pytest.raises(ValueError, match="unknown checks"):
        checks.run_suite(data, "m", [checks.ColumnCheck("k", "odd")])


def test_store_failures_replaces(data, clean, tmp_path):
    path = str(tmp_path / "failures")
    assert checks.store_failures(checks.not_null(data, "k"), path).count() == 2
    assert checks.store_failures(checks.not_null(clean, "k"), path).count() == 0


def test_unit_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(checks.unit_diff(a, b, ["x"])) == [(1, "actual"), (2, "actual"), (3, "expected")]
    assert checks.labelled_union(a, b, ["x"]).count() == 5


def test_fixture_rows(spark, data, rows):
    got = checks.fixture_rows(spark, [{"K": 1, "V": 2.5}, {"s": "x"}], data.schema)
    assert got.dtypes == data.dtypes
    assert rows(got) == [(1, None, 2.5), (None, "x", None)]
    with pytest.raises(ValueError, match="nope"):
        checks.fixture_rows(spark, [{"nope": 1}], data.schema)


def test_triage(spark, rows):
    data = spark.createDataFrame(
        [("a", "2024-01-31", 1.0), ("a", "2024-02-29", 5.0), ("b", "2024-02-29", 5.0), ("c", "2024-02-29", 9.0), ("d", "2024-01-31", 99.0)],
        "e string, d string, v double",
    ).selectExpr("e", "to_date(d) d", "v")
    assert rows(triage.top_entities(data, "e", "d", "v", 2), "e", "v") == [("a", 1.0), ("a", 5.0), ("c", 9.0)]
    assert len(rows(triage.latest_rows(data, "d"))) == 3
    assert triage.profile(data, "e", "d", 2).first()[:2] == (5, 4)


def test_joined_text(spark, rows):
    data = spark.createDataFrame([("g", "b", 2), ("g", "a", 3), ("g", "c", 1), ("h", None, 1)], "g string, v string, o int")
    assert rows(triage.joined_text(data, ["g"], "v", "o", ",", "t")) == [("g", "c,b,a"), ("h", "")]
    assert rows(triage.joined_text(data, ["g"], "v", "o", ",", "t", limit=2)) == [("g", "c,b"), ("h", "")]
