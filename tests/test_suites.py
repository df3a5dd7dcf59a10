"""Suites: shared passes give what each check gives for itself."""

import re

import pytest

from periodica.operators import checks, suites
from periodica.operators.suites import Check


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, i % 7 if i % 5 else None, "abcd"[i % 4] if i % 11 else None, float(i)) for i in range(200)]
    return spark.createDataFrame(rows, "id int, k int, s string, v double").repartition(4)


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk long")


def suite(parent):
    return [
        Check("not_null", "k"),
        Check("not_null", "S", where="k > 2"),
        Check("not_null", "s", where="v < 0", fail_calc="sum(v)", name="none_fail"),
        Check("not_null", "k", fail_calc="max(v) - min(v)", name="span"),
        Check("not_null", "k", limit=3, name="limited_nulls", warn_if="> 2", error_if="> 3"),
        Check("unique", "id"),
        Check("unique", "k", fail_calc="sum(n_records)"),
        Check("unique", "k", where="s = 'a'", limit=2, name="limited_unique"),
        Check("unique", "k", limit=1, fail_calc="count(unique_field)", name="alone_unique"),
        Check("accepted_values", "s", values=("a", "b")),
        Check("accepted_values", "k", values=(0, 1, 2), fail_calc="max(n_records)", error_if="> 100"),
        Check("accepted_values", "k", values=(0, 1, 2), where="v > 150 OR s IS NULL", name="some_k"),
        Check("relationships", "k", to=parent, field="pk"),
        Check("relationships", "k", to=parent, field="pk", where="s = 'b'", limit=5, name="limited_orphans"),
        Check("relationships", "id", to=parent, field="pk", fail_calc="max(from_field)", name="last_orphan"),
    ]


def apart(data, check):
    failing = suites.failing_rows(data, check)
    row = checks.verdict(failing, check.fail_calc, check.warn_if, check.error_if, check.limit).first()
    total = failing.count()
    return (
        check.label,
        check.kind,
        check.column,
        None if row.failures is None else float(row.failures),
        check.limit is not None and total > check.limit,
        row.should_warn,
        row.should_error,
    )


COLUMNS = ["check_name", "kind", "column_name", "failures", "limited", "should_warn", "should_error"]


@pytest.mark.parametrize("stored", [False, True])
def test_shared_passes_are_the_checks_apart(data, parent, tmp_path, stored):
    declared = suite(parent)
    for _ in range(2 if stored else 1):  # a second run replaces what the first has stored
        got = suites.run(data, "m", declared, str(tmp_path / "f") if stored else None)
        assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == sorted(apart(data, c) for c in declared)
    if stored:
        kept = data.sparkSession.read.parquet(str(tmp_path / "f" / "not_null")).where("`check` = 'not_null_k'")
        assert kept.count() == data.where("k IS NULL").count() and {"id", "v"} <= set(kept.columns)


def test_empty_table(spark, data, parent):
    got = suites.run(data.limit(0), "m", suite(parent)).collect()
    assert len(got) == 15 and {r.failures for r in got} == {0.0, None}
    assert not any(r.limited for r in got)


def test_suite_reads_the_table_few_times(spark, data, parent, tmp_path):
    data.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    declared = [c for c in suite(parent) if c.where is None and not c.alone]
    assert len(declared) > 6
    text = suites.run(table, "m", declared)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", text)) == 3
    assert len(re.findall(r"Expand", text)) == 1


def test_declarations_are_checked(parent):
    with pytest.raises(ValueError, match="unknown check"):
        Check("nonsense", "k")
    with pytest.raises(ValueError, match="parent"):
        Check("relationships", "k")


def test_names_have_to_differ(data):
    with pytest.raises(ValueError, match="names of their own"):
        suites.run(data, "m", [Check("unique", "k"), Check("unique", "k", where="s = 'a'")])


def test_reports_are_ordered(spark, data):
    failing = checks.aggregated_unique(data, ["s", "k"])
    got = [(r.column_name, r.n_records, r.unique_field) for r in checks.ordered(failing).collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[1], r[2])) and len(got) == 11
    summary = checks.summary_by_column(checks.aggregated_not_null(data, ["s", "k"]))
    assert [r.column_name for r in checks.ordered(summary).collect()] == ["k", "s"]
    assert [r.column_name for r in checks.ordered(checks.aggregated_not_null(data, ["s", "k"])).limit(1).collect()] == ["k"]


def test_limit_of_a_verdict_says_so(data):
    row = suites.run(data, "m", [Check("not_null", "k", limit=40), Check("not_null", "k", limit=39, name="less")]).collect()
    assert {r.check_name: (r.failures, r.limited) for r in row} == {"not_null_k": (40.0, False), "less": (39.0, True)}
