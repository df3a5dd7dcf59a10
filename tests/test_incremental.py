import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.operators import incremental as inc
from periodica.operators import schema


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0), (2, "b2", 2.5)], "k int, a string, b double")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, "B", 20.0), (3, "C", 30.0), (None, "N", 9.0)], "k int, a string, b double")


def test_merge_updates_all_copies_and_inserts_the_rest(target, source, rows):
    want = [(1, "a", 1.0), (2, "B", 20.0), (2, "B", 20.0), (3, "C", 30.0), (None, "N", 9.0), (None, "n", 0.0)]
    assert rows(inc.merge(target, source, ["k"])) == sorted(want, key=repr)


def test_merge_twice_is_merge_once(target, source, rows):
    keyed = source.dropna()
    once = inc.merge(target, keyed, ["k"])
    assert rows(inc.merge(once, keyed, ["k"])) == rows(once)


def test_merge_columns(target, source, rows):
    only = inc.merge(target, source, ["k"], only=["b"])
    assert (2, "b", 20.0) in rows(only) and (2, "b2", 20.0) in rows(only)
    rest = inc.merge(target, source, ["k"], exclude=["B"])
    assert (2, "B", 2.0) in rows(rest) and (2, "B", 2.5) in rows(rest)
    with pytest.raises(ValueError, match="not both"):
        inc.merge(target, source, ["k"], only=["a"], exclude=["b"])


def test_merge_predicate_inserts_beside_rejected_rows(target, source, rows):
    got = rows(inc.merge(target, source, ["k"], predicate=F.col("b") > 2.2))
    assert (2, "b", 2.0) in got and got.count((2, "B", 20.0)) == 1
    none = rows(inc.merge(target, source, ["k"], predicate=F.col("b") > 100))
    assert len(none) == 7 and (2, "b", 2.0) in none


def test_merge_duplicate_source_keys(spark, target, rows):
    matched = spark.createDataFrame([(2, "x", 1.0), (2, "y", 1.0)], target.schema)
    with pytest.raises(Exception, match="several source rows"):
        inc.merge(target, matched, ["k"]).collect()
    unmatched = spark.createDataFrame([(7, "x", 1.0), (7, "y", 1.0)], target.schema)
    assert len(rows(inc.merge(target, unmatched, ["k"]))) == 6


def test_merge_composite_key_and_missing_columns(spark, rows):
    t = spark.createDataFrame([(1, 1, "a", 5), (1, 2, "b", 6)], "x int, y int, a string, c int")
    s = spark.createDataFrame([(1, 2, "B"), (2, 2, "C")], "x int, y int, a string")
    assert rows(inc.merge(t, s, ["x", "y"])) == [(1, 1, "a", 5), (1, 2, "B", 6), (2, 2, "C", None)]


def test_merge_with_one_hot_target_key(spark):
    """One key holds most target rows; each of them is updated and none is lost."""
    t = spark.range(30_000).select(F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") + 10).cast("int").alias("k"), F.lit("old").alias("v"))
    s = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    got = {tuple(r) for r in inc.merge(t, s, ["k"]).groupBy("v").count().collect()}
    assert got == {("new", 20_001), ("old", 10_000)}


def test_delete_insert(target, source, rows):
    want = [(1, "a", 1.0), (2, "B", 20.0), (3, "C", 30.0), (None, "N", 9.0), (None, "n", 0.0)]
    assert rows(inc.delete_insert(target, source, ["k"])) == sorted(want, key=repr)
    spared = rows(inc.delete_insert(target, source, ["k"], predicate=F.col("b") < 2.2))
    assert (2, "b2", 2.5) in spared and (2, "b", 2.0) not in spared
    assert len(rows(inc.delete_insert(target, source, None))) == 7
    twice = source.unionByName(source)
    assert len(rows(inc.delete_insert(target, twice, ["k"]))) == 8


def test_replacements(target, source, rows):
    assert len(rows(inc.replace_where(target, source, F.col("k") == 2))) == 5
    assert rows(inc.replace_where(target, source)) == rows(source)
    assert rows(inc.overwrite(target, source, ["k"])) == [(2, None, None), (3, None, None), (None, None, None)]


def test_period_is_half_open(spark, rows):
    t = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "d string").select(F.to_date("d").alias("d"))
    start, end = F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-03"))
    assert len(rows(inc.replace_period(t, t.limit(0), "d", start, end))) == 1


def test_high_watermark(spark):
    s = spark.range(10)
    assert inc.newer_than_target(s, spark.range(5), "id").count() == 5
    assert inc.newer_than_target(s, spark.range(0), "id").count() == 10


def test_unknown_strategy(target, source):
    with pytest.raises(ValueError, match="unknown strategy"):
        inc.apply_strategy("replace_all", target, source)


# --- schemas ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def versions(spark):
    v1 = spark.createDataFrame([(1, "x", 5, 7)], "id long, gone string, narrow int, wide long")
    v2 = spark.createDataFrame([(1, "n", "text", 8), (2, "m", "more", 9)], "id long, added string, narrow string, wide int")
    return v1, v2


def test_changes(versions):
    v1, v2 = versions
    got = {(c.column_name, c.change) for c in schema.schema_changes(v2.schema, v1.schema)}
    assert got == {("added", "added"), ("narrow", "retyped"), ("gone", "removed")}


def test_append_sync_fail_ignore(versions, rows):
    v1, v2 = versions
    appended = inc.apply_strategy("append", v1, v2.drop("narrow"), "append_new_columns")
    assert appended.columns == ["id", "gone", "narrow", "wide", "added"]
    assert rows(appended) == [(1, "x", 5, 7, None), (1, None, None, 8, "n"), (2, None, None, 9, "m")]
    synced = inc.apply_strategy("append", v1, v2, "sync_all_columns")
    assert dict(synced.dtypes) == {"id": "bigint", "narrow": "string", "wide": "bigint", "added": "string"}
    assert (1, "5", 7, None) in rows(synced)
    with pytest.raises(schema.SchemaMismatch, match="out of sync"):
        inc.apply_strategy("append", v1, v2, "fail")
    with pytest.raises(schema.SchemaMismatch, match="lacks"):
        inc.apply_strategy("append", v1, v2, "ignore")
    assert inc.apply_strategy("append", v1.drop("gone", "narrow"), v2, "no such mode").columns == ["id", "wide"]


def test_widening_is_no_change():
    def fields(kind):
        return T.StructType([T.StructField("c", kind)])

    assert not schema.schema_changes(fields(T.IntegerType()), fields(T.LongType()))
    assert schema.schema_changes(fields(T.LongType()), fields(T.IntegerType()))
    assert not schema.schema_changes(fields(T.DecimalType(10, 2)), fields(T.DecimalType(28, 6)))
    assert schema.schema_changes(fields(T.DecimalType(28, 6)), fields(T.DecimalType(10, 2)))


def test_contract(versions):
    v1, _ = versions
    declared = T.StructType([v1.schema["wide"], v1.schema["id"], v1.schema["gone"], v1.schema["narrow"]])
    assert schema.enforce_contract(v1, declared).columns == ["wide", "id", "gone", "narrow"]
    with pytest.raises(schema.SchemaMismatch, match="declared None, actual int"):
        schema.enforce_contract(v1, T.StructType(declared.fields[:3]))
    with pytest.raises(schema.SchemaMismatch, match="no columns declared"):
        schema.enforce_contract(v1.select(), T.StructType())


def test_conform_typed_nulls_empty(spark, versions):
    v1, v2 = versions
    shaped = schema.conform(v2.drop("narrow"), v1.schema)
    assert shaped.dtypes == v1.dtypes
    assert [tuple(r) for r in shaped.orderBy("id").collect()] == [(1, None, None, 8), (2, None, None, 9)]
    nulls = spark.range(1).select(*schema.typed_nulls({"a": "decimal(28,6)", "b": "timestamp_ntz"}))
    assert [t for _, t in nulls.dtypes] == ["decimal(28,6)", "timestamp_ntz"]
    empty = schema.empty_like(v1)
    assert empty.dtypes == v1.dtypes and empty.count() == 0


@pytest.mark.parametrize(
    ("options", "condition"),
    [({}, None), ({"only": ["B"]}, None), ({"exclude": ["b"]}, None), ({}, "b > 2.2"), ({"only": ["a"]}, "a IS NULL OR b < 2.2")],
)
def test_merge_in_one_pass_is_the_merge(target, source, rows, options, condition):
    if condition:
        options = {**options, "predicate": F.expr(condition)}
    more = source.unionByName(source.sparkSession.createDataFrame([(7, "x", 1.0), (7, "y", 2.0)], source.schema))
    for data in (source, more, source.limit(0), source.drop("a") if "a" not in options.get("only", []) else source):
        want = rows(inc.merge(target, data, ["K"], **options))
        assert rows(inc.merge(target, data, ["K"], one_pass=True, **options)) == want


def test_merge_in_one_pass_finds_ambiguous_matches(target, source):
    twice = source.unionByName(source)
    with pytest.raises(Exception, match="several source rows"):
        inc.merge(target, twice, ["k"], one_pass=True).collect()


def test_merge_in_one_pass_casts_keys_to_those_of_the_target(target, source, rows):
    text = source.withColumn("k", F.col("k").cast("string"))
    assert rows(inc.merge(target, text, ["k"], one_pass=True)) == rows(inc.merge(target, source, ["k"]))
