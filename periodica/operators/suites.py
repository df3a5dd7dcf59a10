"""Suites of declared checks, planned into few scans of the checked table.

Checks of one kind meet in one pass, whatever columns they are on:
- ``not_null``: one scan tags each row with the checks it fails;
- ``unique`` and ``accepted_values``: one aggregate by grouping sets for each condition, in which both kinds on a
  column share its counts;
- ``relationships``: one scan lays out the values of all child columns, counted before they are moved, and one join
  meets them with the keys of all parents.
A check that has to look at single failing rows in another way (another measure over orphans, a measure over a limited
number of rows) runs for itself, and still gives the same row. Failing rows can be stored, one table per family of
checks, partitioned by check and replaced by every run; the verdicts then are taken from these tables.

Conditions, limits and measures are those of a check run alone (``checks.verdict``): the condition cuts the rows, the
limit the failing rows, before they are measured; NULL passes all kinds but ``not_null``. No failing rows measure what
the measure gives for none, so a sum is NULL and neither warns nor errs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.operators import checks
from periodica.operators.joins import rows_without
from periodica.operators.schema import find

COUNT = "count(*)"
KINDS = ("not_null", "unique", "accepted_values", "relationships")


@dataclass(frozen=True)
class Check:
    """A declared check. ``values`` are those accepted; ``to`` and ``field`` are the parent table and its key."""

    kind: str
    column: str
    values: tuple = ()
    to: DataFrame | None = None
    field: str | None = None
    where: str | None = None
    limit: int | None = None
    fail_calc: str = COUNT
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    name: str | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown check: {self.kind}")
        if self.kind == "relationships" and (self.to is None or self.field is None):
            raise ValueError(f"relationships on {self.column} needs the parent table and its field")

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}_{self.column}"

    @property
    def counted(self) -> bool:
        return self.fail_calc.replace(" ", "").lower() in (COUNT, "count(1)")

    @property
    def alone(self) -> bool:
        """Does it need rows that the shared passes do not have?"""
        return not self.counted and (self.limit is not None or self.kind == "relationships")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The failing rows of one check run for itself."""
    rows = checks.with_where(df, check.where)
    if check.kind == "not_null":
        return checks.not_null(rows, check.column)
    if check.kind == "unique":
        return checks.unique(rows, check.column)
    if check.kind == "accepted_values":
        return checks.accepted_values(rows, check.column, check.values)
    return checks.relationships(rows, check.column, check.to, check.field)


def _where(check: Check) -> Column:
    return F.coalesce(F.expr(check.where), F.lit(False)) if check.where else F.lit(True)


def _tagged(conditions: Sequence[tuple[str, Column]]) -> Column:
    """One row per condition that holds, with its name as ``check``."""
    return F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions]))).alias("check")


def failing_not_null(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """(check, all columns): one scan."""
    found = [(c.label, F.col(c.column).isNull() & _where(c)) for c in suite]
    return df.select(_tagged(found), *df.columns)


def failing_values(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """(check, unique_field, value_field, n_records) of unique and accepted_values: one aggregate per condition.

    Values are counted and compared in their own types; failing ones are shown as text.
    """
    parts = []
    for where in dict.fromkeys(c.where for c in suite):
        own = [c for c in suite if c.where == where]
        names = list(dict.fromkeys(find(df.schema, c.column).name for c in own))
        rows = checks.with_where(df, where).select(*names)
        counted = rows.groupingSets([[n] for n in names], *names).agg(
            *[F.grouping(n).alias(f"_not_{i}") for i, n in enumerate(names)], F.count(F.lit(1)).alias("n_records")
        )
        found = []
        for check in own:
            place = names.index(find(df.schema, check.column).name)
            value = F.col(names[place])
            fails = F.col("n_records") > 1 if check.kind == "unique" else ~value.isin(list(check.values))
            found.append((check.label, (F.col(f"_not_{place}") == 0) & value.isNotNull() & fails))
        text = F.coalesce(*[F.col(n).cast("string") for n in names])
        parts.append(counted.select(_tagged(found), text.alias("unique_field"), text.alias("value_field"), "n_records"))
    return reduce(DataFrame.unionByName, parts)


def failing_orphans(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """(check, from_field, n_rows) of child values without a parent: one scan of the children, one join.

    Values are compared in the parent's type and met as text.
    """
    kinds = {c.label: find(c.to.schema, c.field).dataType for c in suite}
    cells = [
        F.when(_where(c), F.struct(F.lit(c.label).alias("check"), F.col(c.column).cast(kinds[c.label]).cast("string").alias("from_field")))
        for c in suite
    ]
    children = df.select(F.inline(F.array_compact(F.array(*cells)))).where("from_field IS NOT NULL")
    children = children.groupBy("check", "from_field").agg(F.count(F.lit(1)).alias("n_rows"))
    parents = [
        c.to.select(F.lit(c.label).alias("check"), F.col(c.field).cast("string").alias("from_field")) for c in suite
    ]
    return rows_without(children, reduce(DataFrame.unionByName, parents), ["check", "from_field"])


def _measured(failing: DataFrame, suite: Sequence[Check], count: Column) -> DataFrame:
    """(check, n, failures) of the checks with failing rows, each by its own measure."""
    others = list(dict.fromkeys(c.fail_calc for c in suite if not c.counted))
    rows = failing.groupBy("check").agg(
        count.alias("n"), *[F.expr(calc).cast("double").alias(f"_m{i}") for i, calc in enumerate(others)]
    )
    measure = F.col("n").cast("double")
    for check in suite:
        if not check.counted:
            measure = F.when(F.col("check") == check.label, F.col(f"_m{others.index(check.fail_calc)}")).otherwise(measure)
    return rows.select("check", "n", measure.alias("failures"))


def _measure_of_none(failing: DataFrame, suite: Sequence[Check]) -> dict[str, float | None]:
    """What each measure gives for no rows, by check."""
    others = [c for c in suite if not c.counted]
    if not others:
        return {c.label: 0.0 for c in suite}
    row = failing.limit(0).agg(*[F.expr(c.fail_calc).cast("double") for c in others]).first()
    return {c.label: 0.0 for c in suite} | {c.label: v for c, v in zip(others, row, strict=True)}


def _family(df: DataFrame, suite: Sequence[Check], build, count: Column, path: str | None) -> DataFrame:
    """Verdicts (check, n, failures) of the checks that share a pass."""
    failing = build(df, suite)
    if path:
        failing.write.mode("overwrite").partitionBy("check").parquet(path)
        failing = df.sparkSession.read.schema(failing.schema).parquet(path)
    none = _measure_of_none(failing, suite)
    every = df.sparkSession.createDataFrame([(c.label, none[c.label]) for c in suite], "check string, none double")
    met = every.join(_measured(failing, suite, count), "check", "left")
    return met.select(
        "check", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), F.col("none")).otherwise(F.col("failures")).alias("failures")
    )


def _alone(df: DataFrame, check: Check, path: str | None) -> DataFrame:
    failing = failing_rows(df, check)
    if path:
        failing = checks.store_failures(failing, path)
    kept, seen = failing, failing
    if check.limit is not None:
        kept, seen = failing.limit(check.limit), failing.limit(check.limit + 1)
    n = seen.select(F.count(F.lit(1))).scalar()
    return kept.agg(F.expr(check.fail_calc).cast("double").alias("failures")).select(
        F.lit(check.label).alias("check"), n.alias("n"), "failures"
    )


def run(df: DataFrame, model: str, suite: Sequence[Check], store: str | None = None) -> DataFrame:
    """One verdict row per check; ``store`` is a folder for the failing rows.

    ``limited`` tells that the limit has cut the failing rows, so that ``failures`` may be too low.
    """
    labels = [c.label for c in suite]
    if len(set(labels)) < len(labels):
        raise ValueError(f"checks need names of their own: {sorted({x for x in labels if labels.count(x) > 1})}")

    def folder(name: str) -> str | None:
        return store and f"{store}/{name}"

    families = [
        ("not_null", ("not_null",), failing_not_null, F.count(F.lit(1))),
        ("values", ("unique", "accepted_values"), failing_values, F.count(F.lit(1))),
        ("orphans", ("relationships",), failing_orphans, F.sum("n_rows")),
    ]
    parts = []
    for name, kinds, build, count in families:
        own = [c for c in suite if c.kind in kinds and not c.alone]
        if own:
            parts.append(_family(df, own, build, count, folder(name)))
    parts += [_alone(df, c, folder(f"alone/{c.label}")) for c in suite if c.alone]
    if not parts:
        raise ValueError("a suite needs a check")
    rows = reduce(DataFrame.unionByName, parts)

    def of_check(cell) -> Column:
        """``cell(check)`` of the row's own check."""
        return reduce(lambda rest, c: F.when(F.col("check") == c.label, cell(c)).otherwise(rest), suite, F.lit(None))

    limit = of_check(lambda c: F.lit(c.limit).cast("bigint"))
    cut = [c.label for c in suite if c.limit is not None and c.counted]
    rows = rows.withColumn("limited", F.coalesce(F.col("n") > limit, F.lit(False)))
    rows = rows.withColumn("failures", F.when(F.col("check").isin(cut), F.least("failures", limit)).otherwise(F.col("failures")))
    return rows.select(
        F.lit(model).alias("model"),
        F.col("check").alias("check_name"),
        of_check(lambda c: F.lit(c.kind)).alias("kind"),
        of_check(lambda c: F.lit(c.column)).alias("column_name"),
        "failures",
        "limited",
        of_check(lambda c: F.expr(f"failures {c.warn_if}")).alias("should_warn"),
        of_check(lambda c: F.expr(f"failures {c.error_if}")).alias("should_error"),
    )
