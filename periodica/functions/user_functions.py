"""Wrappers that turn user code into SQL-callable functions.

Python code runs on Arrow batches. Aggregates follow the accumulate / merge / finish contract, so
a group is never gathered whole: partial states are built where the rows lie and merged in two
steps, the first of them salted.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from periodica.functions.scalars import all_of

MAX_HELD_GROUPS = 50_000
ROWS_PER_FOLD = 250_000
ROWS_PER_PIECE = 100_000


def sql_scalar(
    spark: SparkSession,
    name: str,
    args: Sequence[tuple[str, str, str | None]],
    returns: str,
    body: str,
) -> None:
    """Register a SQL function; ``args`` are (name, type, default or None)."""
    signature = ", ".join(
        f"{arg} {kind}" + (f" DEFAULT {default}" if default is not None else "")
        for arg, kind, default in args
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}"
    )


def python_scalar(fn: Callable[..., pd.Series], returns: str, volatile: bool = False):
    """Vectorised Python function over Series; volatile ones are not reordered or repeated."""

    def run(*columns: pd.Series) -> pd.Series:
        return fn(*columns)

    udf = F.pandas_udf(run, returnType=returns)
    return udf.asNondeterministic() if volatile else udf


def python_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    inputs: Sequence[str],
    handler: type,
    output: str,
    returns: T.DataType,
    salts: int = 32,
) -> DataFrame:
    """Aggregate with a Python handler class.

    The handler offers ``accumulate(*vectors)`` over numpy arrays, ``merge(state)``, a picklable ``state`` and
    ``finish()``. Rows are folded into partial states inside each task, then states are merged
    per (key, salt) and last per key; only states are shuffled, so one key holding most of the
    rows costs no more than any other. Without keys all rows are one group.

    Keys are compared and returned as typed Arrow values: no integer is rounded beside a NULL, and NULL
    and NaN are two keys. They have to be of atomic types. Integer inputs that hold NULLs reach the
    handler as floats, NULL as NaN.
    """
    if not keys:
        whole = df.select(F.lit(1).alias("_whole"), *inputs)
        return python_aggregate(whole, ["_whole"], inputs, handler, output, returns, salts).drop("_whole")
    keys = list(keys)
    inputs = list(inputs)
    key_fields = [df.schema[k] for k in keys]
    for field in key_fields:
        if isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            raise TypeError(f"key {field.name} is not of an atomic type")
    state_schema = T.StructType(
        [*key_fields, T.StructField("_salt", T.IntegerType()), T.StructField("_state", T.BinaryType())]
    )
    held_limit, fold_rows = MAX_HELD_GROUPS, ROWS_PER_FOLD

    def emit(held: dict[tuple, Any], salt: int, schema: pa.Schema) -> pa.RecordBatch:
        names = [
            pa.array([_value(key[i]) for key in held], schema.field(k).type, from_pandas=False) for i, k in enumerate(keys)
        ]
        states = pa.array([pickle.dumps(h.state) for h in held.values()], pa.binary())
        return pa.RecordBatch.from_arrays([*names, pa.array([salt] * len(held), pa.int32()), states], [*keys, "_salt", "_state"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= fold_rows:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting = []
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        salt = (context.partitionId() if context else 0) % salts
        held: dict[tuple, Any] = {}
        for table in gather(batches):
            if not len(table):
                continue
            groups = _codes([table.column(k) for k in keys])
            by_group = np.argsort(groups, kind="stable")
            starts = np.flatnonzero(np.diff(groups[by_group], prepend=-1))
            firsts = table.select(keys).take(pa.array(by_group[starts]))
            names = zip(*[map(_named, firsts.column(k).to_pylist()) for k in keys])
            pieces = zip(*[np.split(table.column(c).to_numpy()[by_group], starts[1:]) for c in inputs])
            for key, vectors in zip(names, pieces):
                if key not in held:
                    held[key] = handler()
                held[key].accumulate(*vectors)
            if len(held) > held_limit:
                yield emit(held, salt, table.schema)
                held = {}
        if held:
            yield emit(held, salt, table.schema)

    def merge_runs(group: Sequence[str], last: bool) -> Callable:
        """States of one group lie next to each other; a group is held as one merged state."""
        made = to_arrow_type(returns) if last else pa.binary()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, total, schema = None, None, None

            def result() -> tuple:
                return (*map(_value, current), total.finish() if last else pickle.dumps(total.state))

            def frame(rows: list[tuple]) -> pa.RecordBatch:
                kinds = [*(schema.field(g).type for g in group), made]
                arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)]
                return pa.RecordBatch.from_arrays(arrays, [*group, output if last else "_state"])

            for batch in batches:
                schema = batch.schema
                rows = []
                names = zip(*[map(_named, batch.column(g).to_pylist()) for g in group])
                for name, state in zip(names, batch.column("_state").to_pylist()):
                    if total is None or name != current:
                        if total is not None:
                            rows.append(result())
                        current, total = name, handler()
                    total.merge(pickle.loads(state))
                if rows:
                    yield frame(rows)
            if total is not None:
                yield frame([result()])

        return run

    final_schema = T.StructType([*key_fields, T.StructField(output, returns)])
    partial = df.select(*[_one_zero(f).alias(f.name) for f in key_fields], *inputs).mapInArrow(fold, state_schema)
    salted = _runs(partial, [*keys, "_salt"]).mapInArrow(merge_runs([*keys, "_salt"], False), state_schema)
    return _runs(salted, keys).mapInArrow(merge_runs(keys, True), final_schema)


NAN = ("nan",)


def _named(value: Any) -> Any:
    """A key that equals itself, also where NaN does not."""
    return NAN if isinstance(value, float) and value != value else value


def _value(name: Any) -> Any:
    return float("nan") if name is NAN or name == NAN else name


def _one_zero(field: T.StructField) -> Column:
    """The column with -0.0 as 0.0, which are one key."""
    zero = F.lit(0).cast(field.dataType)
    return F.col(field.name) + zero if isinstance(field.dataType, T.FloatType | T.DoubleType) else F.col(field.name)


def _codes(columns: Sequence[pa.ChunkedArray]) -> np.ndarray:
    """Number of each row's group by all columns; NULL is a value."""
    codes = None
    for column in columns:
        coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        own = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if codes is None:
            codes = own
        else:
            codes = np.unique(codes * len(coded.dictionary) + own, return_inverse=True)[1]
    return codes


def sql_aggregate(spark: SparkSession, name: str, handler: type, returns: T.DataType) -> None:
    """Make a handler class callable in SQL, as two aggregate functions over Arrow arrays.

    ``<name>_state(inputs...)`` gives the state of the rows of a group, ``<name>(state)`` the result of
    its states. Spark hands such a function its whole group, so large groups are cut by ``in_pieces`` and
    their states are put together::

        in_pieces(t, ["k"]).createOrReplaceTempView("pieces")

        SELECT k, spread(state) AS spread
        FROM (SELECT k, spread_state(v) AS state FROM pieces GROUP BY k, piece)
        GROUP BY k

    A call costs Spark about half a millisecond beside its rows, so small groups are best left whole.
    Keys stay inside Spark, so they keep their types and values. Inputs arrive as in ``python_aggregate``.
    """

    def state_of(*columns: pa.Array) -> Any:
        held = handler()
        held.accumulate(*[c.to_numpy(zero_copy_only=False) for c in columns])
        return pickle.dumps(held.state)

    def merged(states: pa.Array) -> Any:
        held = handler()
        for state in states.to_pylist():
            held.merge(pickle.loads(state))
        return held.finish()

    spark.udf.register(f"{name}_state", F.arrow_udf(state_of, T.BinaryType()))
    spark.udf.register(name, F.arrow_udf(merged, returns))


def in_pieces(df: DataFrame, keys: Sequence[str], rows: int = ROWS_PER_PIECE, piece: str = "piece") -> DataFrame:
    """``df`` with a number that cuts each group of more than ``rows`` rows into pieces of about that many.

    All other groups are one piece, 0: there are no more pieces than groups and one per ``rows`` rows. NULL is a
    key like others. Groups are counted first; only the large ones, at most one per ``rows`` rows, meet the rows.
    """
    of = [f"_of_{k}" for k in keys]
    counted = df.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, of)]).agg(F.count("*").alias("_n"))
    large = counted.where(F.col("_n") > rows).withColumn("_pieces", F.ceil(F.col("_n") / rows))
    # The row's number is taken where the row is read, so a repeated task gives the same piece.
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    met = numbered.join(large, all_of(*[F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, of)]), "left")
    number = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_pieces")), F.lit(0))
    return met.select(*df.columns, number.alias(piece))


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key together.

    Python work is not visible in the row sizes that adaptive coalescing goes by; a set number of
    partitions keeps it spread over all cores.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys)


def _runs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one key together and in a row."""
    return _spread(df, keys).sortWithinPartitions(*keys)


def grouped_apply(
    df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema
) -> DataFrame:
    """Arbitrary pandas function per group, the extension point for what windows cannot say.

    Each group is one pandas frame, so callers pass data whose groups are bounded by design (a
    monthly series has one row per calendar month), reduced beforehand. Rows arrive sorted by key
    in batches that hold many groups, which spares the round trip a grouped map makes per group. Spark
    marks where a group begins, so keys are told apart by their typed values, NULL and NaN too.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            starts = np.flatnonzero(batch.pop("_first").to_numpy())
            results = []
            if len(batch) and (not len(starts) or starts[0]):
                waiting.append(batch.iloc[: starts[0] if len(starts) else None])
            for first, stop in zip(starts, [*starts[1:], len(batch)]):
                if waiting:
                    results.append(fn(_joined(waiting)))
                waiting = [batch.iloc[first:stop]]
            if results:
                yield pd.concat(results, ignore_index=True)
        if waiting:
            yield fn(_joined(waiting))

    def _joined(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)

    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))) == 1
    return _spread(df, keys).withColumn("_first", first).mapInPandas(run, schema)
