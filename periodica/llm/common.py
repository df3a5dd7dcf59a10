"""What the corpus operators share: frozen intermediate tables, text slices, word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.session import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# A worker forgets its word hashes when it holds this many.
HELD_WORDS = 500_000
# Text handled at once inside a task.
SLICE_BYTES = 4 << 20


def frozen(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in the cluster's shared folder: cut lineage, safe from lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_dir(spark, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read back.

    For tables that a loop makes again and again: unlike a checkpoint, what is read back carries neither
    the constraints nor the plan of what was written.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles both sides, whatever sizes the planner takes them for.

    The planner knows neither how many rows a Python function makes of one nor what compressed files hold, and
    what it broadcasts passes through the driver's memory.
    """
    return df.hint("merge")


def lowered(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged; NULL becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices with about ``limit`` bytes of ``column`` each; a longer single row stays whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(texts: list[bytes | None], known: WordHashes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, one after another, and the number of words of each text.

    Words are what ASCII blanks separate: ``bytes.split`` cuts at x09-x0D and x20 and nowhere else.
    """
    lists = [(t.lower() if lower else t).split() if t else [] for t in texts]
    counts = np.array([len(w) for w in lists], dtype=np.int64)
    total = int(counts.sum())
    return np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), np.uint64, total), counts


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers from the upper half of 64-bit hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def text_buckets(docs: DataFrame, text: str, chars: int = 16_000_000) -> int:
    """A number of buckets that grows with the text: one per ``chars`` characters."""
    total = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    return int(total // chars) + 1


def runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, stop) of each run of equal values in a sorted array."""
    used, begin = np.unique(values, return_index=True)
    stops = [*begin[1:].tolist(), len(values)]
    return list(zip(used.tolist(), begin.tolist(), stops[: len(used)], strict=True))
