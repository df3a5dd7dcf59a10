"""Length-bucketed packing: optimal bucket boundaries, then token-budget batches inside a bucket.

The boundaries minimise the padding of the whole table: dynamic programming over the global
histogram of lengths, every row of a bucket being padded to the bucket's boundary. The histogram is
bounded: lengths keep their ``KEPT_BITS`` leading bits (rounded up), so lengths up to
``2 ** KEPT_BITS`` are exact and there are a few thousand distinct values per further doubling.

Batches hold ``budget // boundary`` rows (at least one). A bucket is cut into shards by a hash of
the id, each with about ``shard_rows`` rows, so that no task numbers an unbounded bucket; each
shard ends with at most one batch that is not full.

NULL and empty texts have length 0 and go to the shortest bucket. Rows of equal id and length keep
an arbitrary order among themselves. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEPT_BITS = 13


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` lengths, the last one the largest, with the least total padding.

    ``best[j]`` is the padded size of all rows up to length j with the buckets used so far. The cost
    of a bucket satisfies the quadrangle inequality, so the best cut moves right with j and each
    layer is solved by halving. Of equal cuts the leftmost is taken.
    """
    if not lengths:
        return []
    order = np.argsort(lengths)
    size = np.asarray(lengths, dtype=np.int64)[order]
    below = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64)[order])])
    n = len(size)
    best = size * below[1:]
    cuts = []
    for _ in range(min(buckets, n) - 1):
        nxt, cut = best.copy(), np.full(n, -1)
        spans = [(1, n - 1, 0, n - 2)]
        while spans:
            low, high, first, last = spans.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + size[j] * (below[j + 1] - below[i + 1])
            k = int(np.argmin(cost))
            if cost[k] < nxt[j]:
                nxt[j], cut[j] = cost[k], i[k]
            spans += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        cuts.append(cut)
        best = nxt
    ends, j = [n - 1], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = int(cut[j])
            ends.append(j)
    return [int(size[e]) for e in sorted(set(ends))]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(t.split()) if t else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64())], names=["id", "n_tokens"])


def rounded_up(length: Column) -> Column:
    """``length`` with its KEPT_BITS leading bits, rounded up."""
    bits = F.length(F.bin(length))
    step = F.pow(F.lit(2), F.greatest(bits - KEPT_BITS, F.lit(0))).cast("long")
    return (F.ceil(length / step) * step).cast("long")


def shard_hash(id_: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit(""))), 1, 7), 16, 10).cast("long")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 16,
    budget: int = 65_536,
    shard_rows: int = 5_000,
) -> DataFrame:
    """Per row: id, n_tokens, bucket, pad_to, shard, batch, slot, padding; the batch is numbered in its shard."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    sized = texts.mapInArrow(_count_words, f"id {kind}, n_tokens long").withColumn("length", rounded_up(F.col("n_tokens")))
    found = sized.groupBy("length").count().toArrow().to_pydict()
    ends = optimal_boundaries(found["length"], found["count"], buckets)
    held = [0] * len(ends)
    for length, n in zip(found["length"], found["count"], strict=True):
        held[int(np.searchsorted(ends, length))] += n
    rows = [(i, e, -(-n // shard_rows), max(1, budget // max(1, e))) for i, (e, n) in enumerate(zip(ends, held, strict=True))]
    plan = spark.createDataFrame(rows, "bucket int, pad_to long, shards long, per_batch long")
    bucket = F.lit(0)
    for end in ends[:-1]:
        bucket = bucket + (F.col("length") > end).cast("int")
    placed = sized.withColumn("bucket", bucket).join(F.broadcast(plan), "bucket")
    placed = placed.withColumn("shard", F.pmod(shard_hash(F.col("id")), F.col("shards")).cast("int"))
    turn = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", "id")) - 1
    return placed.withColumn("turn", turn).select(
        F.col("id").alias(id_col),
        "n_tokens",
        "bucket",
        "pad_to",
        "shard",
        F.floor(F.col("turn") / F.col("per_batch")).cast("long").alias("batch"),
        F.pmod(F.col("turn"), F.col("per_batch")).cast("long").alias("slot"),
        (F.col("pad_to") - F.col("n_tokens")).alias("padding"),
    )
