"""Exact duplicates through an extendible-hash index on shared files. DataFrame operations only.

1. Every text gives an index entry: the 64-bit hash of its normalised form. Entries of one hash are
   added up before they are moved, so a text that fills a third of the table is one entry.
2. The directory starts as one bucket and doubles while a bucket holds more than ``capacity``
   entries. It is computed from a histogram of hash prefixes (at most ``2 ** MAX_DEPTH`` numbers,
   whatever the input), and tells each prefix its bucket.
3. Entries are written to the shared folder in files by bucket and owner tasks read key ranges.
4. Only hashes that occur more than once can be duplicates. Their rows form chains, in which the
   texts themselves are compared byte by byte; different texts of one hash stay apart.

NULL counts as the empty text. Of equal texts the row with the largest id stays; a NULL id is
smaller than all others, and rows repeated with their id are all marked as the one that stays. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import lowered
from periodica.session import work_dir

MAX_DEPTH = 16
# Repeated hashes up to this number (8 bytes each) go to every task; more are joined by a shuffle.
SMALL_KEYS = 1_000_000


def directory(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """(prefix, bucket, depth) for each seen prefix of MAX_DEPTH bits, by splitting overfull buckets.

    A bucket of local depth d covers all prefixes with the same first d bits. It is split by its next
    bit while it holds more than ``capacity`` entries, down to single prefixes.
    """
    settled = []
    open_buckets = [(0, 0, sorted(histogram))]
    while open_buckets:
        bits, depth, prefixes = open_buckets.pop()
        if depth == MAX_DEPTH or sum(histogram[p] for p in prefixes) <= capacity:
            bucket = bits << (MAX_DEPTH - depth)
            settled += [(p, bucket, depth) for p in prefixes]
            continue
        step = MAX_DEPTH - depth - 1
        for bit in (0, 1):
            inside = [p for p in prefixes if (p >> step) & 1 == bit]
            if inside:
                open_buckets.append((bits << 1 | bit, depth + 1, inside))
    return sorted(settled)


def build_index(keyed: DataFrame, capacity: int) -> DataFrame:
    """Distinct hashes with their number of rows, written by bucket and read back from the files."""
    spark = keyed.sparkSession
    folder = work_dir(spark, "exact-index")
    entries = keyed.groupBy("h").agg(F.count("*").alias("n"))
    entries.write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")
    prefix = F.shiftrightunsigned("h", 64 - MAX_DEPTH).cast("int")
    counts = entries.groupBy(prefix.alias("prefix")).count().toArrow().to_pydict()
    rows = directory(dict(zip(counts["prefix"], counts["count"], strict=True)), capacity)
    owners = spark.createDataFrame(rows, "prefix int, bucket int, depth int")
    # At most 2 ** MAX_DEPTH rows of three numbers, under 1 MB.
    placed = entries.withColumn("prefix", prefix).join(F.broadcast(owners), "prefix").drop("prefix")
    buckets = max(1, len({r[1] for r in rows}))
    ranged = placed.repartitionByRange(buckets, "bucket", "h").sortWithinPartitions("bucket", "h")
    ranged.write.parquet(f"{folder}/buckets")
    return spark.read.parquet(f"{folder}/buckets")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 65_536, small_keys: int = SMALL_KEYS
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    text = lowered(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    index = build_index(keyed.select("h"), capacity)
    chained = index.where("n > 1").select(F.col("h").alias("chain"))
    if chained.count() <= small_keys:
        chained = F.broadcast(chained)
    inside = keyed.join(chained, F.col("h") == F.col("chain"), "left_semi")
    groups = inside.groupBy("h", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    # The key as a struct makes the join shuffle both sides itself, so that a hot text can be split.
    key = F.struct("h", "text")
    groups = groups.select(key.alias("same"), "keep_id", "group_size")
    members = inside.join(groups, key == F.col("same"))
    lone = keyed.join(chained, F.col("h") == F.col("chain"), "left_anti")
    lone = lone.select("id", "text", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    rows = lone.unionByName(members.select("id", "text", "keep_id", "group_size"))
    return rows.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.sha2("text", 256).alias("text_sha256"),
    )
