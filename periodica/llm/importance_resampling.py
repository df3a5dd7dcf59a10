"""Importance resampling towards a target text collection, over hashed n-grams.

1. A text's bytes go through a table of 256 bytes that lower-cases A-Z and turns every other ASCII character but
   letters and digits into a blank; ``bytes.split`` gives the words. An n-gram's CRC-32 is the CRC-32 of its first
   words carried on over one more word, so no n-gram is ever put together.
2. Each task counts hashes in a Counter, which is folded into the bucket histogram whenever it holds ``HELD``
   entries; the histograms of source and target, of ``buckets`` numbers each, are added up by Spark and give the
   gain of each bucket.
3. A text's weight is the floored mean of its features' gains, its score the weight with Gumbel noise that depends
   on the seed and the id alone.
4. The best ``percent`` of the texts with ``least_words`` words are drawn: score bands give the lowest band that is
   needed, rows from there on are sorted over all tasks and numbered by position. No row passes through one task.

NULL and empty texts have no features, weight 0 and are never drawn while ``least_words`` is positive. A NULL id
counts as the empty text in the noise and as the smallest id among ties. Rows that repeat an id are drawn each;
rows equal in all columns get consecutive ranks. Long texts are counted whole. Without rows the result is empty;
without target texts gains compare with the flat distribution. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import slices, stored

# Distinct hashes that a task counts before it adds them to its histogram.
HELD = 500_000
# Scores of one band, in which the cut is looked for.
BAND = 64

FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


@dataclass(frozen=True)
class Resampling:
    """Features are runs of 1 to ``longest`` words; ``percent`` of the texts of ``least_words`` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def feature_hashes(words: list[bytes], longest: int) -> Iterator[list[int]]:
    """CRC-32 of all runs of 1, 2, ... ``longest`` words, one list per length."""
    level = list(map(crc32, words))
    yield level
    for more in range(1, longest):
        level = [crc32(b" " + word, before) for word, before in zip(words[more:], level, strict=False)]
        yield level


def _count(rule: Resampling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histogram = np.zeros(rule.buckets, dtype=np.int64)
        held: Counter[int] = Counter()

        def fold() -> None:
            hashes = np.fromiter(held.keys(), np.int64, len(held))
            np.add.at(histogram, hashes % rule.buckets, np.fromiter(held.values(), np.int64, len(held)))
            held.clear()

        for batch in batches:
            for text in batch.column("text"):
                for level in feature_hashes(words_of(text.as_py()), rule.longest):
                    held.update(level)
                if len(held) >= HELD:
                    fold()
        fold()
        seen = np.flatnonzero(histogram)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(histogram[seen])], names=["bucket", "n"])

    return run


def histogram(texts: DataFrame, text_col: str, rule: Resampling) -> np.ndarray:
    """Features in each bucket, over all rows: at most ``rule.buckets`` numbers reach the driver."""
    named = texts.select(F.col(text_col).cast("binary").alias("text"))
    counted = named.mapInArrow(_count(rule), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(rule.buckets, dtype=np.int64)
    for bucket, n in counted.collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold logarithm of the target's smoothed share over the source's, for each bucket."""
    whole, wanted = float(source.sum() + len(source)), float(target.sum() + len(target))
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    ratios = ((t + 1.0) * whole / ((s + 1.0) * wanted) for s, t in pairs)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def noise(seed: int, name: str) -> int:
    """Gumbel noise from the first 32 bits of a SHA-256."""
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, rule: Resampling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                features, n_words, weights, scores = [], [], [], []
                for text, name in zip(batch.column("text"), batch.column("name").to_pylist(), strict=True):
                    words = words_of(text.as_py())
                    n = total = 0
                    for level in feature_hashes(words, rule.longest):
                        n += len(level)
                        total += int(gain[np.array(level, dtype=np.int64) % rule.buckets].sum())
                    features.append(n)
                    n_words.append(len(words))
                    weights.append(total // n if n else 0)
                    scores.append(weights[-1] + noise(rule.seed, name))
                columns = [pa.array(c, pa.int64()) for c in (features, n_words, weights, scores)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), *columns], names=["id", "n_features", "n_words", "weight", "score"]
                )

    return run


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """``rows`` with their position in the order of scores, NULL beyond ``drawn``."""
    order = [F.desc("score"), F.asc("id"), F.asc("n_features"), F.asc("weight")]
    placed = stored(rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "resampling-order")
    # The upper bits of a place are the number of its task, the lower 33 the position there.
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = accumulate((n for _, n in sizes), initial=0)
    starts = rows.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before, strict=False)], "of_part long, before long"
    )
    # One row for each task of the sort.
    found = placed.join(F.broadcast(starts), part == F.col("of_part"))
    rank = F.col("before") + within + 1
    return found.select(*rows.columns, F.when(rank <= drawn, rank).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    rule: Resampling = Resampling(),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, rank (NULL where not drawn)."""
    gain = gains(histogram(docs, text_col, rule), histogram(target, target_text, rule))
    named = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
        F.col(text_col).cast("binary").alias("text"),
    )
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_features long, n_words long, weight long, score long"
    scored = stored(named.mapInArrow(_score(gain, rule), schema), "resampling-scores")
    # One number for each band of scores: the range of scores bounds them, whatever the input.
    band = F.floor(F.col("score") / BAND)
    bands = scored.where(F.col("n_words") >= rule.least_words).groupBy(band.alias("band")).count().collect()
    drawn = rule.percent * sum(n for _, n in bands) // 100
    lowest, above = None, 0
    for number, n in sorted(bands, reverse=True):
        if above >= drawn:
            break
        lowest, above = number, above + n
    if lowest is None:
        ranked = scored.withColumn("rank", F.lit(None).cast("long"))
    else:
        near = (F.col("n_words") >= rule.least_words) & (band >= lowest)
        rest = scored.where(~near).withColumn("rank", F.lit(None).cast("long"))
        ranked = _ranked(scored.where(near), drawn).unionByName(rest)
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
