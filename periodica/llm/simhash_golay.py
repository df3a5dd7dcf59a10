"""SimHash near-duplicates by Golay-code fuzzy hashing.

1. Every text becomes a 64-bit fingerprint: bit i is 1 when it is set in over half of the XXH64 (seed 42)
   of the text's shingles. Equal fingerprints are one row from then on, so copies cost nothing more.
2. A fingerprint is cut into three segments, each read as a word of the binary Golay code [23, 12, 7].
   Every 23-bit word lies within 3 errors of one codeword (``nearest``) and within 4 of that one alone or of
   five more (``near_codewords``). Words that differ in at most one bit share a codeword: the nearest one of
   either is within 4 errors of the other.
3. Pigeonhole: with at most 3 errors either one segment has none and one of the others at most one, or each
   has one. ``SCHEMES`` lists the keys for both cases: the codeword index of one segment beside the exact bits
   of another one, or of one half of each of the others. A pair has to agree in at least one of them.
4. Fingerprints that share a key are compared inside the join, which returns links only. A key that more than
   ``few`` fingerprints share is not joined: its fingerprints are linked through points between them
   (``_points``), which takes a bounded number of rows for each fingerprint however large the group is.
5. Components of the links; a text's component is the smallest id reachable.

One fingerprint becomes some fifty keys or a thousand points, and the planner takes them all for the size of the
fingerprints' compressed files. So these joins ask for a shuffle (``by_shuffle``): no side of them is collected
by the driver to be broadcast.

NULL and empty texts have fingerprint zero and are linked like any other; texts with fewer words than a shingle
give one shingle, the whole sequence. Rows without an id have a fingerprint, no component and link nothing. Rows
that repeat an id are returned each, with the component of the smallest one. Long texts are hashed piece by piece,
none is cut. An empty table gives an empty result, other columns are ignored, and ties do not arise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import by_shuffle, slices, stored
from periodica.llm.jaccard_join import components

SHINGLE = 3
SEED = 42
ERRORS = 3
# Shingles whose bits are counted at once.
PIECE = 1 << 15
# A key of more fingerprints is linked through points between them.
FEW = 64

CODE_BITS, CHECK_BITS = 23, 11
# Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code.
GENERATOR = 0b110001110101

# (first bit, bits) of the segments, and of the halves of the last two.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALVES = {1: ((22, 11), (33, 10)), 2: ((43, 11), (54, 10))}
# (segment that is decoded, ranges of bits that have to be equal)
SCHEMES = (
    *((decoded, (SEGMENTS[exact],)) for decoded in range(3) for exact in range(3) if exact != decoded),
    *((0, (first, second)) for first in HALVES[1] for second in HALVES[2]),
)


def fingerprint(text: bytes | None, k: int = SHINGLE) -> int:
    """64-bit SimHash of one text."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(k, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, PIECE):
        piece = words[start : start + PIECE + width - 1]
        hashes = [digest(b" ".join(piece[i : i + width]), SEED) for i in range(len(piece) - width + 1)]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word; for each syndrome the errors to the nearest codewords.

    The first error of a syndrome has at most 3 bits. Where it has 3, five more errors of 4 bits lead to other
    codewords; where it has fewer, the row repeats the first.
    """
    unit = []
    value = 1
    for _ in range(CODE_BITS):
        unit.append(value)
        value <<= 1
        if value >> CHECK_BITS:
            value ^= GENERATOR

    def syndromes(bits: range) -> np.ndarray:
        table = np.zeros(1 << len(bits), dtype=np.int32)
        for place, bit in enumerate(bits):
            table[1 << place : 2 << place] = table[: 1 << place] ^ unit[bit]
        return table

    def of(error: tuple[int, ...]) -> int:
        found = 0
        for bit in error:
            found ^= unit[bit]
        return found

    errors: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for error in combinations(range(CODE_BITS), weight):
            errors[of(error)].append(sum(1 << bit for bit in error))
    near = np.array([(row * 6)[:6] if len(row) < 6 else row for row in errors], dtype=np.int32)
    return syndromes(range(12)), syndromes(range(12, CODE_BITS)), near


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices of the codewords within 4 errors, nearest first, and which of them are no repetition."""
    low, high, near = _tables()
    words = words.astype(np.int32)
    errors = near[low[words & 0xFFF] ^ high[words >> 12]]
    fresh = errors != errors[:, :1]
    fresh[:, 0] = True
    return (words[:, None] ^ errors) >> CHECK_BITS, fresh


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the fingerprint, key, whether it comes of the nearest codeword) for all keys of ``prints``."""
    places, found, firsts = [], [], []

    def bits(start: int, count: int) -> np.ndarray:
        return (prints >> np.uint64(start)) & np.uint64((1 << count) - 1)

    decoded = [near_codewords(bits(*segment)) for segment in SEGMENTS]
    first = np.zeros((len(prints), 6), dtype=bool)
    first[:, 0] = True
    for name, (segment, ranges) in enumerate(SCHEMES):
        exact = np.full(len(prints), name, dtype=np.uint64)
        for start, count in ranges:
            exact = exact << np.uint64(count) | bits(start, count)
        index, fresh = decoded[segment]
        place, at = np.nonzero(fresh)
        places.append(place)
        found.append(exact[place] << np.uint64(12) | index[place, at].astype(np.uint64))
        firsts.append(first[place, at])
    return np.concatenate(places), np.concatenate(found).view(np.int64), np.concatenate(firsts)


def points(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the fingerprint, point, whether it is 2 bits away) for the points around ``prints``.

    All points at distance 0 and 1, and those at distance 2 whose two bits lie in the same half of the 64. Of three
    differing bits two lie in one half, so fingerprints within 3 bits share a point that is at most one bit away
    from one of them; and a point that is one bit away from one fingerprint links all that have it.
    """
    one = [1 << i for i in range(64)]
    two = [1 << i | 1 << j for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
    flips = np.array([0, *one, *two], dtype=np.uint64)
    far = np.arange(len(flips)) > 64
    around = (prints[:, None] ^ flips).ravel().view(np.int64)
    return np.repeat(np.arange(len(prints)), len(flips)), around, np.tile(far, len(prints))


def _print(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = np.array([fingerprint(t.as_py(), k) for t in batch.column("text")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "print"])

    return run


def _spread(of, name: str, mark: str, rows: int):
    """mapInArrow function that lays out ``of`` (keys or points) of the fingerprints, ``rows`` of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            for start in range(0, len(prints), rows):
                some = prints[start : start + rows]
                place, found, flag = of(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(some[place].view(np.int64)), pa.array(flag)], names=[name, "print", mark]
                )

    return run


def _links_between(live: DataFrame) -> DataFrame:
    """Links (a, b) among the fingerprints that share a key; ``live`` is (key, print, nearest)."""
    left = live.where("nearest").select(F.struct("key").alias("own"), F.col("print").alias("a"))
    right = live.select(F.struct("key").alias("theirs"), F.col("print").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return left.join(by_shuffle(right), (F.col("own") == F.col("theirs")) & (apart > 0) & (apart <= ERRORS)).select("a", "b")


def _links_through_points(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of ``prints`` within 3 bits of each other, a bounded number for each."""
    around = prints.mapInArrow(_spread(points, "point", "far", 64), "point long, print long, far boolean")
    hubs = around.where("not far").groupBy("point").agg(F.min("print").alias("b"))
    hubs = hubs.select(F.struct("point").alias("at"), "b")
    met = around.join(by_shuffle(hubs), (F.struct("point") == F.col("at")) & (F.col("print") != F.col("b")))
    return met.select(F.col("print").alias("a"), "b").distinct()


def _shared_keys(prints: DataFrame) -> DataFrame:
    """(key, print, nearest, n) for the keys under which fingerprints may meet; n of them have the key."""
    keyed = prints.select("print").mapInArrow(_spread(keys, "key", "nearest", 8192), "key long, print long, nearest boolean")
    held = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("nearest").alias("any"))
    held = held.where(F.col("any") & (F.col("n") > 1)).select(F.struct("key").alias("of"), "n")
    return keyed.join(by_shuffle(held), F.struct("key") == F.col("of")).select("key", "print", "nearest", "n")


def link_prints(prints: DataFrame, few: int = FEW) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``print``) whose components are those of all links."""
    live = stored(_shared_keys(prints), "golay-keys")
    crowded = stored(live.where(F.col("n") > few).select("print").distinct(), "golay-crowds")
    return _links_between(live.where(F.col("n") <= few)).unionAll(_links_through_points(crowded))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, few: int = FEW
) -> DataFrame:
    """One row per input row: id, fingerprint (16 lower-case hex digits), component_id."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = stored(named.mapInArrow(_print(k), "id long, print long"), "prints")
    alike = rows.where("id is not null").groupBy("print").agg(F.min("id").alias("least"))
    alike = stored(alike, "distinct-prints")
    labels = components(stored(link_prints(alike, few), "print-links"))
    linked = alike.join(by_shuffle(labels), F.col("print") == F.col("id")).select("print", "least", "component")
    lowest = linked.groupBy("component").agg(F.min("least").alias("lowest")).select(F.struct("component").alias("of"), "lowest")
    linked = linked.join(lowest, F.struct("component") == F.col("of")).select(F.col("print").alias("linked"), "lowest")
    named = alike.join(linked, F.col("print") == F.col("linked"), "left")
    named = named.select(F.struct("print").alias("key"), F.coalesce("lowest", "least").alias("component"))
    found = rows.join(named, F.struct("print") == F.col("key"), "left")
    return found.select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
    )
