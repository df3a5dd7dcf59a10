"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, edit verification.

An item is in a text when some stretch of the text is within ``tolerance(L)`` word edits of the
item's L words (a fifth of them; words are letters and digits in lower case).

1. Windows. A stretch that close shares at least ``L - Q + 1 - Q * tolerance`` of the item's word
   Q-grams near one offset (the q-gram lemma), so only item-sized windows at such offsets are
   looked at. This drops no match.
2. Embedding. A random walk reads a window: at step j it writes the current word and moves on by
   one random bit drawn for (word, j). Edits of the window turn into a number of differing
   places, so edit distance becomes Hamming distance (CGK).
3. LSH. Each of ``WALKS`` independent walks samples ``PLACES`` of the 3 L written places. Windows and
   items with an equal sample meet. For two strings that agree on a share s of the places
   the chance to meet is 1 - (1 - s ** PLACES) ** WALKS: 0.96 at s = 1/2, where the walk of a window
   with L / 5 edits is.
4. Verification. The exact edit distance between the item and the best stretch around the window.

The items are a fixed query set. It is split into blocks of at most ``BLOCK_WORDS`` words, whose
tables (a proven bound) go to every task; texts are read whole, in slices, and never shuffled.

Items of fewer than ``MIN_WORDS`` words are too short to be evidence and are left out. NULL and empty
texts match nothing, NULL items are ignored. Repeated rows get equal results, empty tables on either
side give an empty result, other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import mix

WORD = re.compile(r"\w+")
Q = 3
MIN_WORDS = 5
WALKS = 24
PLACES = 3
BLOCK_WORDS = 500_000
SLICE_TEXTS = 500
SLICE_WINDOWS = 4_096


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def tolerance(length: int) -> int:
    """Word edits allowed: a fifth of the words, as far as a Q-gram must be left over."""
    return min(length // 5, (length - Q) // Q)


def sampled_places(length: int) -> np.ndarray:
    """The sampled places of each walk over windows of one length."""
    rng = np.random.default_rng(length)
    return np.stack([rng.choice(3 * length, PLACES, replace=False) for _ in range(WALKS)])


def embed(windows: np.ndarray) -> np.ndarray:
    """Keys (rows, WALKS): for windows of one length, hashes of the sampled places of every walk."""
    rows, length = windows.shape
    places = sampled_places(length)
    salts = np.random.default_rng(length + 1_000_003).integers(1, 2**63, (3 * length, WALKS), dtype=np.uint64)
    padded = np.concatenate([windows, np.zeros((rows, 1), dtype=windows.dtype)], axis=1).astype(np.uint64)
    at = np.zeros((rows, WALKS), dtype=np.int64)
    keys = np.zeros((rows, WALKS), dtype=np.uint64)
    every = np.arange(rows)[:, None]
    for step in range(int(places.max()) + 1):
        word = padded[every, at]
        walks = np.flatnonzero((places == step).any(axis=1))
        if len(walks):
            keys[:, walks] = mix(keys[:, walks] ^ word[:, walks], step + 1)
        at = np.minimum(at + (mix(word ^ salts[step]) & np.uint64(1)).astype(np.int64), length)
    return keys


def edit_distance(item: list[int], region: np.ndarray) -> tuple[int, int, int]:
    """Least word edits between the item and any stretch of the region: (distance, start, end)."""
    width = len(region)
    ramp = np.arange(width + 1)
    # Distances are held less their place, so that a word the item lacks (cost 1, place 1) leaves them as they are.
    row, origin = -ramp, ramp
    new, came = np.empty_like(row), np.empty_like(origin)
    for i, word in enumerate(item, 1):
        new[0], came[0] = i, 0
        swap = row[:-1] + (region != word)
        swap -= 1
        drop = row[1:] + 1
        take = swap <= drop
        np.minimum(swap, drop, out=new[1:])
        came[1:] = np.where(take, origin[:-1], origin[1:])
        # A word of the region that the item lacks comes from the left neighbour.
        row = np.minimum.accumulate(new)
        origin = came[np.maximum.accumulate(ramp * (new == row))]
    row = row + ramp
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), end


class Items:
    """Tables of one block of items: vocabulary, Q-grams, and the walks' keys."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(i, words_of(t)) for i, t in items]
        split = [(i, w) for i, w in split if len(w) >= MIN_WORDS]
        self.vocabulary: dict[str, int] = {}
        for _, words in split:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.ids = [i for i, _ in split]
        self.words = [np.array([self.vocabulary[w] for w in words], dtype=np.int64) for _, words in split]
        grams = [(int(g), k, at) for k, w in enumerate(self.words) for at, g in enumerate(self.grams(w))]
        grams.sort()
        self.gram_keys = np.array([g[0] for g in grams], dtype=np.uint64)
        self.gram_item = np.array([g[1] for g in grams], dtype=np.int64)
        self.gram_at = np.array([g[2] for g in grams], dtype=np.int64)
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.allowed = np.array([tolerance(int(n)) for n in self.lengths], dtype=np.int64)
        self.needed = np.maximum(1, self.lengths - Q + 1 - Q * self.allowed)
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        self.tables: dict[int, dict[tuple[int, int], list[int]]] = {}
        for length in sorted(set(self.lengths.tolist())):
            same = np.flatnonzero(self.lengths == length)
            table = defaultdict(list)
            for k, keys in zip(same.tolist(), embed(np.stack([self.words[k] for k in same])).tolist(), strict=True):
                for walk, key in enumerate(keys):
                    table[walk, key].append(k)
            self.tables[length] = dict(table)

    @staticmethod
    def grams(words: np.ndarray) -> np.ndarray:
        """Hashes of the word Q-grams; 0 where a word is outside the vocabulary."""
        count = max(0, len(words) - Q + 1)
        key = np.zeros(count, dtype=np.uint64)
        known = np.ones(count, dtype=bool)
        for j in range(Q):
            part = words[j : j + count]
            key = mix(key ^ part.astype(np.uint64), j + 1)
            known &= part > 0
        return np.where(known, key | np.uint64(1), np.uint64(0))

    def windows(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, start) of item-sized windows with enough Q-grams of the item near one offset."""
        grams = self.grams(words)
        places = np.flatnonzero(grams)
        left = np.searchsorted(self.gram_keys, grams[places], side="left")
        many = np.searchsorted(self.gram_keys, grams[places], side="right") - left
        if not many.any():
            return []
        text_at = np.repeat(places, many)
        entry = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, start = self.gram_item[entry], text_at - self.gram_at[entry]
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        allowed, needed = self.allowed, self.needed
        # Hits of the same item whose offsets are within the tolerance on either side.
        span = int(start.max() - start.min()) + 2 * int(allowed.max()) + 2
        line = item * span + (start - start.min())
        near = np.searchsorted(line, line + allowed[item], side="right") - np.searchsorted(line, line - allowed[item], side="left")
        kept = near >= needed[item]
        return sorted(set(zip(item[kept].tolist(), start[kept].tolist(), strict=True)))

    def collide(self, texts: list[np.ndarray], windows: list[list[tuple[int, int]]]) -> list[set[tuple[int, int]]]:
        """Per text, (item, start) of the windows that share a walk's sample with an item."""
        found: list[set[tuple[int, int]]] = [set() for _ in texts]
        by_length = defaultdict(set)
        for number, own in enumerate(windows):
            for item, start in own:
                by_length[int(self.lengths[item])].add((number, start))
        for length, places in by_length.items():
            places = sorted(places)
            block = np.zeros((len(places), length), dtype=np.int64)
            for row, (number, start) in enumerate(places):
                # Places before or after the text hold word 0, which no item has.
                words = texts[number][max(0, start) : max(0, start + length)]
                offset = max(0, -start)
                block[row, offset : offset + len(words)] = words
            table = self.tables[length]
            for cut in range(0, len(places), SLICE_WINDOWS):
                keys = embed(block[cut : cut + SLICE_WINDOWS]).tolist()
                for (number, start), own in zip(places[cut : cut + SLICE_WINDOWS], keys, strict=True):
                    for walk, key in enumerate(own):
                        for item in table.get((walk, key), ()):
                            found[number].add((item, start))
        return found

    def common_words(self, item: int, region: np.ndarray) -> int:
        """How many of the item's words, repeats counted, the region has in any order."""
        kinds, counts = self.bags[item]
        at = np.minimum(np.searchsorted(kinds, region), len(kinds) - 1)
        return int(np.minimum(np.bincount(at[kinds[at] == region], minlength=len(kinds)), counts).sum())

    def verify(self, words: np.ndarray, item: int, start: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best stretch around a window, if it is close enough."""
        target = self.words[item]
        if 0 <= start and np.array_equal(words[start : start + len(target)], target):
            return 0, start, start + len(target)
        allowed = tolerance(len(target))
        low = max(0, start - 2 * allowed)
        region = words[low : max(low, start + len(target) + 2 * allowed)]
        # Each word of the item that the region lacks costs an edit.
        if len(target) - self.common_words(item, region) > allowed:
            return None
        distance, first, end = edit_distance(target.tolist(), region)
        return (distance, low + first, low + end) if distance <= allowed else None

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text, (item id, distance, start word, end word): the best stretch for each item."""
        numbers = []
        for text in texts:
            words = words_of(text)
            numbers.append(np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words)))
        windows = [self.windows(words) for words in numbers]
        result = []
        for words, met in zip(numbers, self.collide(numbers, windows), strict=True):
            best: dict[int, tuple[int, int, int]] = {}
            for item, start in sorted(met):
                found = self.verify(words, item, start)
                if found and (item not in best or found < best[item]):
                    best[item] = found
            result.append(sorted((self.ids[item], *found) for item, found in best.items()))
        return result


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[int, str]]]:
    """The items in blocks of at most BLOCK_WORDS words (or one item)."""
    named = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks, held = [[]], 0
    for row in named.where("id is not null and text is not null").orderBy("id", "text").toLocalIterator():
        size = len(words_of(row["text"]))
        if blocks[-1] and held + size > BLOCK_WORDS:
            blocks.append([])
            held = 0
        blocks[-1].append((row["id"], row["text"]))
        held += size
    return blocks


def _block_column(docs: DataFrame, block: list[tuple[int, str]]):
    """Function of a text column: the items of one block that are in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(Items(block))

    @F.pandas_udf("array<struct<item:bigint,distance:int,start:int,end:int>>")
    def found(texts: pd.Series) -> pd.Series:
        held, texts = [], texts.tolist()
        for cut in range(0, len(texts), SLICE_TEXTS):
            held += shared.value.matches(texts[cut : cut + SLICE_TEXTS])
        return pd.Series(held, dtype="object")

    # A filter or explode on the result would otherwise be pushed below it, and every text be matched twice.
    return found.asNondeterministic()


def matches_column(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> Column:
    """Array of (item, distance, start, end) of the items found in a text."""
    text = F.col(text_col).cast("string")
    columns = [_block_column(docs, block)(text) for block in item_blocks(benchmark, item_id, item_text)]
    return columns[0] if len(columns) == 1 else F.concat(*columns)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per text and item found in it: id, item id, edit_distance, start_word, end_word."""
    found = docs.select(F.col(id_col).alias("id"), matches_column(docs, benchmark, text_col, item_id, item_text).alias("m"))
    return found.select("id", F.explode("m").alias("m")).select(
        F.col("id").alias(id_col),
        F.col("m.item").alias(item_id),
        F.col("m.distance").alias("edit_distance"),
        F.col("m.start").alias("start_word"),
        F.col("m.end").alias("end_word"),
    )
