"""Spelling variants: near words by blocked Gram matrices of letter counts.

1. Words are the maximal letter runs of all texts, A-Z lower-cased. A fixed share of the runs of a document, chosen
   by the CRC-32 of document and run, loses one letter (``Spelling.every``). Tasks count words before they are moved;
   words shorter than ``least_length`` cannot be in the result and are not moved.
2. Words one edit apart have letter counts at a squared distance of 1 (inserted or deleted) or 2 (replaced), so they
   differ in the counts of at most two letters. The alphabet is dealt into ``GROUPS`` groups of about equal
   frequency, of which at most two hold those letters: near words have equal counts in all but two of the groups.
   Each choice of groups but two makes a block of the words with the same counts there.
3. A block of more than ``TILE`` words is cut into slots by hash, and each pair of slots is one tile, so that no task
   has to hold a block; the number of tasks follows the number of products. Inside a tile words are ordered by
   length, and NumPy products of the count matrix of some rows with those up to the next length give all squared
   distances; pairs at most two apart are verified letter by letter. A pair is reported in the first block it shares.
4. A word's form is its most frequent near word if that is ``ratio`` times as frequent; as counts grow by that ratio
   with every step, roots take a bounded number of doubling joins.

NULL and empty texts have no words. A NULL id counts as the empty text. Rows that repeat an id count each. Ties between
near words go to the smallest in code-point order. Long texts and long words are taken whole; counts are exact in
doubles. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import slices, stored

GROUPS = 5
CHOICES = tuple(combinations(range(GROUPS), GROUPS - 2))
# Words of a slot, of which a tile holds two, rows of one product, and squared distances for one task.
TILE = 2048
PRODUCT_ROWS = 256
TASK_PRODUCTS = 50_000_000
# Words of small tiles that are taken together.
GATHERED = 192
# Places of a word laid out for the comparison of letters, and pairs compared at once.
LAID_OUT = 48
PAIRS_AT_ONCE = 20_000
# Distinct words that a task counts before it passes them on.
HELD = 200_000
LETTERS = "A-Za-zÀ-ÿ"


@dataclass(frozen=True)
class Spelling:
    """Which runs lose a letter, which words count, and how much more frequent a form is than its variant."""

    every: int = 199
    least_length: int = 6
    least_count: int = 5
    ratio: int = 5


def word_counts(name: bytes, text: str, rule: Spelling) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text; ``text`` has no capitals A-Z."""
    # A greedy run cannot begin inside a longer one, so shorter runs are passed over whole.
    begun = crc32(name + b":")
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{rule.least_length},}}", text)).items():
        h = crc32(run.encode(), begun)
        if h % rule.every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < rule.least_length:
                continue
        yield run, n


def _count(rule: Spelling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for text, name in zip(batch.column("text"), batch.column("name").to_pylist(), strict=True):
                    if body := text.as_py():
                        for word, n in word_counts(name, body.lower().decode(), rule):
                            held[word] += n
                    if len(held) >= HELD:
                        yield out()
        yield out()

    return run


def vocabulary(docs: DataFrame, rule: Spelling, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    named = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("name"),
        F.col(text_col).cast("binary").alias("text"),
    )
    counted = named.mapInArrow(_count(rule), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= rule.least_count), "words")


def letter_groups(words: DataFrame) -> dict[str, int]:
    """Group of each letter that occurs: by falling frequency, each to the group that has least so far.

    One row for each letter of the alphabet reaches the driver.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    load, group = [0] * GROUPS, {}
    for n, letter in sorted(((r["count"], r["letter"]) for r in letters.groupBy("letter").count().collect()), reverse=True):
        group[letter] = load.index(min(load))
        load[group[letter]] += n
    return group


def _keys(group: dict[str, int]):
    """mapInArrow function: word, n -> one row per choice of groups with the letters it has there, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            held = [[[] for _ in range(GROUPS)] for _ in words]
            for parts, word in zip(held, words, strict=True):
                for letter in sorted(word):
                    parts[group[letter]].append(letter)
            held = [["".join(part) for part in parts] for parts in held]
            for number, choice in enumerate(CHOICES):
                block = [f"{number}/" + "/".join([parts[g] for g in choice]) for parts in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.string()), batch.column("word"), batch.column("n")], names=["block", "word", "n"]
                )

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``; ``b`` is not the shorter one."""
    at = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        at += 1
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a != b and a[at + 1 :] == b[at + 1 :]


class Tile:
    """Words that are compared: their letters as columns, counted and laid out one per place.

    Small tiles are taken together: ``owner`` tells the words of one from those of another.
    """

    def __init__(self, words: list[str], sides: list[int], column: dict[str, int], owner: list[int] | None = None):
        n, width = len(words), len(column)
        self.words, self.sides = words, np.array(sides)
        self.owner = None if owner is None else np.array(owner)
        self.lengths = np.array([len(w) for w in words])
        letters = np.array([column[c] for w in words for c in w], dtype=np.int64)
        word = np.repeat(np.arange(n), self.lengths)
        self.counts = np.bincount(word * width + letters, minlength=n * width).reshape(n, width)
        # Letters by place, and a place more, up to a bound; longer words are compared as text.
        within = np.arange(len(letters)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        inside = within < LAID_OUT
        self.laid = np.full((n, min(int(self.lengths.max()), LAID_OUT) + 1), -1, dtype=np.int16)
        self.laid[word[inside], within[inside]] = letters[inside]

    def near_by_counts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (a, b) of words of adjacent lengths whose counts are at most two apart, b not the shorter one.

        Words of side 1 are compared with those of side 0 only; when all are of side 0, each with all others.
        """
        lengths = self.lengths
        # Letters that all words have equally often add nothing to a distance.
        counts = self.counts[:, (self.counts != self.counts[0]).any(axis=0)].astype(np.float64)
        squares = np.einsum("ij,ij->i", counts, counts)
        order = np.argsort(lengths, kind="stable")
        same = not self.sides.any()
        first, second = (order, order) if same else (order[self.sides[order] == 0], order[self.sides[order] == 1])
        reached = lengths[second]
        for start in range(0, len(first), PRODUCT_ROWS):
            some = first[start : start + PRODUCT_ROWS]
            low = start if same else int(np.searchsorted(reached, lengths[some[0]] - 1, side="left"))
            others = second[low : int(np.searchsorted(reached, lengths[some[-1]] + 1, side="right"))]
            apart = squares[some][:, None] + squares[others] - 2.0 * (counts[some] @ counts[others].T)
            i, j = np.nonzero(apart <= 2.0)
            a, b = some[i], others[j]
            keep = np.abs(lengths[a] - lengths[b]) <= 1
            if same:
                keep &= j > i
            if self.owner is not None:
                keep &= self.owner[a] == self.owner[b]
            a, b = a[keep], b[keep]
            swap = lengths[a] > lengths[b]
            yield np.where(swap, b, a), np.where(swap, a, b)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``one_edit`` of each pair of places: equal letters before the edit and behind it make up the shorter word."""
        found = np.zeros(len(a), dtype=bool)
        for start in range(0, len(a), PAIRS_AT_ONCE):
            x, y = a[start : start + PAIRS_AT_ONCE], b[start : start + PAIRS_AT_ONCE]
            shorter = self.lengths[x]
            longer = (self.lengths[y] - shorter).astype(bool)
            one, two = self.laid[x, :-1], self.laid[y]
            beyond = np.arange(one.shape[1]) >= shorter[:, None]
            level = (one == two[:, :-1]) & ~beyond
            before = np.logical_and.accumulate(level, axis=1).sum(axis=1)
            moved = np.where(longer[:, None], one == two[:, 1:], level) | beyond
            behind = np.logical_and.accumulate(moved[:, ::-1], axis=1).sum(axis=1) - beyond.sum(axis=1)
            found[start : start + PAIRS_AT_ONCE] = np.where(longer, before + behind >= shorter, before + behind == shorter - 1)
        for i in np.flatnonzero(self.lengths[b] > LAID_OUT).tolist():
            found[i] = one_edit(self.words[a[i]], self.words[b[i]])
        return found

    def first_choice(self, a: np.ndarray, b: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Number of the first choice of groups in which the words of each pair have the same letters."""
        odd = (self.counts[a] != self.counts[b]) @ groups > 0
        holds = np.stack([~odd[:, list(choice)].any(axis=1) for choice in CHOICES], axis=1)
        return holds.argmax(axis=1)


def _near(group: dict[str, int]):
    """mapInArrow function over rows sorted by tile: the verified pairs of each tile."""
    column = {letter: i for i, letter in enumerate(group)}
    groups = np.zeros((len(group), GROUPS), dtype=np.int64)
    groups[np.arange(len(group)), list(group.values())] = 1

    def pairs(names: list[str], owner: list[int], words: list[str], counts: list[int], sides: list[int]) -> list[tuple]:
        """Verified pairs of the tiles called ``names``; ``owner`` is each word's tile."""
        numbers = np.array([int(name.split("/", 1)[0]) for name in names])
        tile, found = Tile(words, sides, column, owner), []
        for a, b in tile.near_by_counts():
            near = tile.one_edit(a, b)
            a, b = a[near], b[near]
            own = tile.first_choice(a, b, groups) == numbers[tile.owner[a]]
            found += [(words[i], counts[i], words[j], counts[j]) for i, j in zip(a[own].tolist(), b[own].tolist(), strict=True)]
        return found

    def out(found: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
        a, n_a, b, n_b = zip(*found, strict=True) if found else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.string()), pa.array(n_a, pa.int64()), pa.array(b, pa.string()), pa.array(n_b, pa.int64())],
            names=["a", "n_a", "b", "n_b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles come as runs of rows; small ones are gathered, one whose words have two sides is taken alone."""
        names: list[str] = []
        held: tuple[list, list, list, list] = ([], [], [], [])
        tile: tuple | None = None
        found: list[tuple] = []

        def settle() -> None:
            if len(held[0]) > 1:
                found.extend(pairs(names, *held))
            names.clear()
            for cells in held:
                cells.clear()

        for batch in batches:
            block, low, high, word, n, side = (batch.column(c).to_pylist() for c in ("block", "low", "high", "word", "n", "side"))
            rows = list(zip(block, low, high, strict=True))
            ends = [i for i in range(1, len(rows)) if rows[i] != rows[i - 1]]
            for start, stop in zip([0, *ends], [*ends, len(rows)], strict=True):
                if rows[start] != tile:
                    whole = tile is None or tile[1] == tile[2]
                    if len(held[0]) >= GATHERED or not whole or rows[start][1] != rows[start][2]:
                        settle()
                    tile = rows[start]
                    names.append(tile[0])
                held[0].extend([len(names) - 1] * (stop - start))
                for cells, values in zip(held[1:], (word, n, side), strict=True):
                    cells.extend(values[start:stop])
            if len(found) > 10_000:
                yield out(found)
                found.clear()
        settle()
        yield out(found)

    return run


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, n_a, b, n_b): each pair of ``words`` (word, n) one edit apart, once."""
    group = letter_groups(words)
    keyed = words.mapInArrow(_keys(group), "block string, word string, n long")
    sizes = stored(keyed.groupBy("block").agg(F.count("*").alias("members")).where("members > 1"), "blocks")
    products = sizes.agg(F.sum(F.col("members") * F.col("members")).alias("n")).first()["n"] or 0
    sizes = sizes.select(F.struct("block").alias("of"), F.ceil(F.col("members") / tile).cast("int").alias("slots"))
    held = keyed.join(sizes, F.struct("block") == F.col("of")).select("block", "word", "n", "slots")
    slot = F.pmod(F.xxhash64("word"), F.col("slots")).cast("int")
    held = held.withColumn("slot", slot).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    tiles = held.select(
        "block",
        F.least("slot", "other").alias("low"),
        F.greatest("slot", "other").alias("high"),
        "word",
        "n",
        (F.col("slot") > F.col("other")).cast("int").alias("side"),
    )
    # A hash of a tile's name spreads the tiles of a large block over all tasks.
    tiles = tiles.repartition(1 + products // TASK_PRODUCTS, "block", "low", "high").sortWithinPartitions("block", "low", "high")
    return tiles.mapInArrow(_near(group), "a string, n_a long, b string, n_b long")


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) by following ``forms`` (word, form), whose chains have at most ``steps`` links."""
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    reach = 1
    while reach < steps:
        further = ahead.select(F.struct(F.col("word").alias("root")).alias("at"), F.col("root").alias("next"))
        moved = ahead.join(further, F.struct("root") == F.col("at"), "left")
        ahead = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return ahead


def group_variants(
    docs: DataFrame, rule: Spelling = Spelling(), id_col: str = "doc_id", text_col: str = "text", tile: int = TILE
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = vocabulary(docs, rule, id_col, text_col)
    pairs = stored(near_words(words, tile), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n"))
    both = both.unionAll(pairs.select(F.col("b"), F.col("a"), F.col("n_a")))
    # The most frequent near word, the smallest of equal ones: strings are compared by bytes, as their code points are.
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    best = best.select(F.col("word").alias("of"), "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("most"))
    joined = words.join(best, F.col("word") == F.col("of"), "left")
    enough = F.col("most") >= rule.ratio * F.col("n")
    named = joined.select(
        "word",
        F.when(enough, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("most")).alias("form_n"),
    )
    named = stored(named, "variants")
    largest = named.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log(largest, rule.ratio)) + 1
    roots = _roots(named.where("form is not null"), steps).select(F.col("word").alias("of"), "root")
    found = named.join(roots, F.col("word") == F.col("of"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
