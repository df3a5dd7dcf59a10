"""Exact n-gram Jaccard join by PartEnum signatures, reduced to its connected components.

A text's set holds its distinct word ``SHINGLE``-grams. Two sets A and B link when
``|A & B| * of >= at_least * |A | B|``, that is when at most ``(|A| + |B|) * (of - at_least) / (of +
at_least)`` shingles lie in one of them only.

1. Equal sets are put together first, by 128 bits and their size; one member stands for all.
2. Signatures. Sizes fall into bands, each ``BAND`` times as wide as the last. Inside a band at most k
   shingles differ. The shingle domain is cut into so many groups of three parts that at least
   ``1 + SPARE`` times two parts of one group are equal in two linked sets: a first difference inside a
   group costs it two of its three pairs of parts, a second one the third. The content of each two
   parts of a group is a signature. A set near the upper end of its band also signs for the next one.
   Two empty parts say nothing: they are only signed by sets with more than ``SPARE`` such pairs, which
   linked sets with nothing but empty parts in common both are. So every linked pair shares a
   signature, and most have to share more: as many as their sizes let differ.
3. Rare ones first. A set that has to share ``need`` signatures of a band with another one still shares
   ``KEPT`` of them (or all it needs) when its ``need - KEPT`` most frequent ones are left out, and is
   linked with nothing when it shares fewer than ``need`` with any set. So passages that very many texts
   hold do not bring these together.
4. Links. Sets that share a signature are verified against one hub, the one met most often. Only sets
   that are then still in different components are compared further. Where ``FEW_PAIRS`` pairs a set
   or fewer are left under a signature, they are compared at once; pairs that share fewer signatures
   than they need are no links and are not verified.
5. Finer signatures. Sets that share a more frequent signature are compared with its hub, which gives
   the shingles in one of the two only. Sets that differ from the hub by a and b shingles and link have
   more than (a + b - most) / 2 of these in common. As one of them at least is not linked to
   the hub, that is about half of the other's or more, so that linked sets share one of their rarest differences: a prefix filter over
   differences. Hub and difference together are the signatures of the next round, with a hub of their
   own, until no pair is left. Members of a large group that are alike without being linked thus
   meet over what few of them have instead of what all of them have. If a round leaves over half of
   the pairs open, the rest is compared at once. So a pair that shares a signature ends up refuted,
   verified or inside one component, and components are exact.
6. Components by least labels and pointer jumping, in rounds over stored tables.

NULL and empty texts have empty sets and link with nothing. Rows repeated with their id share a
component; a row with a NULL id has a NULL component. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import WordHashes, bucket_of, by_shuffle, mix, slices, stored, word_hashes

SHINGLE = 3
BAND = 1.5
SPARE = 2
# Signatures of a set that are kept beyond those it need not share.
KEPT = 3
# Open pairs per set of a signature that are few enough to be compared at once.
FEW_PAIRS = 4
# Differing shingles that a task hands over at once.
HELD_SHINGLES = 1 << 20
DIFFERENCES = "a long, b long, linked boolean, near long, far long, diff array<long>"
# A signature ends in its band's number; bands reach far beyond any text.
LABEL_BITS = 6
BAND_LIMIT = 1 << 33
SETS = "id long, size long, one long, two long, sig array<long>, need array<long>"
# Ids up to this number (8 bytes each) go to every task; more are joined by a shuffle.
SMALL_IDS = 1_000_000
# Links, both ways, whose ids (some 110 bytes each in a broadcast) may go to every task.
FEW_WAYS = 100_000


@dataclass(frozen=True)
class Overlap:
    """Linked when 100 * shared >= 90 * all, with the numbers given here."""

    at_least: int = 90
    of: int = 100

    def differing(self, sizes: int) -> int:
        """Most shingles in one of two linked sets only, when the sets have ``sizes`` together."""
        return sizes * (self.of - self.at_least) // (self.of + self.at_least)

    def linked(self, shared: int, sizes: int) -> bool:
        return self.of * shared >= self.at_least * (sizes - shared) and shared > 0

    def prefixes(self, apart: int, size: int, hub: int) -> tuple[int, int]:
        """How many of its ``apart`` differences from a hub of ``hub`` shingles a set has to look at.

        Sets that differ from the hub by a and b shingles and from each other by x have (a + b - x) / 2 of these
        differences in common. The first number serves for partners not linked to the hub, b > (|B| + |hub|) * r,
        the second for linked ones, when this set is not.
        """
        more, less = self.of + self.at_least, self.of - self.at_least
        common = (apart * more + (hub - size) * less) // (2 * more) + 1
        least = max(1, -(((size + hub) * less - apart * more) // (2 * more)))
        return apart - common + 1, apart - least + 1

    def groups(self, label: int) -> int:
        """Groups of three parts for the sets that sign for a band; 0 if only equal sets of it link."""
        most = self.differing(2 * (band_ends(BAND_LIMIT)[label + 1] - 1))
        return (most + 2 + SPARE) // 2 if most else 0

    def equal_pairs(self, label: int, size: int) -> int:
        """Least number of equal pairs of parts of a set with ``size`` shingles and any set linked to it."""
        groups = self.groups(label)
        other = min(size * self.of // self.at_least, band_ends(BAND_LIMIT)[label + 1] - 1)
        most = self.differing(size + other)
        return 3 * groups - 2 * min(most, groups) - max(0, most - groups)


def shingle_hashes(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-grams of one text's words; of the whole sequence when it is shorter."""
    width = min(k, len(words))
    count = len(words) - width + 1 if width else 0
    key = np.full(count, width, dtype=np.uint64)
    for j in range(width):
        key = mix(key ^ words[j : j + count], j + 1)
    return np.unique(key)


@cache
def band_ends(limit: int) -> tuple[int, ...]:
    """First sizes of the bands up to one beyond ``limit`` shingles."""
    ends = [1]
    while ends[-1] <= limit:
        ends.append(int(ends[-1] * BAND) + 1)
    return (*ends, int(ends[-1] * BAND) + 1)


def signatures(shingles: np.ndarray, rule: Overlap) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set of shingle hashes, and how many of its band's a linked set has to share."""
    size = len(shingles)
    none = np.array([], dtype=np.int64)
    if not size:
        return none, none
    ends = band_ends(BAND_LIMIT)
    band = int(np.searchsorted(ends, size, side="right")) - 1
    labels = [band]
    if size * rule.of >= rule.at_least * ends[band + 1]:
        labels.append(band + 1)
    found, needs = [none], [none]
    for label in labels:
        groups = rule.groups(label)
        if not groups:
            continue  # only equal sets link, and these are together already
        part = bucket_of(mix(shingles, 1_000 + label), 3 * groups)
        order = np.argsort(part, kind="stable")
        part = part[order]
        begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        content = np.zeros(3 * groups, dtype=np.uint64)
        filled = np.zeros(3 * groups, dtype=bool)
        content[part[begin]] = np.add.reduceat(mix(shingles[order], 2_000 + label), begin)
        filled[part[begin]] = True
        first, second = np.array([0, 0, 1]), np.array([1, 2, 2])
        content, filled = content.reshape(groups, 3), filled.reshape(groups, 3)
        place = mix(np.arange(3 * groups, dtype=np.uint64), 3_000 + label)
        name = mix(content[:, first].ravel(), 5_000) ^ content[:, second].ravel()
        name = mix(name ^ place, 4_000) << np.uint64(LABEL_BITS) | np.uint64(label)
        told = (filled[:, first] | filled[:, second]).ravel()
        empty = int(len(told) - told.sum())
        if empty <= SPARE:
            name = name[told]
        found.append(name.view(np.int64))
        needs.append(np.full(len(name), rule.equal_pairs(label, size) - min(empty, SPARE), dtype=np.int64))
    return np.concatenate(found), np.concatenate(needs)


def _describe(rule: Overlap, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for batch in slices(whole, "text"):
                words, counts = word_hashes(batch.column("text").to_pylist(), known, lower=True)
                ends = np.cumsum(counts)
                sizes, one, two, signed, needs = [], [], [], [], []
                for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
                    shingles = shingle_hashes(words[end - count : end], k)
                    sizes.append(len(shingles))
                    one.append(mix(shingles, 11).sum(dtype=np.uint64))
                    two.append(mix(shingles, 12).sum(dtype=np.uint64))
                    names, need = signatures(shingles, rule)
                    signed.append(names)
                    needs.append(need)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in signed])]), pa.int32())
                none = np.array([], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(one, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(two, dtype=np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *signed]))),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *needs]))),
                    ],
                    names=["id", "size", "one", "two", "sig", "need"],
                )

    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor()
    for whole in batches:
        for batch in slices(whole, "text"):
            small = [press.compress(t or b"") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(small, pa.binary())], names=["id", "text"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, Iterator]]:
    """Batches of (a, b, text_a, text_b), each with its rows' two shingle sets; rows come in runs of one b."""
    known, open_ = WordHashes(), zstandard.ZstdDecompressor()
    last, hub = None, None

    def shingles(data: bytes) -> np.ndarray:
        return shingle_hashes(word_hashes([open_.decompress(data)], known, lower=True)[0], k)

    def pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal last, hub
        columns = [batch.column(n).to_pylist() for n in ("b", "text_a", "text_b")]
        for b, text_a, text_b in zip(*columns, strict=True):
            if b != last:
                last, hub = b, shingles(text_b)
            yield shingles(text_a), hub

    for batch in batches:
        yield batch, pairs(batch)


def _verify(rule: Overlap, k: int):
    """(a, b, text_a, text_b) -> the linked (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pairs in _sets(batches, k):
            linked = []
            for own, hub in pairs:
                shared = len(np.intersect1d(own, hub, assume_unique=True))
                linked.append(rule.linked(shared, len(own) + len(hub)))
            kept = batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=["a", "b"])

    return run


def _differ(rule: Overlap, k: int):
    """(a, b, text_a, text_b) -> ``DIFFERENCES``: whether a links to its hub b, and the shingles only one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pairs in _sets(batches, k):
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            rows, held = [], 0
            for (a, b), (own, hub) in zip(ids, pairs, strict=True):
                diff = np.setxor1d(own, hub, assume_unique=True)
                shared = (len(own) + len(hub) - len(diff)) // 2
                linked = rule.linked(shared, len(own) + len(hub))
                near, far = rule.prefixes(len(diff), len(own), len(hub))
                rows.append((a, b, linked, near, 0 if linked else far, diff.view(np.int64)))
                held += len(diff)
                if held >= HELD_SHINGLES:
                    yield _rows(rows)
                    rows, held = [], 0
            yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked", "near", "far", "diff"])

    return run


def components(links: DataFrame, few: int = FEW_WAYS) -> DataFrame:
    """(id, component) for the ids in ``links`` (a, b): the least id reachable.

    Files of ids take up to twenty times less than the ids in the driver's memory, so the number of links tells
    whether joins may broadcast: up to ``few`` of them, each counted both ways, the planner may.
    """
    ways = stored(links.select("a", "b").unionAll(links.select(F.col("b"), F.col("a"))).distinct(), "ways")
    least = ways.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("component"))
    labels = stored(least, "labels")
    many = ways.count() > few
    while True:
        named = labels.select(F.struct("id").alias("key"), "component")
        named = by_shuffle(named) if many else named
        near = ways.join(named, F.struct(F.col("b").alias("id")) == F.col("key"))
        near = near.groupBy("a").agg(F.min("component").alias("near"))
        near = by_shuffle(near) if many else near
        lowered = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("now")
        )
        jumped = lowered.join(named, F.struct(F.col("now").alias("id")) == F.col("key")).select(
            "id", "was", F.least("now", "component").alias("component")
        )
        jumped = stored(jumped, "labels")
        labels = jumped.select("id", "component")
        if not jumped.where("was <> component").limit(1).count():
            return labels


def shared_signatures(members: DataFrame) -> DataFrame:
    """(sig, id, size, need, n) of signatures that several sets have, but for the most frequent ones of a set.

    A set's signatures are collected into one array, which its own text bounds.
    """
    signed = members.select("id", "size", F.inline(F.arrays_zip("sig", "need")))
    many = signed.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select(F.struct("sig").alias("key"), "n")
    live = signed.join(many, F.struct("sig") == F.col("key")).select("sig", "id", "size", "need", "n")
    label = F.col("sig").bitwiseAND(F.lit((1 << LABEL_BITS) - 1)).alias("label")
    own = live.groupBy("id", "size", "need", label).agg(F.array_sort(F.collect_list(F.struct("n", "sig"))).alias("own"))
    enough = F.size("own") >= F.col("need")
    rare = F.slice("own", F.lit(1), (F.size("own") - F.col("need") + F.least("need", F.lit(KEPT))).cast("int"))
    return stored(own.where(enough).select("id", "size", "need", F.inline(rare)), "shared")


def possible_pairs(met: DataFrame, rule: Overlap) -> DataFrame:
    """Distinct (a, b) of ``met`` (sig, a, size_a, need_a, b, ...) that share as many signatures as a link needs."""
    label = F.col("sig").bitwiseAND(F.lit((1 << LABEL_BITS) - 1)).alias("label")
    shared = met.groupBy("a", "b", "size_a", "size_b", "need_a", "need_b", label).agg(F.count("*").alias("n"))
    close = rule.of * F.least("size_a", "size_b") >= rule.at_least * F.greatest("size_a", "size_b")
    return shared.where(close & (F.col("n") >= F.least("need_a", "need_b", F.lit(KEPT)))).select("a", "b").distinct()


def finer_signatures(differences: DataFrame) -> DataFrame:
    """(sig, id, side) that pairs around a hub share when they are linked, not both to the hub: rare differences from it.

    Sets with side 1 (linked to the hub) are to be compared with those of side 2 (not linked) only.
    """
    each = differences.withColumn("all", F.size("diff")).withColumn("e", F.explode("diff")).drop("diff")
    many = each.groupBy("b", "e").agg(F.count("*").alias("n")).where("n > 1").select(F.struct("b", "e").alias("key"), "n")
    each = each.join(many, F.struct("b", "e") == F.col("key"))
    own = each.groupBy("a", "b", "linked", "near", "far", "all").agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("own"))
    alone = F.col("all") - F.size("own")

    def first(count: str, side: Column) -> Column:
        rarest = F.slice("own", F.lit(1), F.greatest(F.col(count) - alone, F.lit(0)).cast("int"))
        space = F.when(side > 0, F.lit(1)).otherwise(F.lit(0))
        return F.transform(rarest, lambda x: F.struct(F.xxhash64("b", x["e"], space).alias("sig"), side.alias("side")))

    near = first("near", F.when(F.col("linked"), F.lit(1)).otherwise(F.lit(0)))
    far = first("far", F.lit(2))
    return own.select(F.col("a").alias("id"), F.inline(F.concat(near, far))).select("sig", "id", "side")


def link_components(live: DataFrame, texts: DataFrame, rule: Overlap, k: int) -> DataFrame:
    """(id, component) of all ids in ``live`` (sig, id, size, need, n) that have a link; ``texts`` are compressed."""
    spark = live.sparkSession
    degree = live.groupBy("id").agg(F.sum("n").alias("degree")).select(F.struct("id").alias("key"), "degree")
    ranked = live.join(degree, F.struct("id") == F.col("key"))
    ranked = stored(ranked.select("sig", "id", F.lit(0).alias("side"), "size", "need", "degree"), "ranked")
    first = texts.select(F.struct("id").alias("of_a"), F.col("text").alias("text_a"))
    second = texts.select(F.struct("id").alias("of_b"), F.col("text").alias("text_b"))

    def with_texts(pairs: DataFrame) -> DataFrame:
        held = pairs.join(first, F.struct(F.col("a").alias("id")) == F.col("of_a")).select("a", "b", "text_a")
        return held.join(second, F.struct(F.col("b").alias("id")) == F.col("of_b")).select("a", "b", "text_a", "text_b")

    tested = links = None
    labels = spark.createDataFrame([], "id long, component long")
    before, turn = None, 0
    while True:
        now = ranked.join(labels.select(F.struct("id").alias("of"), "component"), F.struct("id") == F.col("of"), "left")
        now = now.select("sig", "id", "side", "size", "need", "degree", F.coalesce("component", "id").alias("component"))
        # Two sets of one signature are to be compared unless both have side 1, or both side 2.
        counts = now.groupBy("sig", "component").agg(F.count_if(F.col("side") < 2).alias("s"), F.count_if(F.col("side") != 1).alias("g"))
        counts = counts.groupBy("sig").agg(
            F.sum("s").alias("s"), F.sum("g").alias("g"), F.sum(F.col("s") * F.col("g")).alias("inside")
        )
        open_ = counts.withColumn("cross", F.col("s") * F.col("g") - F.col("inside")).where("cross > 0")
        few = F.col("cross") <= 2 * FEW_PAIRS * F.greatest("s", "g")
        open_ = stored(open_.select(F.struct("sig").alias("key"), "cross", few.alias("few")), "open")
        sums = open_.agg(F.sum("cross").alias("n"), F.sum(F.when(~F.col("few"), F.col("cross"))).alias("many")).first()
        if not sums["n"]:
            return labels
        here = now.join(open_, F.struct("sig") == F.col("key")).drop("key", "cross")
        here = stored(here, "here")
        last = turn > 1 and 2 * sums["n"] > before
        before = sums["n"]
        own = here.select(
            "sig", "side", "few", F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("need").alias("need_a"), "component"
        )
        named = F.struct("id", "size", "need", "component")
        hubs = here.groupBy("sig").agg(F.max(F.struct("degree", "id", named.alias("other")))["other"].alias("other"))

        def beside(other: DataFrame) -> DataFrame:
            return other.select(
                F.struct("sig").alias("key"),
                F.col("other.id").alias("b"),
                F.col("other.size").alias("size_b"),
                F.col("other.need").alias("need_b"),
                F.col("other.component").alias("theirs"),
            )

        differences = None
        if not turn:
            apart = F.col("component") != F.col("theirs")
            pairs = possible_pairs(own.join(beside(hubs), (F.struct("sig") == F.col("key")) & apart), rule)
        else:
            at_once = F.lit(True) if last else F.col("few")
            if sums["many"] and not last:
                met = own.where(~at_once).join(beside(hubs), (F.struct("sig") == F.col("key")) & (F.col("a") != F.col("b")))
                around = stored(met.select("a", "b").distinct(), "around")
                differences = stored(with_texts(around).mapInArrow(_differ(rule, k), DIFFERENCES), "differences")
            other = here.where(at_once & (F.col("side") != 1)).select("sig", named.alias("other"))
            apart = (F.col("component") < F.col("theirs")) | ((F.col("side") == 1) & (F.col("component") != F.col("theirs")))
            own = own.where(at_once & (F.col("side") < 2))
            pairs = possible_pairs(own.join(beside(other), (F.struct("sig") == F.col("key")) & apart), rule)
        pairs = stored(pairs, "pairs")
        fresh = pairs
        if tested is not None:
            both = tested.unionAll(tested.select(F.col("b"), F.col("a"))).select(F.struct("a", "b").alias("key"))
            fresh = pairs.join(both, F.struct("a", "b") == F.col("key"), "left_anti")
        found = with_texts(fresh).mapInArrow(_verify(rule, k), "a long, b long")
        if differences is not None:
            found = found.unionAll(differences.where("linked").select("a", "b"))
        links = stored(found if links is None else links.unionAll(found), "links")
        tested = pairs if tested is None else tested.unionAll(pairs)
        labels = components(links)
        if turn:
            if differences is None:
                return labels
            facts = here.select(F.struct("id").alias("key"), "size", F.lit(1).cast("long").alias("need"), "degree").distinct()
            finer = finer_signatures(differences).join(facts, F.struct("id") == F.col("key"))
            ranked = stored(finer.select("sig", "id", "side", "size", "need", "degree"), "ranked")
        turn += 1


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: Overlap = Overlap(),
    k: int = SHINGLE,
    small_ids: int = SMALL_IDS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    described = stored(named.mapInArrow(_describe(rule, k), SETS), "sets")
    sets = described.select("id", F.struct("one", "two", "size").alias("set"))
    alike = stored(sets.where("set.size > 0 and id is not null").groupBy("set").agg(F.min("id").alias("rep")), "alike")
    members = described.join(alike.select(F.col("rep").alias("of")), F.col("id") == F.col("of"), "left_semi")
    live = shared_signatures(members)
    wanted = live.select("id").distinct()
    if wanted.count() <= small_ids:
        wanted = F.broadcast(wanted)
    texts = named.join(wanted, "id", "left_semi").mapInArrow(_compress, "id long, text binary")
    texts = stored(texts, "texts")
    labels = link_components(live, texts, rule, k)
    grouped = alike.join(labels, F.col("rep") == F.col("id"), "left")
    grouped = grouped.select(F.struct("set").alias("key"), F.coalesce("component", "rep").alias("component"))
    rows = sets.join(grouped, F.struct("set") == F.col("key"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.select(F.col("id").alias(id_col), F.col("set.size").alias("n_shingles"), component.alias("component_id"))
