"""Repeated stretches of words by recompression.

A word that lies in a window of ``WINDOW`` words is removed when the same window also starts earlier:
in a text with a smaller id, or earlier in the same text. Windows are judged on the input.

1. Recompression. Words are named by hashes. Runs of one word become a symbol; then, in ``ROUNDS``
   rounds, names are split into left and right by a hash of the name, and each left symbol before a
   right one becomes a new symbol named after the pair. A name depends on the symbols alone, so it
   is the same in every task of the cluster and needs no shuffled dictionary. With each symbol goes
   its context, the words that fixed the symbol: equal windows hold the same symbols with the same
   contexts, wherever a context lies inside the window.
2. Shared symbols. The high-level symbols (named with their context) are dealt out by name, and each
   batch of texts learns which of its symbols occur elsewhere too. A window with a symbol that does
   not occur elsewhere is unlike all others. What remains are the stretches around shared
   symbols, and the few windows without an interior symbol.
3. Verification. Remaining windows are compared whole, by 96 bits of two hashes of their words. A
   batch settles its own repeats first, so a passage copied any number of times is sent once per
   batch. Bucket owners find the earliest text of each window; the others are removed.

Texts travel in compressed batches of about 4 MB, frozen in the shared folder. Buckets are as many as
the text needs, so tasks stay small at any size.

NULL and empty texts have no words. Rows with one id are neither earlier nor later than each
other; a NULL id comes after all ids. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import WordHashes, bucket_of, frozen, mix, runs, slices, text_buckets, word_hashes

WINDOW = 20
ROUNDS = 4
LAST_ID = np.iinfo(np.int64).max
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MASK = (1 << 64) - 1


def compress(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def expand(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed batches, by id inside a batch."""
    task, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        for part in slices(whole, "text"):
            table = pa.table([part.column("id"), part.column("text")], names=["id", "text"])
            table = table.sort_by([("id", "ascending")])
            columns = [pa.array([task << 32 | number], pa.int64()), pa.array([compress(table)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["batch", "data"])
            number += 1


@dataclass
class Symbols:
    """Symbols of a batch: name, first and end word, and the context that fixed them."""

    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray


def recompress(words: np.ndarray, row: np.ndarray) -> Symbols:
    """Symbols over the words of a batch; ``row`` tells the text of each word.

    The context of a run reaches one word over both ends. A pair is fixed by its two parts; a left
    symbol that stays is also fixed by its right neighbour (another left one), a right one by its
    left neighbour. Where a neighbour is missing the context leaves the text, and so every window.
    """
    n = len(words)
    head = np.ones(n, dtype=bool)
    head[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    low = np.flatnonzero(head)
    high = np.append(low[1:], n)
    size = (high - low).astype(np.uint64)
    name = np.where(size > 1, mix(words[low] ^ mix(size, 7), 1), words[low])
    left, right, of = low - 1, high + 1, row[low]
    for level in range(ROUNDS):
        is_left = (mix(name, 100 + level) & np.uint64(1)).astype(bool)
        joined = np.append(of[1:] == of[:-1], False)  # has a right neighbour in its text
        first = is_left & joined & ~np.append(is_left[1:], True)
        second = np.append(False, first[:-1])
        alone = ~first & ~second
        next_right = np.append(right[1:], 0)
        prev_left = np.append(0, left[:-1])
        has_prev = np.append(False, joined[:-1])
        wider_right = np.where(alone & is_left, np.where(joined, next_right, high + n), right)
        wider_left = np.where(alone & ~is_left, np.where(has_prev, prev_left, low - n), left)
        pair = np.flatnonzero(first)
        name = name.copy()
        name[pair] = mix(name[pair] ^ mix(name[pair + 1], 200 + level), 300 + level)
        high = high.copy()
        high[pair] = high[pair + 1]
        wider_left[pair] = np.minimum(left[pair], left[pair + 1])
        wider_right[pair] = np.maximum(right[pair], right[pair + 1])
        keep = ~second
        name, low, high, of = name[keep], low[keep], high[keep], of[keep]
        left, right = np.minimum(wider_left[keep], left[keep]), np.maximum(wider_right[keep], right[keep])
    return Symbols(name, low, high, left, right)


class Stretches:
    """Hashes of any stretch of words from running sums: sum of word * base ** place."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words) + 1
        powers = np.full(n, base, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        back = np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words, base & 0xFF) * powers[:-1], dtype=np.uint64)])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * self.back[low] ^ (high - low).astype(np.uint64))


class Batch:
    """One batch of texts: its words, and which windows start where."""

    def __init__(self, data: bytes, known: WordHashes):
        table = expand(data)
        self.ids = table.column("id").to_pylist()
        self.texts = table.column("text").to_pylist()
        self.words, self.counts = word_hashes(self.texts, known)
        self.ends = np.cumsum(self.counts)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.order = np.array([LAST_ID if i is None else i for i in self.ids], dtype=np.int64)

    def symbols(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names (with context), and contexts, of the symbols that can lie inside a window."""
        s = recompress(self.words, self.row)
        start = self.ends[self.row[s.low]] - self.counts[self.row[s.low]] if len(s.low) else s.low
        stop = self.ends[self.row[s.low]] if len(s.low) else s.low
        inside = (s.right - s.left <= WINDOW) & (s.left >= start) & (s.right <= stop)
        left, right = s.left[inside], s.right[inside]
        return Stretches(self.words, BASES[0]).of(left, right) ^ s.name[inside], left, right

    def windows(self, names: np.ndarray, left: np.ndarray, right: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows all of whose symbols are shared."""
        n = len(self.words)
        where = np.searchsorted(shared, names)
        found = shared[np.minimum(where, len(shared) - 1)] == names if len(shared) else np.zeros(len(names), bool)
        lone_left, lone_right = left[~found], right[~found]
        change = np.zeros(n + 1, dtype=np.int64)
        np.add.at(change, np.maximum(lone_right - WINDOW, 0), 1)
        np.add.at(change, lone_left + 1, -1)
        open_ = np.cumsum(change[:n]) == 0
        room = self.ends[self.row] - np.arange(n) >= WINDOW
        return np.flatnonzero(open_ & room)


def _symbol_names(buckets: int):
    """(bucket, batch, names): the distinct symbol names of each batch, dealt out by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for rows in batches:
            for number, data in zip(rows.column("batch").to_pylist(), rows.column("data").to_pylist(), strict=True):
                names = np.unique(Batch(data, known).symbols()[0])
                dealt = runs(bucket_of(names, buckets).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _, _ in dealt], pa.int32()),
                        pa.array([number] * len(dealt), pa.int64()),
                        pa.array([names[a:b].tobytes() for _, a, b in dealt], pa.binary()),
                    ],
                    names=["bucket", "batch", "names"],
                )

    return run


def _shared_names(table: pa.Table) -> pa.Table:
    """One bucket: for each batch its names that another batch has too."""
    lists = [np.frombuffer(b, np.uint64) for b in table.column("names").to_pylist()]
    names = np.sort(np.concatenate(lists))
    repeated = np.unique(names[1:][names[1:] == names[:-1]])
    kept = [x[np.isin(x, repeated, assume_unique=True)].tobytes() for x in lists]
    return pa.table([table.column("batch"), pa.array(kept, pa.binary())], names=["batch", "names"])


def _open_windows(buckets: int):
    """One batch and its shared names -> windows left to compare, by bucket, and repeats settled here."""

    def run(packed: pa.Table, shared: pa.Table) -> pa.Table:
        out = {k: [] for k in ("bucket", "batch", "first", "second", "ids", "at", "settled")}
        for number, data in zip(packed.column("batch").to_pylist(), packed.column("data").to_pylist(), strict=True):
            batch = Batch(data, WordHashes())
            names, left, right = batch.symbols()
            unique, counts = np.unique(names, return_counts=True)
            given = [np.frombuffer(b, np.uint64) for b in shared.column("names").to_pylist()]
            at = batch.windows(names, left, right, np.unique(np.concatenate([unique[counts > 1], *given])))
            first = Stretches(batch.words, BASES[0]).of(at, at + WINDOW)
            second = (Stretches(batch.words, BASES[1]).of(at, at + WINDOW) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((at, second, first))
            at, first, second = at[order], first[order], second[order]
            row = batch.row[at] if len(at) else at
            ids = batch.order[row] if len(at) else at
            head = np.ones(len(at), dtype=bool)
            head[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            leader = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0)) if len(at) else at
            again = np.zeros(len(at), dtype=bool)  # the window before is in the same text
            again[1:] = ~head[1:] & (row[1:] == row[:-1])
            settled = (ids > ids[leader]) | again
            sent = ~settled
            for k, a, b in runs(bucket_of(first[sent], buckets).astype(np.int64)):
                out["bucket"].append(k)
                out["batch"].append(number)
                out["first"].append(first[sent][a:b].tobytes())
                out["second"].append(second[sent][a:b].tobytes())
                out["ids"].append(ids[sent][a:b].tobytes())
                out["at"].append(at[sent][a:b].astype(np.uint32).tobytes())
                out["settled"].append(None)
            if settled.any():
                out["bucket"].append(number % buckets)
                out["batch"].append(number)
                out["settled"].append(np.sort(at[settled]).astype(np.uint32).tobytes())
                for k in ("first", "second", "ids", "at"):
                    out[k].append(None)
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return run


def _later_windows(table: pa.Table) -> pa.Table:
    """One bucket: places of windows that start in an earlier text too, by batch."""
    held = {k: table.column(k).to_pylist() for k in table.column_names}
    batches, places = [], []
    lists = {k: [] for k in ("first", "second", "ids", "at", "batch")}
    for i, settled in enumerate(held["settled"]):
        if settled is not None:
            batches.append(held["batch"][i])
            places.append(settled)
            continue
        for k, kind in (("first", np.uint64), ("second", np.uint32), ("ids", np.int64), ("at", np.uint32)):
            lists[k].append(np.frombuffer(held[k][i], kind))
        lists["batch"].append(np.full(len(lists["at"][-1]), held["batch"][i]))
    if lists["at"]:
        first, second, ids, at, batch = (np.concatenate(lists[k]) for k in lists)
        order = np.lexsort((ids, second, first))
        first, second, ids, at, batch = first[order], second[order], ids[order], at[order], batch[order]
        head = np.ones(len(at), dtype=bool)
        head[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        leader = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        later = ids > ids[leader]
        at, batch = at[later], batch[later]
        order = np.lexsort((at, batch))
        at, batch = at[order], batch[order]
        for number, a, b in runs(batch):
            batches.append(number)
            places.append(at[a:b].tobytes())
    return pa.table([pa.array(batches, pa.int64()), pa.array(places, pa.binary())], names=["batch", "places"])


def _cut(packed: pa.Table, removed: pa.Table) -> pa.Table:
    """One batch and its repeated windows -> the result rows of its texts."""
    out = {k: [] for k in ("id", "n_words", "n_removed", "kept_sha256", "kept")}
    for data in packed.column("data").to_pylist():
        table = expand(data)
        lists = [t.split() if t else [] for t in table.column("text").to_pylist()]
        ends = np.cumsum([len(w) for w in lists])
        total = int(ends[-1]) if len(ends) else 0
        change = np.zeros(total + 1, dtype=np.int64)
        for places in removed.column("places").to_pylist():
            at = np.frombuffer(places, np.uint32).astype(np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
        keep = np.cumsum(change[:total]) == 0
        for id_, words, end in zip(table.column("id").to_pylist(), lists, ends.tolist(), strict=True):
            own = keep[end - len(words) : end]
            kept = b" ".join(words if own.all() else [w for w, k in zip(words, own.tolist(), strict=True) if k])
            out["id"].append(id_)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(len(words) - own.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and the kept text."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    buckets = text_buckets(docs, text_col)
    packed = frozen(named.mapInArrow(_pack, "batch long, data binary"))
    names = packed.mapInArrow(_symbol_names(buckets), "bucket int, batch long, names binary")
    shared = names.groupBy("bucket").applyInArrow(_shared_names, "batch long, names binary").where("length(names) > 0")
    open_ = packed.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        _open_windows(buckets),
        "bucket int, batch long, first binary, second binary, ids binary, at binary, settled binary",
    )
    removed = open_.groupBy("bucket").applyInArrow(_later_windows, "batch long, places binary")
    rows = packed.groupBy("batch").cogroup(removed.groupBy("batch")).applyInArrow(
        _cut, "id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    return rows.withColumnRenamed("id", id_col)
