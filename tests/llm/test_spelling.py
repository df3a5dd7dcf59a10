"""Spelling variants against a plain version over all pairs."""

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import brute
import numpy as np
import pytest

from periodica.llm import spelling_variants as sv

ORDER = ("word", "form", "root", "n", "n_near", "form_n")
RULE = sv.Spelling(every=3, least_length=4, least_count=1, ratio=2)


def texts(seed=4, n=30):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abceéstÀÿ") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    out = [None, "", "Straße STRASSE Ünïcode × ÷x naïve4you ābcdef", "a" * 3000 + " " + "a" * 2999]
    for _ in range(n):
        out.append(" ".join(rng.choice(stems) for _ in range(rng.randrange(1, 80))).replace("a", rng.choice("aA")))
    return out


def edits(word):
    return {word[:i] + "\0" + word[i + 1 :] for i in range(len(word))}


def near(a, b):
    if len(a) == len(b):
        return a != b and sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) == len(short) + 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def plain(rows, rule):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.UPPER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % rule.every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= rule.least_length and n >= rule.least_count}
    around = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            around[a].append(b)
            around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= rule.ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(around[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


@pytest.mark.parametrize("rule", [RULE, sv.Spelling(), sv.Spelling(every=199, least_length=5, least_count=2, ratio=3)])
@pytest.mark.parametrize("tile", [2048, 3])
def test_variants(spark, rows, rule, tile):
    data = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id long, text string, word string, n int").repartition(3)
    assert rows(sv.group_variants(docs, rule, tile=tile), *ORDER) == plain(data, rule)


def test_variants_of_corpus_documents(spark, rows):
    data = [(i, t) for i, t, *_ in brute.documents()]
    rule = sv.Spelling(least_length=2, least_count=1, ratio=2)
    assert rows(sv.group_variants(brute.frame(spark), rule), *ORDER) == plain(data, rule)


def test_long_chains_reach_their_root(spark, rows):
    words = ["aaaaaa" + "b" * i for i in range(9)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(2**i))
    rule = sv.Spelling(every=10**9, least_count=1, ratio=2)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = rows(sv.group_variants(docs, rule), *ORDER)
    assert got == plain([(1, text)], rule)
    assert {r[2] for r in got} == {words[-1]}


def test_products_find_all_pairs_two_apart():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(2, 6))) for _ in range(200)})
    column = {c: i for i, c in enumerate("abcd")}

    def apart(a, b):
        return abs(len(a) - len(b)) < 2 and sum((a.count(c) - b.count(c)) ** 2 for c in "abcd") <= 2

    want = {frozenset(p) for p in combinations(words, 2) if apart(*p)}
    mixed = [len(w) % 2 ^ (w < "b") for w in words]
    side = dict(zip(words, mixed, strict=True))
    for sides, wanted in (([0] * len(words), want), (mixed, {p for p in want if len({side[w] for w in p}) == 2})):
        tile = sv.Tile(words, sides, column)
        found = [(words[i], words[j]) for a, b in tile.near_by_counts() for i, j in zip(a, b, strict=True)]
        assert {frozenset(p) for p in found} == wanted and len(found) == len(wanted)
        assert all(len(a) <= len(b) for a, b in found)


@pytest.mark.parametrize("laid_out", [48, 3])
def test_edits_of_a_tile_are_those_of_the_words(monkeypatch, laid_out):
    monkeypatch.setattr(sv, "LAID_OUT", laid_out)
    monkeypatch.setattr(sv, "PAIRS_AT_ONCE", 7)
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(120)}, key=len)
    tile = sv.Tile(words, [0] * len(words), {"a": 0, "b": 1})
    pairs = [(i, j) for i, j in combinations(range(len(words)), 2) if len(words[j]) - len(words[i]) < 2]
    got = tile.one_edit(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    assert got.tolist() == [sv.one_edit(words[i], words[j]) for i, j in pairs]
    assert got.tolist() == [near(words[i], words[j]) for i, j in pairs]


def test_one_edit():
    assert sv.one_edit("abc", "abcd") and sv.one_edit("bcd", "abcd") and sv.one_edit("abc", "axc")
    assert not sv.one_edit("abc", "abc") and not sv.one_edit("abc", "acb") and not sv.one_edit("abc", "axcd")


def test_null_ids_repeated_rows_and_empty_tables(spark, rows):
    data = [(None, "colour colour color"), (None, "colour colour color"), (1, "Colour"), (1, "Colour"), (2, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    rule = sv.Spelling(every=2, least_length=3, least_count=1, ratio=2)
    assert rows(sv.group_variants(docs, rule), *ORDER) == plain(data, rule)
    assert sv.group_variants(docs.limit(0)).collect() == []
