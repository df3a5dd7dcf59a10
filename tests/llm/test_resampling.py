"""Importance resampling against a plain version, for one and for several words a feature."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import brute
import pytest

from periodica.llm import importance_resampling as ir

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ORDER = ("doc_id", "n_features", "weight", "score", "rank")


def plain_features(text, longest):
    words = WORDS.findall((text or "").translate(brute.UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, rule):
    def count(texts):
        total = Counter()
        for t in texts:
            total.update(crc32(f.encode()) % rule.buckets for f in plain_features(t, rule.longest)[1])
        return total

    s, t = count(x for _, x in rows), count(target)
    whole, wanted = sum(s.values()) + rule.buckets, sum(t.values()) + rule.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * whole / ((s[b] + 1) * wanted))) for b in range(rule.buckets)]
    scored = []
    for i, text in rows:
        words, features = plain_features(text, rule.longest)
        weight = sum(gain[crc32(f.encode()) % rule.buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{rule.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        scored.append((i, len(features), weight, score, len(words) >= rule.least_words))
    able = sorted((r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = able[: rule.percent * len(able) // 100]
    ranks = {}
    for n, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(n)
    return sorted(((*r[:4], ranks[r].pop() if ranks.get(r) else None) for r in scored), key=repr)


def target(spark, texts=("W1 w2, w3 w400 the of", None, "", "été w5 w5")):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id int, text string, word string")


@pytest.mark.parametrize(
    "rule",
    [ir.Resampling(), ir.Resampling(longest=3, buckets=64, percent=40, least_words=3), ir.Resampling(percent=100, least_words=0)],
)
def test_resample(spark, rows, rule):
    docs = [(i, t) for i, t, *_ in brute.documents()]
    wanted = [r.text for r in target(spark).collect()]
    got = rows(ir.resample(brute.frame(spark), target(spark), rule), *ORDER)
    assert got == plain(docs, wanted, rule)
    assert rule.percent < 100 or all(r[4] for r in got)


def test_chained_hashes_are_those_of_the_joined_words():
    words = ir.words_of("Ab, c-é 9 x".encode())
    levels = list(ir.feature_hashes(words, 6))
    assert levels[2][1] == crc32("c é 9".encode())
    assert [len(level) for level in levels] == [5, 4, 3, 2, 1, 0]


def test_folding_of_held_counts(spark, monkeypatch):
    docs = [(i, t) for i, t, *_ in brute.documents()]
    monkeypatch.setattr(ir, "HELD", 3)
    total = Counter(crc32(w.encode()) % 64 for _, t in docs for w in plain_features(t, 1)[0])
    assert ir.histogram(brute.frame(spark), "text", ir.Resampling(buckets=64)).tolist() == [total[b] for b in range(64)]


def test_null_ids_ties_and_repeated_rows(spark, rows):
    text = " ".join(f"w{i}" for i in range(30))
    data = [(None, text), (None, text), (4, text), (4, text), (2, text.upper()), (1, "few"), (None, None)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in data], "doc_id long, text string, score int, rank int")
    rule = ir.Resampling(percent=80)
    assert rows(ir.resample(docs, target(spark), rule), *ORDER) == plain(data, [r.text for r in target(spark).collect()], rule)


def test_empty_tables(spark):
    docs = brute.frame(spark)
    assert ir.resample(docs.limit(0), target(spark)).collect() == []
    assert ir.resample(docs, target(spark).limit(0)).count() == docs.count()
    none = ir.resample(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), target(spark)).collect()
    assert [r["rank"] for r in none] == [None]
