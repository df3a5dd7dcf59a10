"""Golay-code fuzzy hashing: the code, the keys, the points, and whole components against brute force."""

import random
from itertools import combinations

import brute
import numpy as np
import pytest
import xxhash

from periodica.llm import simhash_golay as sg
from periodica.llm.common import stored


def plain_print(text):
    words = brute.words_of((text or "").translate(brute.UPPER))
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{id: component} for (id, fingerprint) rows."""
    least = {}
    for i, p in prints:
        least[p] = min(i, least.get(p, i))
    parent = {p: p for p in least}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(least, 2):
        if (a ^ b).bit_count() <= 3:
            parent[root(a)] = root(b)
    lowest = {}
    for p, i in least.items():
        lowest[root(p)] = min(i, lowest.get(root(p), i))
    return {i: lowest[root(p)] for i, p in prints}


def test_code_is_perfect():
    """Every word has one codeword within 3 errors, and six within 4 when the nearest has 3."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    _, _, near = sg._tables()
    index, fresh = sg.near_codewords(words)
    weights = np.bitwise_count(near)
    assert (weights[:, 0] <= 3).all()
    assert set(fresh.sum(axis=1)) <= {1, 6}
    low, high, _ = sg._tables()
    for column in range(6):
        errors = near[low[words & 0xFFF] ^ high[words >> 12]][:, column]
        codewords = words ^ errors
        assert not (low[codewords & 0xFFF] ^ high[codewords >> 12]).any()
        assert (np.bitwise_count(errors) <= 4).all()
        assert (codewords >> 11 == index[:, column]).all()


def test_prints_within_three_bits_share_a_key():
    rng = np.random.default_rng(2)
    for errors in (0, 1, 2, 3):
        for _ in range(400):
            a = int(rng.integers(0, 2**63))
            b = a
            for bit in rng.choice(64, errors, replace=False).tolist():
                b ^= 1 << bit
            place, key, first = sg.keys(np.array([a, b], dtype=np.uint64))
            ours, theirs = key[(place == 0) & first], key[place == 1]
            assert np.intersect1d(ours, theirs).size


def test_prints_within_three_bits_share_a_point_near_one_of_them():
    rng = np.random.default_rng(3)
    for errors in (1, 2, 3):
        for _ in range(100):
            a = int(rng.integers(0, 2**63))
            b = a
            for bit in rng.choice(64, errors, replace=False).tolist():
                b ^= 1 << bit
            place, point, far = sg.points(np.array([a, b], dtype=np.uint64))
            near_a, near_b = point[(place == 0) & ~far], point[(place == 1) & ~far]
            assert np.intersect1d(near_a, point[place == 1]).size or np.intersect1d(near_b, point[place == 0]).size


@pytest.mark.parametrize("few", [64, 1])
def test_components_of_a_crowd(spark, few):
    """A cluster of fingerprints a few bits around one centre, chains, and others far away."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {0, centre}
    for _ in range(250):
        p = centre
        for bit in rng.sample(range(64), rng.randrange(1, 7)):
            p ^= 1 << bit
        prints.add(p)
    step = rng.getrandbits(64)
    for start in range(0, 60, 3):
        step ^= 0b111 << start
        prints.add(step)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    order = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in order]
    links = sg.link_prints(spark.createDataFrame(signed, "print long").repartition(3), few).collect()
    parent = dict.fromkeys(order)
    parent = {p: p for p in order}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    want = plain_components(list(enumerate(order)))
    for i, j in combinations(range(len(order)), 2):
        assert (root(order[i]) == root(order[j])) == (want[i] == want[j])


@pytest.mark.parametrize("few", [64, 1])
def test_documents(spark, few):
    rows = [(i, t) for i, t, *_ in brute.documents()]
    got = sg.simhash_components(brute.frame(spark), few=few).collect()
    prints = [(i, plain_print(t)) for i, t in rows]
    want = plain_components(prints)
    assert sorted(tuple(r) for r in got) == sorted((i, f"{p:016x}", want[i]) for i, p in prints)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_are_not_broadcast(spark):
    """A few stored fingerprints stand for a thousand points each; so does what the join of the points collects."""
    rng = random.Random(6)
    prints = {0b111, *(1 << i for i in range(40)), *(rng.getrandbits(63) for _ in range(40))}
    few = stored(spark.createDataFrame([(p,) for p in prints], "print long"), "few-prints")
    links = sg._links_through_points(few)
    linked = {frozenset(link) for link in links.collect()}
    assert linked and all((a ^ b).bit_count() <= 3 for a, b in linked)
    assert "SortMergeJoin" in plan(links) and "Broadcast" not in plan(links)


def test_keys_and_links_are_not_broadcast(spark, monkeypatch):
    """Neither the keys that Python makes of stored fingerprints nor stored tables are collected for a join."""
    plans = {}

    def noted(df, label):
        plans[label] = plan(df)
        return stored(df, label)

    monkeypatch.setattr(sg, "stored", noted)
    sg.simhash_components(brute.frame(spark), few=64)
    for label in ("golay-keys", "print-links"):
        assert "SortMergeJoin" in plans[label] and "Broadcast" not in plans[label]


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(500))
    monkeypatch.setattr(sg, "PIECE", 7)
    assert sg.fingerprint(text.encode()) == plain_print(text)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d", 1), (7, "A b C d", 1), (7, "a b c d", 2), (3, None, 1), (9, "", 1), (5, "a b", 1), (None, None, 0)],
        "doc_id long, text string, print long",
    )
    got = sorted((tuple(r) for r in sg.simhash_components(docs).collect()), key=repr)
    same, two, zero = (f"{plain_print(t):016x}" for t in ("a b c d", "a b", ""))
    assert got == sorted(
        [(None, same, None), (7, same, 7), (7, same, 7), (3, zero, 3), (9, zero, 3), (5, two, 5), (None, zero, None)], key=repr
    )
    assert sg.simhash_components(docs.limit(0)).collect() == []
