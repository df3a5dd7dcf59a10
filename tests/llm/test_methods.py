"""What the methods add to the plain contracts: confirmed encodings, checksums, models, search recall, packing."""

import base64
import itertools
import random
import re

import brute
import duckdb
import numpy as np
import pytest
from oracle import connect, differences

from periodica.llm import decontamination, license_scan, packing, pii_scan, secret_scan, toxicity, url_filter
from periodica.llm.oracles import ORACLES
from periodica.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def der(tag: int, body: bytes) -> bytes:
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82, size >> 8, size & 255])
    return bytes([tag]) + head + body


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, 60))) for _ in range(8)))
SSH = b"".join(len(p).to_bytes(4, "big") + p for p in (b"ssh-ed25519", bytes(32)))


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (base64.b64encode(RSA).decode(), "der"),
        (RSA.hex(), "der"),
        (base64.b64encode(SSH).decode(), "ssh"),
        ("-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----", "pem"),
        (base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode().rstrip("=") + ".e30.c2ln", "token"),
    ],
)
def test_structures_are_confirmed(text, kind):
    found = {secret_scan.KINDS[k] for _, k, _ in secret_scan.find_secrets(f"é x {text} y")}
    assert kind in found


@pytest.mark.parametrize("text", [base64.b64encode(RSA[:-1]).decode(), RSA[:-2].hex(), "eyJhIjoxfQ.e30.c2ln", "A" * 200])
def test_broken_structures_are_not(text):
    assert {k for _, k, _ in secret_scan.find_secrets(text)} <= {2}


def test_checksums_and_context(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32.", "GB82 WEST 1234 5698 7654 33", "social 123-45-6789", "000-45-6789", "card 4111111111111111"]
    rows = pii_scan.scan_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["spans"] for r in rows] == ["iban:5:32", "", "ssn:7:18", "", "card:5:21"]
    assert [r["scores"] for r in rows] == [[1.0], [], [0.55], [], [0.95]]


def test_license_with_changed_words(spark):
    words = license_scan.TEMPLATES["mit"].split()
    changed = " ".join(words[:9] + ["now", "then"] + words[9:20] + words[21:])
    texts = [f"Foo bar. {changed.title()}!", "permission is hereby granted", None, "Under the GNU General Public License, version 3."]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["mit", "", "", "gpl,gpl-3.0"]
    assert rows[0]["score"] > 0.7


def test_same_license_row_twice(spark):
    docs = spark.createDataFrame([(1, "cc by")] * 2 + [(None, "cc by")], "doc_id long, text string")
    assert [r["n_base"] for r in license_scan.scan_licenses(docs).collect()] == [1, 1, 1]


def test_boundaries_against_all_choices():
    rng = random.Random(5)
    for _ in range(40):
        sizes = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 9) for _ in sizes]
        buckets = rng.randrange(1, 5)

        def padded(ends, sizes=sizes, counts=counts):
            return sum(n * min(e for e in ends if e >= s) for s, n in zip(sizes, counts, strict=True))

        choices = itertools.chain.from_iterable(itertools.combinations(sizes, k) for k in range(1, buckets + 1))
        best = min(padded(c) for c in choices if c[-1] == sizes[-1])
        got = packing.optimal_boundaries(sizes, counts, buckets)
        assert padded(got) == best and len(got) <= buckets


def test_batches(spark):
    rows = packing.pack(brute.frame(spark), buckets=3, budget=400, shard_rows=8).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, *_ in brute.documents())
    words = {i: len(brute.words_of(t)) for i, t, *_ in brute.documents()}
    batches = {}
    for r in rows:
        assert r["n_tokens"] == words[r["doc_id"]] <= r["pad_to"] and r["padding"] == r["pad_to"] - r["n_tokens"]
        batches.setdefault((r["bucket"], r["shard"], r["batch"]), []).append(r)
    for batch in batches.values():
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0]["pad_to"] <= 400


def test_url_edges(spark):
    urls = [None, "", "no scheme casino", "HTTP://Sub.Example.COM/en/x", "http://com/", "http://x.com?free-bet", "http://a.net/es/", "ftp://h#f://g", "http://x.org/alphabet/free", "http://x.org/free/bet", "http://x.org/xxx"]
    config = url_filter.UrlRules(rules=(("allow", "com/"), ("block", "example.com/en/"), ("block", "net/es/")))
    docs = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    rows = url_filter.judge_urls(docs, config).orderBy("page_id").collect()
    assert [r["verdict"] for r in rows] == ["allow", "allow", "block", "block", "allow", "block", "block", "allow", "allow", "block", "block"]
    assert [r["rule"] for r in rows] == [None, None, None, "example.com/en/", "com/", None, "net/es/", None, None, None, None]
    assert (rows[3]["host"], rows[3]["path"], rows[7]["host"], rows[7]["path"]) == ("sub.example.com", "/en/x", "h", "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    vocabulary = [f"t{i}" for i in range(40)]
    idf = rng.uniform(1, 5, 40)
    examples = [(n, n % 2, {int(t): int(rng.integers(1, 5)) for t in rng.choice(40, rng.integers(1, 6), replace=False)}) for n in range(700)]
    index = toxicity.build(vocabulary, idf, examples, 15, 0.3)
    dense = np.zeros((len(index.ids), 40))
    for block in range(index.weights.shape[0]):
        part = index.weights[block].T
        dense[block * toxicity.BLOCK : block * toxicity.BLOCK + toxicity.BLOCK] = part[: len(index.ids) - block * toxicity.BLOCK]
    for _ in range(200):
        counts = {f"t{t}": int(rng.integers(1, 5)) for t in rng.choice(60, rng.integers(1, 9), replace=False)}
        terms, weights = index.vector(counts)
        numbers, cosines = index.nearest(terms, weights, 15)
        full = np.round(dense[:, terms] @ weights, 9)
        order = np.lexsort((np.arange(len(full)), -full))[:15]
        order = order[full[order] > 0]
        assert numbers.tolist() == order.tolist()
        assert np.allclose(cosines, full[order])


def test_toxicity_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    bad = ["awful", "rotten", "vile"]
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            words[5:5] = rng.sample(bad, 2)
        rows.append((i, " ".join(words), 0.5, "x"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, 0.1, "x"), (1001, "", 0.1, "x"), (None, "vile awful", 0.1, "x"), (3, rows[3][1], 0.5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, id string")
    known = spark.createDataFrame([*labels, (None, 1), (9999, 1), (7, None)], "doc_id long, toxic int")
    index = toxicity.fit(docs, known.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score_texts(docs, index).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    truth = dict(labels)
    held = [r for r in scored if r["held"] and r["doc_id"] in truth]
    assert len(held) > 80 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    empty = {r["doc_id"]: r for r in scored if r["doc_id"] in (1000, 1001)}
    assert all(r["score"] < index.base_rate and r["evidence"] == [] for r in empty.values())


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.score_texts(docs, toxicity.fit(docs, none)).collect()] == [0]
    assert toxicity.score_texts(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


def planted(rng, items, share):
    """Texts with an edited copy of an item each; edits up to a share of its words."""
    texts = []
    for _, text in items:
        words = text.split()
        for _ in range(int(len(words) * share)):
            at = rng.randrange(len(words))
            kind = rng.randrange(3)
            words[at : at + (kind < 2)] = [] if kind == 0 else [f"z{rng.randrange(999)}"]
        filler = [f"w{rng.randrange(200)}" for _ in range(80)]
        texts.append(" ".join(filler[:40] + words + filler[40:]))
    return texts


@pytest.mark.parametrize(("share", "least"), [(0.0, 1.0), (0.1, 0.97), (0.2, 0.9)])
def test_recall_of_edited_items(share, least):
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(15, 60)))) for i in range(120)]
    index = decontamination.Items(items)
    found = index.matches(planted(rng, items, share))
    met = sum(any(m[0] == i for m in own) for i, own in enumerate(found))
    assert met >= least * len(items)
    assert sum(len({m[0] for m in own} - {i}) for i, own in enumerate(found)) == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 7))]
        region = [rng.randrange(4) for _ in range(rng.randrange(0, 12))]
        distance, start, end = decontamination.edit_distance(item, np.array(region, dtype=np.int64))
        best = min(levenshtein(item, region[a:b]) for a in range(len(region) + 1) for b in range(a, len(region) + 1))
        assert distance == best == levenshtein(item, region[start:end])


def test_leak_edges(spark):
    items = spark.createDataFrame([(1, "Alpha beta, gamma delta epsilon zeta eta theta!"), (2, None), (3, "too short"), (None, "x " * 9)], "item_id long, text string")
    texts = ["pre ALPHA beta gamma delta epsilon zeta eta theta post", None, "", "alpha beta gamma", "alpha beta gamma delta epsilon zeta eta"]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int, start_word int")
    rows = sorted(tuple(r) for r in decontamination.find_leaks(docs, items).collect())
    assert rows == [(0, 1, 0, 1, 9), (4, 1, 1, 0, 7)]
    assert decontamination.find_leaks(docs, items.limit(0)).collect() == []
    assert decontamination.find_leaks(docs.limit(0), items).collect() == []


def test_verbatim_items_of_the_table(spark):
    def words(t):
        return " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "

    docs = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    want = {(i, j) for i, t in docs for j, x in items if words(x) in words(t)}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontamination"](spark, FOLDER).collect()}
    assert want and want <= got


def test_repeated_words_of_a_license_vote_once(spark):
    """One part of a template met over and over is no larger part of it."""
    whole = license_scan.TEMPLATES["gpl-3.0"]
    texts = [" ".join(["gnu general public"] * 4), whole, f"{whole} {whole}", f"it comes under gnu general public license version 3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan_licenses(docs).collect()}
    assert got[0] == ("", 0.0)
    assert got[1] == got[2] == ("gpl,gpl-3.0", 1.0)
    assert got[3][0] == "gpl,gpl-3.0"


def test_templates_of_the_caller(spark):
    docs = spark.createDataFrame([(1, "You may copy this freely, as you like."), (2, "all rights reserved")], "doc_id long, text string")
    got = license_scan.scan_licenses(docs, phrases={"free": "copy this freely"}, templates={"own": "you may copy this freely as you like"})
    assert sorted((r["doc_id"], r["labels"]) for r in got.collect()) == [(1, "free,own"), (2, "")]


def container(*parts: bytes, keys: int = 1) -> bytes:
    framed = [len(p).to_bytes(4, "big") + p for p in parts]
    return b"openssh-key-v1\x00" + b"".join(framed[:3]) + keys.to_bytes(4, "big") + b"".join(framed[3:])


def test_ssh_containers_are_parsed_to_their_end():
    good = container(b"none", b"none", b"", SSH, bytes(64))
    assert secret_scan.is_ssh_key(good)
    bad = [
        b"openssh-key-v1\x00garbage here",
        good[:-1],
        good + b"x",
        container(b"none", b"none", b"", SSH, bytes(64), keys=2),
        container(b"none", b"none", b"", b"garbage", bytes(64)),
        container(b"", b"none", b"", SSH, bytes(64)),
    ]
    assert not any(map(secret_scan.is_ssh_key, bad))


def test_keys_in_hex_of_either_case():
    key = bytes.fromhex("3010") + bytes.fromhex("020100") + bytes.fromhex("040b") + bytes(11)
    for digits in (key.hex(), key.hex().upper(), key.hex()[:20] + key.hex()[20:].upper()):
        kinds = [secret_scan.KINDS[k] for _, k, _ in secret_scan.find_secrets(f"key {digits} end")]
        assert kinds.count("der") == 1


def test_edit_distance_is_the_plain_one():
    rng = np.random.default_rng(5)

    def plain(item, stretch):
        row = list(range(len(stretch) + 1))
        for i, word in enumerate(item, 1):
            new = [i]
            for j, other in enumerate(stretch, 1):
                new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
            row = new
        return row[-1]

    for _ in range(150):
        item, region = rng.integers(1, 5, rng.integers(1, 9)).tolist(), rng.integers(0, 5, rng.integers(0, 12))
        distance, start, end = decontamination.edit_distance(item, region)
        stretches = [region[a:b].tolist() for a in range(len(region) + 1) for b in range(a, len(region) + 1)]
        assert distance == plain(item, region[start:end].tolist()) == min(plain(item, s) for s in stretches)


def test_regions_that_lack_too_many_words_are_not_aligned(monkeypatch):
    """A passage that shares only a stretch with an item is refuted by its words alone; close ones are found as before."""
    words = [f"w{i}" for i in range(20)]
    items = decontamination.Items([(1, " ".join(words))])
    near = [*words[:7], "other", *words[8:14], *words[15:]]
    assert [m[0][:2] for m in items.matches([" ".join(["pre", *near, "post"])])] == [(1, 2)]
    assert items.common_words(0, np.array([1, 1, 2, 0, 0])) == 2

    def never(*args):
        raise AssertionError("aligned")

    monkeypatch.setattr(decontamination, "edit_distance", never)
    text = np.array([items.vocabulary.get(w, 0) for w in [*words[:12], *["other"] * 8]])
    assert items.verify(text, 0, 0) is None
