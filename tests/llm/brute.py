"""Plain single-machine versions of the corpus operators, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, batch string, kept boolean, id int"


def documents(seed: int = 3) -> list[tuple]:
    """(doc_id, text, ...): copies, near copies, shared passages, blanks, NULLs, one very long text."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "in", "and", "to"] * 6 + [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(400)]

    def words(n: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    texts: list[str | None] = [None, "", "  \t\n ", "one", "one two", "ONE two", "one two", None, "\x1fa\x85b c\xa0d"]
    base = words(200)
    for _ in range(12):
        near = list(base)
        for _ in range(rng.choice((1, 2, 3))):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    texts.append(" ".join(base))
    for _ in range(25):
        own = words(rng.randrange(1, 150))
        if rng.random() < 0.5:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage[: rng.randrange(15, 60)]
        texts.append(" \n".join(own))
    texts += [texts[-1], texts[-2], texts[-1].upper(), " ".join(["again"] * 90), " ".join(words(30) * 3)]
    texts.append(" ".join(words(6000) + passage + words(50)))
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(order[i] * 7 % 211, t) for i, t in enumerate(texts)]
    return [(i, t, "en", "s", len(t or ""), i, "x", True, 1) for i, t in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def copies(seed, count, edits, length=110):
    """Texts that differ from one of their own by some words: alike, and few of them linked."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    other = list(base)
    for place in rng.sample(range(length), 6):
        other[place] = f"other{place}"
    texts = [" ".join(base), " ".join(other)]
    for i in range(count):
        words = list(base if i % 2 else other)
        for _ in range(rng.choice(edits)):
            place, kind = rng.randrange(len(words)), rng.randrange(4)
            if kind < 2:
                words[place] = f"x{rng.randrange(10**6) if kind else rng.randrange(6)}"
            elif kind == 2:
                del words[place]
            else:
                words.insert(place, f"x{rng.randrange(10**6)}")
        texts.append(" ".join(words))
    rng.shuffle(texts)
    return list(enumerate(texts))


def words_of(text: str | None) -> list[str]:
    return BLANK.findall(text or "")


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(UPPER)].append(i)
    out = []
    for i, t in rows:
        key = (t or "").translate(UPPER)
        keep = max(groups[key])
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out)


def substrings(rows, window: int = 20):
    first = {}
    split = {i: words_of(t) for i, t in rows}
    for i in sorted(split):
        for p in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][p : p + window]), (i, p))
    out = []
    for i, words in split.items():
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] != (i, p):
                gone[p : p + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def shingles(text: str | None) -> frozenset:
    words = words_of((text or "").translate(UPPER))
    if not words:
        return frozenset()
    if len(words) < 3:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))


def jaccard(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    for i, s in sets.items():
        met = Counter(j for g in s for j in holders[g] if j < i)
        for j, shared in met.items():
            if 100 * shared >= 90 * (len(s) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def secrets(text: str | None):
    text = text or ""
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


def digest(found, names):
    return hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        v = int(c) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text: str | None):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def licenses(text: str | None):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    phrases = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
    places = []
    for label, phrase in phrases.items():
        parts = phrase.split()
        places += [(p, label) for p in range(len(words)) if words[p : p + len(parts)] == parts]
    starts = [p for p, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )
