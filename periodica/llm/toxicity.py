"""Toxicity by the nearest labelled examples, exact under TF-IDF cosine.

Model. A bounded sample of labelled texts, ``per_class`` of each class, gives the examples, and the
terms whose presence goes with the label (chi-square, at most ``terms``) give the vocabulary. The
document frequencies of these terms are counted over all documents. Weights are
``(1 + ln tf) * idf``, scaled to length 1 within the vocabulary.

Search. The inverted index keeps each term's postings in blocks of ``BLOCK`` consecutive examples
together with the block's largest weight. The sum of query weight times block maximum bounds every
cosine inside a block. The best bounded blocks are scored first, and all blocks that could still
reach the k-th cosine after them, so the neighbours are those of a full search. Equal cosines go to
the lower example number.

Score. A neighbour votes with ``1 / (1.1 - cosine)``. The sample is balanced and a vote is not a
probability, so votes are mapped to the base rate by a logistic curve, fitted on the examples'
own leave-one-out votes. A text without a vocabulary term has no neighbours; the base rate is its vote.

What passes through the driver is bounded by the parameters: ``terms`` terms, their counts, and
``2 * per_class`` sparse examples over them.

NULL and empty texts have no terms. Labels that are NULL or for unknown ids are ignored; of several
labels for one id the toxic one holds, and of several texts for one id the first in order is learnt.
Without examples of both classes the base rate is the score (0 without any). Repeated rows get equal
scores, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import slices

BLOCK = 64
FIRST_BLOCKS = 4
EVIDENCE = 3
WORD = re.compile(r"\w+")


def terms_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


@dataclass
class Index:
    """Examples over a vocabulary, in blocks of postings, with the curve that maps votes to scores."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    weights: np.ndarray  # block, term, place in the block
    maxima: np.ndarray  # term, block
    neighbours: int
    base_rate: float
    curve: tuple[float, float] | None = None

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and scaled weights of a text."""
        known = sorted((self.vocabulary[w], n) for w, n in counts.items() if w in self.vocabulary)
        terms = np.array([t for t, _ in known], dtype=np.int64)
        return terms, scaled(np.array([n for _, n in known], dtype=np.float64), self.idf[terms])

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples with a cosine over 0, nearest first."""
        if not len(terms) or not len(self.ids):
            return np.array([], dtype=np.int64), np.array([])
        bounds = weights @ self.maxima[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        numbers, cosines = self._scored(order[:FIRST_BLOCKS], terms, weights)
        rest = order[FIRST_BLOCKS:]
        if len(cosines) >= k:
            floor = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
            rest = rest[bounds[rest] >= floor - 1e-9]
        if len(rest):
            more, closer = self._scored(rest, terms, weights)
            numbers, cosines = np.concatenate([numbers, more]), np.concatenate([cosines, closer])
        best = np.lexsort((numbers, -np.round(cosines, 9)))[:k]
        return numbers[best], cosines[best]

    def _scored(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(blocks):
            return np.array([], dtype=np.int64), np.array([])
        cosines = np.einsum("t,btp->bp", weights, self.weights[blocks[:, None], terms[None, :]]).ravel()
        numbers = (blocks[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
        met = (cosines > 1e-12) & (numbers < len(self.ids))
        return numbers[met], cosines[met]

    def vote(self, numbers: np.ndarray, cosines: np.ndarray) -> float | None:
        if not len(numbers):
            return None
        strength = 1.0 / (1.1 - np.minimum(cosines, 1.0))
        return float((strength * self.toxic[numbers]).sum() / strength.sum())

    def score(self, vote: float | None) -> float:
        if self.curve is None:
            return self.base_rate
        slope, shift = self.curve
        vote = self.base_rate if vote is None else vote
        return round(1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, slope * vote + shift)))), 9)


def scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1.0 + np.log(np.maximum(counts, 1.0))) * idf
    length = math.sqrt(float((weights * weights).sum()))
    return weights / length if length else weights


def logistic(votes: np.ndarray, toxic: np.ndarray, base_rate: float) -> tuple[float, float] | None:
    """Slope and shift of the curve, classes weighted back to the base rate; None unless votes help."""
    positive, total = int(toxic.sum()), len(toxic)
    if not 0 < positive < total or not 0 < base_rate < 1:
        return None
    target = np.where(toxic == 1, (positive + 1) / (positive + 2), 1 / (total - positive + 2))
    weight = np.where(toxic == 1, base_rate / positive, (1 - base_rate) / (total - positive)) * total
    x = np.stack([votes, np.ones(total)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * np.array([beta[0], 0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else None


def build(
    vocabulary: list[str], idf: np.ndarray, examples: list[tuple[int, int, dict[int, int]]], neighbours: int, base_rate: float
) -> Index:
    """Index of (id, toxic, {term: count}); examples that share their heaviest term share blocks."""
    vectors = []
    for id_, toxic, counts in examples:
        if counts:
            terms = np.array(sorted(counts), dtype=np.int64)
            weights = scaled(np.array([counts[t] for t in terms.tolist()], dtype=np.float64), idf[terms])
            vectors.append((int(terms[np.argmax(weights)]), toxic, id_, terms, weights))
    vectors.sort(key=lambda v: v[:3])
    blocks = -(-len(vectors) // BLOCK)
    dense = np.zeros((blocks, len(vocabulary), BLOCK))
    for number, (_, _, _, terms, weights) in enumerate(vectors):
        dense[number // BLOCK, terms, number % BLOCK] = weights
    index = Index(
        {w: i for i, w in enumerate(vocabulary)},
        idf,
        np.array([v[2] for v in vectors], dtype=np.int64),
        np.array([v[1] for v in vectors], dtype=np.int64),
        dense,
        dense.max(axis=2).T.copy() if blocks else np.zeros((len(vocabulary), 0)),
        neighbours,
        base_rate,
    )
    votes = []
    for number, (_, _, _, terms, weights) in enumerate(vectors):
        numbers, cosines = index.nearest(terms, weights, neighbours + 1)
        others = numbers != number
        vote = index.vote(numbers[others][:neighbours], cosines[others][:neighbours])
        votes.append(base_rate if vote is None else vote)
    silent = [toxic for _, toxic, counts in examples if not counts]
    toxic = np.concatenate([index.toxic, np.array(silent, dtype=np.int64)])
    index.curve = logistic(np.array(votes + [base_rate] * len(silent)), toxic, base_rate)
    return index


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, texts, toxic texts) of each batch."""
    for batch in batches:
        seen, bad = Counter(), Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            terms = terms_of(text).keys()
            seen.update(terms)
            if toxic:
                bad.update(terms)
        columns = [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([bad[t] for t in seen], pa.int64())], names=["term", "n", "bad"])


def _frequencies(vocabulary: list[str]):
    """(term number, texts) summed over each task's texts; number -1 counts all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {w: i for i, w in enumerate(vocabulary)}
        total, rows = Counter(), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                for text in batch.column("text").to_pylist():
                    rows += 1
                    if text:
                        total.update(numbers.keys() & set(WORD.findall(text.lower())))
        terms = [-1, *(numbers[w] for w in total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.int32()), pa.array([rows, *total.values()], pa.int64())], names=["term", "n"]
        )

    return run


def _example_counts(vocabulary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {w: i for i, w in enumerate(vocabulary)}
        for batch in batches:
            counts = [{numbers[w]: n for w, n in terms_of(t).items() if w in numbers} for t in batch.column("text").to_pylist()]
            kinds = pa.map_(pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array([sorted(c.items()) for c in counts], kinds)],
                names=["id", "toxic", "counts"],
            )

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 1024,
    terms: int = 256,
    neighbours: int = 15,
) -> Index:
    """Fit on a bounded sample of ``labels`` (rows to learn from only); count frequencies over all ``docs``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = known.join(texts.select("id"), "id", "left_semi")
    sums = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    base_rate = (sums["bad"] or 0) / sums["n"] if sums["n"] else 0.0
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    # At most 2 * per_class ids.
    sample = texts.join(F.broadcast(picked[0].unionAll(picked[1])), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    seen = sample.mapInArrow(_presence, "term string, n long, bad long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")
    )
    held = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).toArrow().to_pylist()}
    bad, good = held.get(1, 0), held.get(0, 0)
    total = bad + good
    a, b, c, d = F.col("bad"), F.col("n") - F.col("bad"), F.lit(bad) - F.col("bad"), F.lit(good) - (F.col("n") - F.col("bad"))
    product = F.greatest((a + b) * (c + d) * (a + c) * (b + d), F.lit(1)).cast("double")
    chi = (F.pow((a * d - b * c).cast("double"), 2) * F.lit(total)) / product
    # 15.1 is the value chance exceeds once in 10,000 terms.
    chosen = seen.withColumn("chi", chi).where("chi >= 15.1").orderBy(F.desc("chi"), "term").limit(terms)
    vocabulary = sorted(chosen.select("term").toArrow().to_pydict()["term"])
    found = texts.select("text").mapInArrow(_frequencies(vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r["term"]: r["n"] for r in found.toArrow().to_pylist()}
    all_texts = frequency.get(-1, 0)
    idf = np.array([math.log((1 + all_texts) / (1 + frequency.get(i, 0))) + 1 for i in range(len(vocabulary))])
    counts = sample.mapInArrow(_example_counts(vocabulary), "id long, toxic int, counts map<int,long>").toArrow().to_pylist()
    examples = [(r["id"], r["toxic"], dict(r["counts"])) for r in counts]
    return build(vocabulary, idf, examples, neighbours, base_rate)


def score_column(docs: DataFrame, index: Index, text_col: str = "text") -> Column:
    """struct(score, vote, evidence) of a text; evidence lists the nearest examples."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = "score double, vote double, evidence array<struct<example:bigint,toxic:int,cosine:double>>"

    @F.pandas_udf(kind)
    def judged(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        scores, votes, evidence = [], [], []
        for text in texts:
            numbers, cosines = model.nearest(*model.vector(terms_of(text)), model.neighbours)
            vote = model.vote(numbers, cosines)
            scores.append(model.score(vote))
            votes.append(vote)
            shown = zip(numbers[:EVIDENCE].tolist(), cosines[:EVIDENCE].tolist(), strict=True)
            evidence.append([(int(model.ids[n]), int(model.toxic[n]), round(c, 9)) for n, c in shown])
        return pd.DataFrame({"score": scores, "vote": pd.array(votes, dtype="Float64"), "evidence": evidence})

    return judged(F.col(text_col).cast("string"))


def score_texts(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, predicted, vote, evidence."""
    judged = docs.select(F.col(id_col), score_column(docs, index, text_col).alias("j"))
    return judged.select(
        id_col,
        F.col("j.score").alias("score"),
        (F.col("j.score") >= 0.5).cast("int").alias("predicted"),
        F.col("j.vote").alias("vote"),
        F.col("j.evidence").alias("evidence"),
    )


def held_out(id_: Column) -> Column:
    """Ids kept for testing: crc32 of the id as text leaves no remainder by 5. A NULL id is not learnt from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))
