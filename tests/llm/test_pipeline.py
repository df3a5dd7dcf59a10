"""The pipeline's stages on one table: each decision takes effect, clean rows stay whole."""

import brute
import pytest

import corpus_pipeline
from periodica.llm import decontamination, jaccard_join, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after each stage."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": rows}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, rows, FOLDER).write.parquet(path)
        rows = out[name] = spark.read.parquet(path)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, kept):
    start = kept["documents"]
    for name in ("toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination"):
        assert kept[name].columns == start.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    index = toxicity.fit(start, labels.where(~toxicity.held_out(labels["doc_id"])))
    clean = {r["doc_id"] for r in toxicity.score_texts(start, index).where("predicted = 0").collect()}
    assert {i for i, _ in pairs(kept["toxicity"])} == clean
    unique = {i for i, _, _, stays, _ in brute.exact(pairs(kept["toxicity"])) if stays}
    assert {i for i, _ in pairs(kept["exact_dedup"])} == unique
    single = {i for i, _, root in brute.jaccard(pairs(kept["exact_dedup"])) if i == root}
    assert {i for i, _ in pairs(kept["ngram_jaccard_join"])} == single
    items = decontamination.Items([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()])
    before = pairs(kept["ngram_jaccard_join"])
    free = {i for (i, _), found in zip(before, items.matches([t for _, t in before]), strict=True) if not found}
    assert {i for i, _ in pairs(kept["benchmark_decontamination"])} == free
    assert sorted(r["doc_id"] for r in kept["packing"].collect()) == sorted(free)


def test_run(spark, kept):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept["packing"].collect()))


def test_stages_keep_columns_and_bear_nulls(spark, tmp_path):
    docs = brute.frame(spark, [*brute.documents(), (None, "lonely null", None, None, None, None, None, None, None)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns
        assert got.where("doc_id is null").count() == 1


def test_near_copies_that_are_not_linked_do_not_all_meet(spark, monkeypatch):
    met, real = [], jaccard_join.possible_pairs

    def counted(pairs, rule):
        met.append(pairs.count())
        return real(pairs, rule)

    monkeypatch.setattr(jaccard_join, "possible_pairs", counted)
    rows = brute.copies(6, 400, [3, 4, 5])
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert {i for i, _ in pairs(got)} == {i for i, _, root in brute.jaccard(rows) if i == root}
    assert sum(met[1:]) <= 20 * len(rows)
