import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrank.llm import quality, toxicity
from tallyrank.llm.common import offsets
from tallyrank.llm.queries import op8_quality, op9_toxicity
from tests_llm_brute import awkward, empty  # noqa: F401

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"))
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / max(1, (y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("query,label,least", [(op8_quality, "quality", 0.97), (op9_toxicity, "toxic", 0.85)])
def test_held_out_rows(spark, query, label, least):
    found = query(spark, SF)
    assert found.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = found.toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert auc(both.score.to_numpy(), both[label].to_numpy()) > least


def test_gradient_of_the_attention_is_right():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 2, 7, 3])
    bounds = offsets(sizes)
    x, y = rng.normal(size=(17, quality.N_FEATURES)), np.array([0, 1, 1, 0, 1.0])
    fitted = quality.fit(x, bounds, y, rounds=400)
    assert np.round(fitted.score(x, bounds)).tolist() == y.tolist()
    a = fitted.forward(x, bounds)["a"]
    assert np.allclose(np.add.reduceat(a, bounds[:-1]), 1)


def test_one_bad_passage_is_found_among_good_ones():
    rng = np.random.default_rng(2)
    bags, y = [], []
    for k in range(300):
        bag = rng.normal(size=(rng.integers(3, 9), quality.N_FEATURES))
        if k % 3 == 0:
            bag[rng.integers(len(bag)), :3] += 4
        bags.append(bag)
        y.append(float(k % 3 != 0))
    fitted = quality.fit(np.concatenate(bags[:200]), offsets(np.array([len(b) for b in bags[:200]])), np.array(y[:200]))
    score = fitted.score(np.concatenate(bags[200:]), offsets(np.array([len(b) for b in bags[200:]])))
    assert auc(score, np.array(y[200:])) > 0.95


def test_features_are_of_the_whole_text():
    words = " ".join(f"word{i}" for i in range(400))
    x, bounds = quality.passage_features([words, "", words + "\n" + words])
    assert np.diff(bounds).tolist() == [7, 1, 13]
    assert not x[7].any()
    seen = x[:, 11]  # shares of words whose shingle stood earlier
    assert seen[:7].sum() == 0 and seen[-3] > 0.9


def test_planted_word_is_learnt_and_its_ratio_scales_it(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows = []
    for k in range(900):
        words = list(rng.choice(vocabulary, 40))
        if k % 5 == 0:
            words[int(rng.integers(40))] = "Zworthlessz,"
        rows.append((k, " ".join(words), int(k % 5 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(r[0], r[2], None) for r in rows], "doc_id LONG, toxic INT, text STRING")
    got = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).orderBy("doc_id").toPandas()
    assert ((got.score >= toxicity.THRESHOLD) == [bool(r[2]) for r in rows]).mean() > 0.995


def test_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (4, None, 0), (5, 0, 1), (6, 1, 0)], "doc_id LONG, quality INT, toxic INT")
    none = labels.where(F.lit(False))
    for own in (labels, none):
        for docs in (awkward, empty):
            model = quality.train_quality(docs, own)
            assert quality.score_quality(awkward, model).where("score between 0 and 1").count() == 7
            assert quality.keep_quality(awkward, model).columns == awkward.columns
            assert quality.score_quality(empty, model).count() == 0
            toxic = toxicity.train_toxicity(docs, own)
            assert toxicity.score_toxicity(awkward, toxic).where("score between 0 and 1").count() == 7
            assert toxicity.score_toxicity(empty, toxic).count() == 0


def test_repeated_ids_give_one_example(spark, monkeypatch):
    docs = spark.createDataFrame([(k % 4, f"some words of text number {k} " * 5) for k in range(200)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(4)], "doc_id LONG, quality INT, toxic INT")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, bounds, y: seen.append(len(y)))
    quality.train_quality(docs, labels, sample_rows=3)
    assert seen[0] <= 3
    model = toxicity.train_toxicity(docs, labels, sample_rows=3)
    assert abs(float(model.bias)) < 2


def test_long_texts_are_fitted_on_spaced_passages(spark, monkeypatch):
    assert quality.spaced(3, 5).tolist() == [0, 1, 2] and quality.spaced(10, 5).tolist() == [0, 2, 4, 6, 8]
    docs = spark.createDataFrame([(k, "word " * (64 * 20 if k % 2 else 30)) for k in range(12)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id LONG, quality INT")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, bounds, y: seen.append((np.diff(bounds).max(), set(y))))
    quality.train_quality(docs, labels, sample_passages=7)
    assert seen == [(7, {0.0, 1.0})]


def test_a_worker_keeps_the_words_of_one_model():
    from tallyrank.llm import toxicity as module

    first = module.kept_words("first")
    first[b"word"] = 1.0
    assert module.kept_words("first") is first
    assert module.kept_words("second") == {}
    assert module.kept_words("first") == {}
