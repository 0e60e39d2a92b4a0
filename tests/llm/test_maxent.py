import math
import zlib
from collections import Counter

import numpy as np

from tallyrank.llm import maxent
from tallyrank.llm.common import lower_word_bytes
from tallyrank.llm.queries import op6_maxent
from tests_llm_brute import awkward, empty  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_base_is_brute_force_and_the_model_beats_it_on_held_out_rows(spark):
    got = op6_maxent(spark, SF).toPandas().set_index("doc_id")
    rows = [(r.doc_id, [*lower_word_bytes(r.text or ""), b""]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    assert (got.train_tokens == n).all() and len(got) == len(rows)
    for d, t in rows:
        r = got.loc[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known) == (len(t), sum(counts[w] > 0 for w in t))
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert abs(r.base_score - want) < 1e-6 * abs(want) + 1e-9
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    weights = rng.normal(0, 0.4, (maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    model = maxent.MaxentModel(weights, np.zeros(maxent.CLASSES, np.float32), {b"the": 1}, np.ones(maxent.CLASSES), np.ones(maxent.CLASSES))
    t = maxent.Tokens.of(["the cat sat on the mat", ""])
    classes = t.classes(model.own)
    f = t.features(classes)
    assert classes.tolist()[0] == 1 and classes.tolist()[-1] == 0 and len(classes) == 8
    every = sum(10 ** model.class_scores(f, np.full(len(classes), c)) for c in range(maxent.CLASSES))
    assert np.allclose(every, 1, atol=1e-5)
    assert (f[-1] == t.features(classes)[0]).all()  # no history crosses texts


def test_learning_follows_the_word_before():
    texts = ["red one blue two " * 200] * 4
    t = maxent.Tokens.of(texts)
    own = {b"red": 1, b"one": 2, b"blue": 3, b"two": 4}
    classes = t.classes(own)
    f = t.features(classes)
    zero = np.zeros((maxent.ROWS, maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32)
    weights, seen, bias, n = maxent.learn(*zero, iter([(f, classes)] * 5))
    model = maxent.MaxentModel(weights, bias, own, np.ones(maxent.CLASSES), np.ones(maxent.CLASSES))
    assert n == 5 * len(classes) and seen.sum() == maxent.FEATURES * n
    assert np.mean(10 ** model.class_scores(f, classes)) > 0.9


def test_awkward_rows(spark, awkward, empty):
    got = maxent.score_documents(awkward, chunk_docs=2).toPandas()
    assert len(got) == 7 and np.isfinite(got.score).all()
    assert got[got.doc_id == 2].n_tokens.tolist() == [1, 1]
    assert maxent.score_documents(empty).count() == 0


def test_sums_of_runs():
    rng = np.random.default_rng(6)
    times = np.array([1, 1, 2, 9, 40, 8, 3, 1])
    first = np.cumsum(times) - times
    x = rng.normal(size=(times.sum(), 5))
    assert np.allclose(maxent._sum_runs(x, first, times), np.add.reduceat(x, first, axis=0))
