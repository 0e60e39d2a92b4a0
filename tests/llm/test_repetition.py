import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrank.llm import repetition
from tallyrank.llm.common import offsets
from tests_llm_brute import awkward, empty  # noqa: F401


def brute(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            if i != j:
                n = 0
                while max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=24), min_size=1, max_size=5))
def test_repeat_lengths_match_brute_force(texts):
    bounds = offsets(np.array([len(t) for t in texts]))
    got = repetition.repeat_lengths(np.array([w for t in texts for w in t], np.int64), bounds)
    assert got.tolist() == [x for t in texts for x in brute(t)]


def test_base_counts_and_verdict():
    line = " ".join(f"u{i}" for i in range(30))
    texts = [f"{line}\n{line}\n \n{line} #*", " ".join(f"v{i}" for i in range(60)), "a b", ""]
    got = repetition.judge_texts(texts, 8, 0.3, 60, 50)
    assert got["n_words"].tolist() == [91, 60, 2, 0]
    assert got["n_symbols"].tolist() == [2, 0, 0, 0]
    assert got["n_dup_lines"].tolist() == [1, 0, 0, 0]
    assert got["n_repeat_words"].tolist() == [90, 0, 0, 0]
    assert got["base_failed"].tolist() == [True, False, True, True]
    assert got["kept"].tolist() == [False, True, False, False]
    assert got["longest_repeat"].tolist() == [60, 0, 0, 0]
    assert got["word_chars"][1] == sum(len(f"v{i}") for i in range(60))


def test_repeated_passage_is_rejected_whatever_stands_between():
    rng = random.Random(1)
    fill = lambda n: " ".join(str(rng.random()) for _ in range(n))
    passage = fill(80)
    got = repetition.judge_texts([f"{fill(300)} {passage} {fill(300)} {passage} {fill(50)}", fill(900)], 8, 0.3, 60, 50)
    assert got["kept"].tolist() == [False, True]
    assert got["longest_repeat"].tolist() == [80, 0]
    assert got["covered_words"].tolist() == [160, 0]


def test_awkward_rows(spark, awkward, empty):
    got = repetition.repetition_report(awkward).toPandas()
    assert len(got) == 7
    assert got.set_index("doc_id").loc[4, "n_words"] == 30_000
    assert got["n_words"].tolist() == [0, 0, 0, 3, 30_000, 3, 200]
    assert repetition.repetition_report(empty).count() == 0
    kept = repetition.keep_unrepetitive(awkward)
    assert kept.columns == awkward.columns
    assert [r.doc_id for r in kept.collect()] == [4]
    assert repetition.keep_unrepetitive(empty).count() == 0
