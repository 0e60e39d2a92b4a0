"""Fixtures of these tests, and plain Python versions that several of them compare with."""

import re

import pytest

from tallyrank.llm.common import lower_word_bytes

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def shingles(text, words):
    w = lower_word_bytes(text or "")
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def components(texts, words, least):
    """The smallest number of the group of each text."""
    sets = [shingles(t, words) for t in texts]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))]


DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "some words here", "en", "a", 15),
        (4, long, "en", "b", len(long)), (5, "\x1c\x85  \t\n  é\U0001f600 x", "fr", "b", 9), (6, "a b c d e " * 40, "en", "b", 400),
    ]
    extra = "kept BOOLEAN, score DOUBLE, sequence_id STRING, words STRING, _group STRING, rank STRING, spans STRING, key STRING"
    return spark.createDataFrame([r + (None, None, "z", "z", "z", "z", "z", "z") for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
