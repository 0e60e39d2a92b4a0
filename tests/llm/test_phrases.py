import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrank.llm import phrases as ph
from tests_llm_brute import awkward, empty  # noqa: F401


def brute(docs, least, longest, rows):
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for m in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    found = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    out = []
    for (lang, p), a in found.items():
        if any(g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * f >= 80 * a for (g, q), f in found.items()):
            continue
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, rank, *r[1:]) for rank, r in enumerate(own[:rows], 1)]
    return sorted(ranked)


def _docs(seed, n=250):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["New", "YORK", "é", "Ä\x1cx", "a\x85b", "\xa0"]
    fixed = ["new york city hall", "as far as we", "w1 w1 w1 w1 w1", "é Ä\x1cx"]
    docs = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choice(words[: 3 + rng.randrange(60)]) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(9))]
        docs.append((rng.choice([". ", " ", ",", "\n", "\t", "\r\n", " ?"]).join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return docs + [(None, "en"), ("", None), ("w1 " * 9_000, "fr")]


@pytest.mark.parametrize("seed,head,together,rows", [(1, 1 << 18, 16_384, 2000), (2, 5, 2, 2000), (3, 0, 2, 7), (4, 40, 3, 50)])
def test_matches_brute_force_with_few_or_no_ranks(spark, monkeypatch, seed, head, together, rows):
    docs = _docs(seed)
    table = spark.createDataFrame(docs, "text STRING, lang STRING")
    got = sorted(map(tuple, ph.mine_phrases(table, 5, 4, rows, head=head, together=together).collect()))
    assert got == brute(docs, 5, 4, rows)


def test_tiles_and_coordinates_count_alike():
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.integers(0, 30, 4000), rng.integers(0, 9000, 4000), rng.integers(-40, -1, 500)])
    b = np.concatenate([rng.integers(0, 30, 4000), rng.integers(0, 9000, 4000), rng.integers(-3, 40, 500)])
    tiles, sums = ph.Tiles(3), {}
    rows = [*tiles.add(a[:5000], b[:5000]), *tiles.add(a[5000:], b[5000:]), *tiles.finish()]
    for row in (r for batch in rows for r in batch.to_pylist()):
        sums.setdefault(row["part"], ph._Sum(row["part"])).add(row["a"], row["b"], row["n"])
    got = {(x, y): n for s in sums.values() for x, y, n in zip(*(v.tolist() for v in s.pairs(1)))}
    assert got == Counter(zip(a.tolist(), b.tolist()))
    assert any(p < ph.DENSE * ph.DENSE for p in sums) and any(p >= ph.DENSE * ph.DENSE for p in sums)


def test_scores_past_64_bits(spark):
    big = 9 * 10**15
    rows = spark.createDataFrame([(big, [big + 7, big], [big + 1, big])], "n LONG, pre ARRAY<LONG>, suf ARRAY<LONG>")
    assert rows.select(ph._score().alias("s")).first().s.score == 2_000_000 * big // (2 * big + 8)


def test_awkward_rows(spark, awkward, empty):
    clash = awkward.withColumns({"n": F.lit("z"), "a": F.lit(1)})
    want = brute([(r.text, r.lang) for r in awkward.collect()], 2, 4, 2000)
    assert sorted(map(tuple, ph.mine_phrases(clash, 2).collect())) == want
    assert ph.mine_phrases(empty).count() == 0
