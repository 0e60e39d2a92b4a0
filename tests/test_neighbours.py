import math
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import RATINGS
from tallyrank.operators import graph, neighbours as nb
from tallyrank.operators.gram import pair_sums

R = np.array(RATINGS, dtype=float)


def _pairs(df, value="w"):
    return {(r.a, r.b): r[value] for r in df.collect()}


def test_item_similarity_by_hand(ratings):
    got = _pairs(nb.item_similarity(ratings))
    seen = R > 0
    for (i, j) in combinations(range(4), 2):
        c = (seen[:, i] & seen[:, j]).sum()
        if c:
            assert got[i, j] == pytest.approx(c / math.sqrt(seen[:, i].sum() * seen[:, j].sum()))
        else:
            assert (i, j) not in got
    assert all(0 < w <= 1 for w in got.values())


@pytest.mark.parametrize("heavy", [0, 512])
def test_penalised_user_similarity(ratings, heavy):
    got = _pairs(nb.user_similarity(ratings, popular_item_penalty=True, heavy=heavy))
    seen = R > 0
    for u, v in combinations(range(5), 2):
        c = sum(1 / math.log(1 + seen[:, i].sum()) for i in range(4) if seen[u, i] and seen[v, i])
        assert got.get((u, v), 0.0) == pytest.approx(c / math.sqrt(seen[u].sum() * seen[v].sum()))


def _cosine(m):
    norm = np.linalg.norm(m, axis=1)
    return (m @ m.T) / np.outer(norm, norm)


def test_predictions_match_dense_algebra(ratings):
    sim = _cosine(R.T)
    want = (R @ sim) / np.abs(sim).sum(axis=1)
    for r in nb.predict_by_items(ratings).collect():
        assert r.pred == pytest.approx(want[r.user_id, r.item_id])
    users = _cosine(R)
    mean = R.mean(axis=1)
    want = mean[:, None] + users @ (R - mean[:, None]) / np.abs(users).sum(axis=1)[:, None]
    rows = nb.predict_by_users(ratings).collect()
    assert len(rows) == 20
    for r in rows:
        assert r.pred == pytest.approx(want[r.user_id, r.item_id])


def test_recommendations_hold_no_seen_item(tables):
    train = tables.train
    recs = nb.item_cf_recommend(train, nb.item_similarity(train))
    assert recs.join(train, ["user_id", "item_id"]).count() == 0
    top = recs.groupBy("user_id").agg(F.max("rank").alias("m"), F.count("*").alias("n"))
    assert top.where("m <> n or n > 10").count() == 0


def _swing(pairs, alpha=0.5):
    users, items = defaultdict(set), defaultdict(set)
    for u, i in pairs:
        users[u].add(i)
        items[i].add(u)
    out = {}
    for i, j in combinations(sorted(items), 2):
        s = sum(1 / (alpha + len(users[u] & users[v])) for u, v in combinations(sorted(items[i] & items[j]), 2))
        if s:
            out[i, j] = s
    return out


@pytest.mark.parametrize("heavy", [0, 512])
def test_swing_by_brute_force(spark, heavy):
    rng = np.random.default_rng(5)
    pairs = {(int(u), int(i)) for u, i in zip(rng.integers(0, 12, 70), rng.integers(0, 9, 70))}
    pairs |= {(u, 0) for u in range(12)}  # an item everybody has
    df = spark.createDataFrame(sorted(pairs), "user_id LONG, item_id LONG")
    got = _pairs(graph.swing_similarity(df, heavy=heavy), "s")
    want = _swing(pairs)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_hottest_item_makes_no_candidates(spark):
    rows = [(u, 0) for u in range(50)] + [(0, 1), (1, 1)]
    df = spark.createDataFrame(rows, "user_id LONG, item_id LONG")
    assert [(r.u, r.v, r.n) for r in graph.common_items(df).collect()] == [(0, 1, 2)]


CLICKS = [("pc", "hp", 10), ("camera", "hp", 20), ("camera", "bestbuy", 5), ("digital", "hp", 30),
          ("digital", "bestbuy", 7), ("tv", "bestbuy", 15), ("flower", "tele", 16), ("flower", "orchids", 15)]


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_simrank_by_dense_rounds(spark, rounds):
    queries = sorted({q for q, _, _ in CLICKS})
    ads = sorted({a for _, a, _ in CLICKS})
    g = np.zeros((len(queries), len(ads)))
    for q, a, n in CLICKS:
        g[queries.index(q), ads.index(a)] = n
    link = (g > 0).astype(float)
    sq, sa = np.eye(len(queries)), np.eye(len(ads))
    for _ in range(rounds):
        nq = 0.8 * link @ sa @ link.T / np.outer(g.sum(1), g.sum(1))
        na = 0.8 * link.T @ sq @ link / np.outer(g.sum(0), g.sum(0))
        np.fill_diagonal(nq, 1)
        np.fill_diagonal(na, 1)
        sq, sa = nq, na
    src, dst = graph.simrank(spark.createDataFrame(CLICKS, "src STRING, dst STRING, w LONG"), 0.8, rounds)
    got = np.eye(len(queries))
    for r in src.collect():
        got[queries.index(r.i), queries.index(r.j)] = r.s
    assert np.allclose(got, sq)
    got = np.eye(len(ads))
    for r in dst.collect():
        got[ads.index(r.i), ads.index(r.j)] = r.s
    assert np.allclose(got, sa)


@pytest.mark.parametrize("heavy,few", [(1 << 18, 4096), (1 << 18, 0), (40, 4096), (40, 0)])
def test_votes_by_brute_force_on_every_path(spark, monkeypatch, heavy, few):
    monkeypatch.setattr(nb, "HEAVY_VOTES", heavy)
    monkeypatch.setattr(nb, "FEW_LISTS", few)
    rng = np.random.default_rng(3)
    rows = {(int(u), int(i)): float(rng.integers(1, 6)) for u, i in zip(rng.integers(0, 25, 300), rng.integers(0, 30, 300))}
    rows.update({(99, i): 2.0 for i in range(0, 30, 2)})
    train = spark.createDataFrame([(u, i, x) for (u, i), x in rows.items()] + [(None, 3, 1.0)] + [(u, None, 2.0) for u in range(8)], "user_id LONG, item_id LONG, rating DOUBLE")
    for side in (0, 1):
        pairs = {(a, b): float(rng.integers(1, 50)) for a, b in combinations(sorted({key[side] for key in rows}), 2) if rng.random() < 0.5}
        near = defaultdict(list)
        for (a, b), w in pairs.items():
            near[a].append((-w, b))
            near[b].append((-w, a))
        score = defaultdict(lambda: defaultdict(float))
        everything = [*rows.items(), ((None, 3), 1.0), *(((u, None), 2.0) for u in range(8))]
        for i, found in near.items():
            for w, j in sorted(found)[:4]:
                for (u, item), x in everything:
                    if side == 1 and item == i:
                        score[u][j] -= w * x
                    if side == 0 and u == j:
                        score[i][item] -= w * x
        want = set()
        for u, found in score.items():
            unseen = [(-s, item) for item, s in found.items() if (u, item) not in rows]
            want |= {(u, item, r, -s) for r, (s, item) in enumerate(sorted(unseen, key=lambda v: (v[0], -1 if v[1] is None else v[1]))[:5], 1)}
        frame = spark.createDataFrame([(a, b, w) for (a, b), w in pairs.items()], "a LONG, b LONG, w DOUBLE")
        recs = (nb.item_cf_recommend if side else nb.user_cf_recommend)(train, frame, 4, 5)
        assert {(r.user_id, r.item_id, r["rank"], r.score) for r in recs.collect()} == want


def test_votes_are_shuffled_once(spark):
    rows = [(u, (u * 7 + i * 5) % 60, 1.0) for u in range(40) for i in range(12)]
    train = spark.createDataFrame(rows, "user_id LONG, item_id LONG, rating DOUBLE")
    pairs = spark.createDataFrame([(a, b, 1.0) for a in range(60) for b in range(a + 1, 60)], "a LONG, b LONG, w DOUBLE")
    plan = nb.item_cf_recommend(train, pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("InMemoryTableScan")].count("Exchange hashpartitioning") == 1
