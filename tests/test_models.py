import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import RATINGS
from tallyrank.operators import bandit, factor as fa, fused, learning as ln, slim, vectors as vec

R = np.array(RATINGS, dtype=float)


def _entries(df):
    return df.select(F.col("user_id").alias("row"), F.col("item_id").alias("col"), F.col("rating").alias("x"))


def _matrix(factors, n, k):
    out = np.zeros((n, k))
    for r in factors.collect():
        out[r.id] = [r[f"f{d}"] for d in range(k)]
    return out


def test_zero_imputed_als_reaches_the_best_low_rank_error(ratings):
    left, right = fa.als_zero_imputed(_entries(ratings), 2, 30)
    got = _matrix(left, 5, 2) @ _matrix(right, 4, 2).T
    u, s, vt = np.linalg.svd(R)
    best = u[:, :2] @ np.diag(s[:2]) @ vt[:2]
    assert np.linalg.norm(R - got) == pytest.approx(np.linalg.norm(R - best), abs=1e-3)


def test_subspace_svd_matches_dense(ratings):
    left, right, values = fa.subspace_svd(_entries(ratings), 2)
    _u, s, _vt = np.linalg.svd(R)
    assert values == pytest.approx(list(s[:2]), abs=1e-4)
    rebuilt = _matrix(left, 5, 2) @ np.diag(values) @ _matrix(right, 4, 2).T
    u, s, vt = np.linalg.svd(R)
    assert np.allclose(rebuilt, u[:, :2] @ np.diag(s[:2]) @ vt[:2], atol=1e-3)


def test_nmf_is_nonnegative_and_improves(ratings):
    errors = []
    for rounds in (1, 15):
        left, right = fa.nmf(_entries(ratings), 2, rounds)
        a, b = _matrix(left, 5, 2), _matrix(right, 4, 2)
        assert (a >= 0).all() and (b >= 0).all()
        errors.append(np.linalg.norm(R - a @ b.T))
    assert errors[1] < errors[0]


@pytest.mark.parametrize("biased", [False, True])
def test_gradient_descent_lowers_the_loss(ratings, biased):
    entries = _entries(ratings)

    def loss(rounds):
        left, right, mean = fa.mf_gradient(entries, 3, rounds, 0.05, biased=biased)
        scored = fa.predict_entries(entries, left, right, 3, mean)
        return scored.agg(F.avg((F.col("x") - F.col("pred")) ** 2)).first()[0]

    assert loss(12) < loss(2)


def test_bpr_prefers_the_positive(spark):
    triples = spark.createDataFrame([(u, u % 2, 1 - u % 2) for u in range(6)], "user_id LONG, item_id LONG, neg LONG")
    users, items = fa.bpr_factors(triples, 4, 15, 0.5)
    u, i = _matrix(users, 6, 4), _matrix(items, 2, 4)
    scores = u @ i.T
    assert np.mean([scores[k, k % 2] > scores[k, 1 - k % 2] for k in range(6)]) > 0.9


def _slim_dense(g, ratio=0.02, alpha=0.5):
    n = len(g)
    w = np.zeros((n, n))
    for t in range(n):
        top = max((g[j, t] for j in range(n) if j != t), default=0)
        if not top:
            continue
        b, c = top * ratio, top * (1 - alpha) / alpha * ratio
        for _ in range(5000):
            for j in range(n):
                if j != t:
                    rest = g[j, t] - g[j] @ w[:, t] + g[j, j] * w[j, t]
                    w[j, t] = max(rest - b, 0) / (c + g[j, j])
    return w


def _slim_matrix(rows, n, **options):
    got = np.zeros((n, n))
    for r in slim.slim_weights(rows, **options).collect():
        got[r.j, r.t] = r.w
    return got


@pytest.mark.parametrize("entries,cell", [(1 << 25, 1 << 24), (120, 60)])
def test_slim_is_as_near_as_proven_at_every_width(spark, entries, cell):
    rng = np.random.default_rng(8)
    seen = (rng.random((30, 14)) < 0.15 + rng.random(14) * 0.6).astype(float)
    rows = spark.createDataFrame([(int(u), int(i)) for u, i in zip(*np.nonzero(seen))], "user_id LONG, item_id LONG")
    want = _slim_dense(seen.T @ seen)
    got = _slim_matrix(rows, 14, block_entries=entries, cell_weights=cell)
    assert np.linalg.norm(got - want, axis=0).max() <= 1e-3 and (np.diag(got) == 0).all() and (got >= 0).all()
    weights = spark.createDataFrame([(int(j), int(t), float(got[j, t])) for j, t in zip(*np.nonzero(got))], "j LONG, t LONG, w DOUBLE")
    proven = {r.t: r.distance for r in slim.slim_optimality(rows, weights).collect()}
    assert len(proven) == 14 and max(proven.values()) <= 1e-3
    worse = weights.withColumn("w", F.col("w") + 0.05)
    assert max(r.distance for r in slim.slim_optimality(rows, worse).collect()) > 1e-2


@pytest.mark.parametrize("users,targets,value", [(4096, 1024, None), (3, 4, "x")])
def test_slim_recommend_matches_dense_sums(spark, users, targets, value):
    rng = np.random.default_rng(9)
    seen = rng.random((20, 15)) < 0.3
    w = np.round(rng.random((15, 15)) * (rng.random((15, 15)) < 0.5), 1)
    times = rng.integers(1, 6, (20, 15)) * seen
    history = spark.createDataFrame([(int(u), int(i), int(times[u, i])) for u, i in zip(*np.nonzero(seen))], "user_id LONG, item_id LONG, x LONG")
    weights = spark.createDataFrame([(int(j), int(t), float(w[j, t])) for j, t in zip(*np.nonzero(w))], "j LONG, t LONG, w DOUBLE")
    got = {(r.user_id, r["rank"]): (r.item_id, round(r.score, 9)) for r in fused.top_unseen(history, weights, 4, users, targets, value).collect()}
    want = {}
    for u in range(20):
        score = np.round((times if value else seen)[u] @ w, 9) * ~seen[u]
        order = sorted((i for i in range(15) if score[i] > 0), key=lambda i: (-score[i], i))[:4]
        want |= {(u, k): (i, round(float(score[i]), 9)) for k, i in enumerate(order, 1)}
    assert got == want


def _vectors(spark, n=40, d=6, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    return m, spark.createDataFrame([(k, m[k].tolist()) for k in range(n)], "id LONG, vec ARRAY<DOUBLE>")


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("block", [7, 1000])
def test_nearest_is_exact(spark, metric, block):
    m, df = _vectors(spark)
    got = vec.nearest(df.withColumnRenamed("id", "query"), df, 5, metric, block).collect()
    scores = m @ m.T if metric == "ip" else -((m[:, None] - m[None]) ** 2).sum(-1)
    for q in range(len(m)):
        mine = sorted((r["rank"], r.id) for r in got if r.query == q)
        assert [i for _, i in mine] == list(np.argsort(-scores[q], kind="stable")[:5])


@pytest.mark.parametrize("block", [10, 1000])
def test_approximate_neighbours_find_most_of_the_exact(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12))
    m = np.concatenate([centres[c] + 0.4 * rng.normal(size=(60, 12)) for c in range(8)])
    df = spark.createDataFrame([(k, m[k].tolist()) for k in range(len(m))], "id LONG, vec ARRAY<DOUBLE>")
    units = vec.unit_vectors(df)
    exact = {(r["query"], r.id) for r in vec.nearest(units.withColumnRenamed("id", "query"), units, 10).collect()}
    got = vec.nearest_approx(df, 10, leaf=60, block=block).collect()
    found = {(r["query"], r.id) for r in got}
    assert len(exact & found) / len(exact) > 0.9
    assert all((k, k) in found for k in range(len(m)))


def test_vector_recommendations_skip_seen(spark):
    m, df = _vectors(spark)
    seen = {(q, (q + s) % 40) for q in range(40) for s in range(q)}
    rows = spark.createDataFrame(sorted(seen), "user_id LONG, item_id LONG")
    got = vec.best_unseen_by_vectors(df.withColumnRenamed("id", "user_id"), df, rows, 4, 9).collect()
    for q in range(40):
        want = [i for i in np.argsort(-(m[q] @ m.T)) if (q, i) not in seen][:4]
        assert [r.item_id for r in sorted((r for r in got if r.user_id == q), key=lambda r: r["rank"])] == want


def test_diversity_rerank_equals_greedy(spark):
    rng = np.random.default_rng(8)
    rows = [(u, i, f"c{rng.integers(0, 3)}", float(rng.random())) for u in range(15) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id LONG, item_id LONG, category STRING, score DOUBLE")
    got = vec.diversity_rerank(df, 0.3, 6).collect()
    for u in range(15):
        left, taken, want = [r for r in rows if r[0] == u], {}, []
        for _ in range(6):
            best = max(left, key=lambda r: r[3] - 0.3 * taken.get(r[2], 0))
            want.append(best[1])
            taken[best[2]] = taken.get(best[2], 0) + 1
            left.remove(best)
        assert [r.item_id for r in sorted((r for r in got if r.user_id == u), key=lambda r: r["rank"])] == want


def test_pca_components_are_centred_and_uncorrelated(spark):
    _m, df = _vectors(spark)
    rows = vec.pca_scores(df, k=3).toPandas().pivot(index="id", columns="component", values="x").to_numpy()
    assert np.allclose(rows.mean(0), 0, atol=1e-9)
    cov = np.cov(rows.T)
    assert np.allclose(cov - np.diag(np.diag(cov)), 0, atol=1e-8)


def test_linucb_scores_by_hand(spark):
    rng = np.random.default_rng(1)
    rows = [(k, f"a{k % 3}", int(rng.random() < 0.4), float(rng.random()), 1.0) for k in range(60)]
    log = spark.createDataFrame(rows, "k LONG, arm STRING, reward INT, x0 DOUBLE, x1 DOUBLE")
    state = bandit.linucb_theta(bandit.linucb_sums(log, "arm", ["x0", "x1"], "reward"), 2)
    got = {r.k: (r.arm, r.score) for r in bandit.linucb_scores(log, "k", ["x0", "x1"], state, 16).collect()}
    arms = {}
    for name in ("a0", "a1", "a2"):
        mine = [r for r in rows if r[1] == name]
        x = np.array([[r[3], r[4]] for r in mine])
        pay = np.array([0.6 if r[2] else -16.0 for r in mine])
        inverse = np.linalg.inv(np.eye(2) + x.T @ x)
        arms[name] = (inverse @ (x.T @ pay), inverse)
    for k, _arm, _reward, a, b in rows:
        x = np.array([a, b])
        scores = {n: th @ x + 0.25 * np.sqrt(x @ inv @ x) for n, (th, inv) in arms.items()}
        best = max(scores, key=scores.get)
        assert got[k][0] == best and got[k][1] == pytest.approx(scores[best], abs=1e-8)


def test_pairwise_rank_orders_by_the_informative_feature(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(20):
        for _ in range(10):
            y = int(rng.random() < 0.5)
            rows.append((g, y, y + 0.1 * rng.normal(), rng.normal()))
    df = spark.createDataFrame([(g, y, float(a), float(b)) for g, y, a, b in rows], "g LONG, label INT, good DOUBLE, noise DOUBLE")
    got = {r.feature: r.weight for r in ln.pairwise_rank(df, "g", ["good", "noise"]).collect()}
    assert got["good"] > 0.5 > abs(got["noise"])


def test_fm_score_by_hand(spark):
    rows = spark.createDataFrame([(1, 0, 2.0), (1, 1, 1.0), (2, 1, 3.0)], "id LONG, feat_id LONG, value DOUBLE")
    weights = spark.createDataFrame([(0, 0.5), (1, -1.0)], "feat_id LONG, w DOUBLE")
    factors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], "feat_id LONG, vec ARRAY<DOUBLE>")
    got = {r.id: r.score for r in vec.fm_scores(rows, weights, factors, 0.1).collect()}
    assert got[1] == pytest.approx(0.1 + 1.0 - 1.0 + 2.0 * (1 * 3 + 2 * -1))
    assert got[2] == pytest.approx(0.1 - 3.0)


def test_subspace_svd_settles_on_a_flat_spectrum(spark):
    rng = np.random.default_rng(3)
    left, right = (np.linalg.qr(rng.normal(size=(n, 30)))[0] for n in (60, 40))
    dense = left @ np.diag(np.linspace(10, 8, 30)) @ right.T
    entries = spark.createDataFrame([(i, j, float(dense[i, j])) for i in range(60) for j in range(40)], "row LONG, col LONG, x DOUBLE")
    _left, found, values = fa.subspace_svd(entries, 5, tol=1e-4)
    want = np.linalg.svd(dense)[1][:5]
    assert values == pytest.approx(list(want), rel=1e-3)
    v = _matrix(found, 40, 5)
    assert np.abs(dense.T @ dense @ v - v * np.array(values) ** 2).max() < 1e-2


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_tiles_of_the_base_keep_the_best_and_leave_out_banned_pairs(monkeypatch, metric):
    monkeypatch.setattr(vec, "TILE_ROWS", 16)
    rng = np.random.default_rng(8)
    q, b = rng.integers(-3, 4, (20, 3)).astype(float), rng.integers(-3, 4, (90, 3)).astype(float)
    ids = rng.permutation(90)
    take = np.arange(20) % 7
    banned = rng.integers(0, 20, 400), rng.integers(0, 90, 400)
    score = q @ b.T if metric == "ip" else -((q[:, None] - b[None]) ** 2).sum(2)
    for out in (None, banned):
        left = np.ones((20, 90), bool)
        if out is not None:
            left[out] = False
        want = []
        for row in range(20):
            best = sorted((-score[row, c], ids[c], c) for c in np.flatnonzero(left[row]))[: take[row]]
            want += [(row, c, -s) for s, _, c in best]
        got = zip(*vec._best_of_tile(q, b, ids, take, metric, out), strict=True)
        assert [(r, c, pytest.approx(s)) for r, c, s in want] == list(got)


def test_a_block_hands_on_unseen_items_only(spark):
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(60)], "id LONG, vec ARRAY<DOUBLE>")
    users = table.limit(12).withColumnRenamed("id", "query").withColumn("k", F.lit(3))
    seen = F.when(F.col("query") > 0, F.sequence(F.lit(0).cast("long"), F.col("query") * 4))
    found = vec._scan(users.withColumn("seen", seen), table, "ip", 15).collect()
    assert len(found) <= 12 * 3 * 4 and all(r.id > 4 * r["query"] or r["query"] == 0 for r in found)


@pytest.mark.parametrize("most,few", [(1 << 18, 1 << 19), (3, 1 << 19), (3, 0)])
def test_pooled_on_every_path(spark, monkeypatch, most, few):
    monkeypatch.setattr(vec, "POOL_ROWS", most)
    monkeypatch.setattr(vec, "FEW_VALUES", few)
    table = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "id LONG, vec ARRAY<DOUBLE>")
    members = spark.createDataFrame([(k, i) for k in range(4) for i in range(k, 12)] + [(None, 2), (7, 99), (7, None)], "key LONG, id LONG")
    got = {r.key: (r.n, r.vec) for r in vec.pooled(members, table).collect()}
    want = {k: (9 - k, [np.mean(range(k, 9)), 2.0 * np.mean(range(k, 9))]) for k in range(4)} | {None: (1, [2.0, 4.0]), 7: (0, [0.0, 0.0])}
    assert got == want


def test_pooled_vectors_are_not_shuffled(spark):
    table = spark.createDataFrame([(i, [float(i)] * 8) for i in range(9)], "id LONG, vec ARRAY<DOUBLE>")
    members = spark.createDataFrame([(k, i) for k in range(4) for i in range(9)], "key LONG, id LONG")
    plan = vec.pooled(members, table)._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("InMemoryTableScan")].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("biased", [False, True])
def test_whole_gradients_by_cells(spark, monkeypatch, biased):
    held = []
    monkeypatch.setattr(fa, "hold", lambda df: held.append(df.columns) or df.persist())
    monkeypatch.setattr(fa, "STEP_ENTRIES", 7)
    rng = np.random.default_rng(6)
    rows = sorted({(int(a), int(c)) for a, c in zip(rng.integers(0, 12, 90), rng.integers(0, 9, 90))})
    x = rng.integers(1, 6, len(rows)).astype(float)
    data = [(f"u{a}", c, None if n % 17 == 0 else float(v)) for n, ((a, c), v) in enumerate(zip(rows, x, strict=True))]
    entries = spark.createDataFrame(data + [(None, 3, 1.0), ("u1", None, 2.0)], "row STRING, col LONG, x DOUBLE")
    left, right, mean = fa.mf_gradient(entries, 3, 4, 0.05, 0.1, biased, cell_entries=10)
    assert all(len(columns) <= 5 for columns in held)  # no entry is kept with its vectors
    scale = np.sqrt(3) / 10
    begun = {}
    for side, tag, kind in (("row", "u", "STRING"), ("col", "v", "LONG")):
        ids = sorted({r[side == "col"] for r in data})
        begun[side] = {r.id: np.array([r.f0, r.f1, r.f2, 0.0]) for r in fa.start_factors(spark.createDataFrame([(i,) for i in ids], f"id {kind}"), 3, scale, tag).collect()}
    u, v = begun["row"], begun["col"]
    for _ in range(4):
        moved = []
        for own, theirs, at in ((u, v, 0), (v, u, 1)):
            new = {}
            for key, f in own.items():
                mine = [r for r in data if r[at] == key]
                known = [r for r in mine if r[2] is not None]
                miss = [(r[2] - (mean + f[3] + theirs[r[1 - at]][3] + f[:3] @ theirs[r[1 - at]][:3]), theirs[r[1 - at]]) for r in known]
                rate = 0.05 / (1 + 0.05 * len(mine))
                g = np.append(sum(e * t[:3] for e, t in miss), sum(e for e, _ in miss)) - 0.1 * len(mine) * f
                new[key] = f + rate * g * np.array([1, 1, 1, biased])
            moved.append(new)
        u, v = moved
    for table, want in ((left, u), (right, v)):
        got = {r.id: [r.f0, r.f1, r.f2, r.bias] for r in table.collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def _bpr_dense(triples, start, k, rounds, step, reg):
    users, items = ({key: np.array(v) for key, v in side.items()} for side in start)
    for _ in range(rounds):
        sums = [{key: np.zeros(k + 1) for key in side} for side in (users, items)]
        for u, i, j in triples:
            gap = items[i] - items[j]
            e = 1 / (1 + np.exp(users[u] @ gap))
            for side, key, move in ((0, u, gap), (1, i, users[u]), (1, j, -users[u])):
                sums[side][key] += [1, *(e * move)]
        for side, own in ((0, users), (1, items)):
            for key, total in sums[side].items():
                own[key] = own[key] + step / (1 + step * total[0]) * (total[1:] - reg * own[key])
    return users, items


@pytest.mark.parametrize("cell_entries", [1 << 20, 40, 8])
def test_bpr_cells_give_the_dense_gradient(spark, cell_entries):
    rng = np.random.default_rng(4)
    # user 0 has most triples, so that it is dealt to cells; some rows come twice, some have nulls
    rows = [(int(u), int(i), int(j)) for u, i, j in zip(rng.integers(0, 9, 90) * rng.integers(0, 2, 90), rng.integers(0, 12, 90), rng.integers(0, 12, 90))]
    rows += rows[:5]
    triples = spark.createDataFrame([*rows, (None, 1, 2), (3, None, 2), (3, 50, None)], "user_id LONG, item_id LONG, neg LONG")

    def plain(rounds):
        found = fa.bpr_factors(triples, 3, rounds, 0.3, 1e-2, cell_entries)
        return [{r.id: [r.f0, r.f1, r.f2] for r in side.collect()} for side in found]

    want, got = _bpr_dense(rows, plain(0), 3, 3, 0.3, 1e-2), plain(3)
    for a, b in zip(want, got):
        assert a.keys() == b.keys() and all(np.allclose(a[key], b[key], atol=1e-9) for key in a)
