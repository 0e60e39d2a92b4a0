import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrank.operators import embed, profiles, sampling
from tallyrank.operators import walks as wk
from tallyrank.streaming import twins
from tallyrank.operators import bandit

EDGES = [("a", "b", 8.0), ("b", "c", 1.0), ("a", "c", 3.0), ("c", "d", 5.0), ("d", "e", 0.5)]


@pytest.fixture(scope="module")
def graph(spark):
    return wk.undirected(spark.createDataFrame(EDGES, "src STRING, dst STRING, w DOUBLE")).cache()


def _weights():
    out = {}
    for s, d, w in EDGES:
        out[s, d] = out[d, s] = w
    return out


def test_second_order_factors_give_the_textbook_table(graph):
    w = _weights()
    p, q = 0.25, 4.0
    got = {(r.prev, r.cur): (r.back, r.near, r.far) for r in wk.second_order(graph, p, q).collect()}
    assert got.keys() == w.keys()
    for t, v in w:
        raw = {x: w[v, x] * (1 / p if x == t else 1 if (x, t) in w else 1 / q) for y, x in w if y == v}
        total = sum(raw.values())
        back, near, far = got[t, v]
        for x, value in raw.items():
            factor = back if x == t else near if (x, t) in w else far
            assert w[v, x] * factor == pytest.approx(value / total)


def _chains(trail):
    walks = {}
    for r in trail.collect():
        walks.setdefault(r.walk, {})[r.step] = r.node
    return [[steps[k] for k in range(len(steps))] for steps in walks.values()]


def test_uniform_walks_stay_on_edges(graph):
    chains = _chains(wk.uniform_walks(graph, 20, 6))
    assert len(chains) == 100 and all(len(c) == 6 for c in chains)
    assert all(step in _weights() for c in chains for step in zip(c, c[1:]))


def test_biased_walks_follow_the_second_order_law(graph):
    w, p, q = _weights(), 0.25, 4.0
    chains = _chains(wk.biased_walks(graph, 1500, 3, p, q))
    assert len(chains) == 7500 and all(len(c) == 3 for c in chains)
    first = Counter((c[0], c[1]) for c in chains)
    for s in "abcde":
        total = sum(x for (y, _), x in w.items() if y == s)
        for (y, d), x in w.items():
            if y == s:
                assert first[s, d] / 1500 == pytest.approx(x / total, abs=0.05)
    second = Counter(tuple(c) for c in chains)
    for t, v in w:
        n = first[t, v]
        if n < 300:
            continue
        raw = {x: w[v, x] * (1 / p if x == t else 1 if (x, t) in w else 1 / q) for y, x in w if y == v}
        for x, value in raw.items():
            assert second[t, v, x] / n == pytest.approx(value / sum(raw.values()), abs=0.07)


def test_stream_state_equals_batch(spark, tables):
    log = lambda df: df.select(F.col("event_type").alias("arm"), (F.col("value") > 50).cast("int").alias("reward"),
                               F.lit(1.0).alias("x0"), (F.hour("ts") / 24).alias("x1"))
    batch = bandit.linucb_sums(log(tables.events), "arm", ["x0", "x1"], "reward").toPandas().sort_values("arm")
    stream = twins.stream_arm_sums(spark, f"{tables.folder}/events.parquet", tables.events.schema, log, ["x0", "x1"])
    got = stream.toPandas().sort_values("arm")[list(batch.columns)]
    assert list(got.arm) == list(batch.arm)
    assert np.allclose(got.drop(columns="arm"), batch.drop(columns="arm"))


def test_stream_upsert_over_several_batches(spark, tmp_path):
    schema = "k LONG, v LONG, op STRING, x STRING"
    base = spark.createDataFrame([(k, 0, "upsert", "base") for k in range(20)], schema)
    batches = [[(1, 2, "upsert", "new"), (2, 5, "delete", ""), (30, 1, "upsert", "added")],
               [(1, 1, "upsert", "late"), (2, 4, "upsert", "late"), (3, 9, "upsert", "three")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        for file in (tmp_path / f"part{n}").glob("*.parquet"):
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / f"{n}-{file.name}").write_bytes(file.read_bytes())
    got = twins.stream_profile_upsert(
        spark, str(tmp_path / "in"), base.schema, lambda df: df, base, "k", ["v"], ["x"], rows_per_bucket=5, files_per_batch=1)
    want = {k: (0, "base") for k in range(20)} | {1: (2, "new"), 30: (1, "added"), 3: (9, "three")}
    del want[2]
    assert {r.k: (r.v, r.x) for r in got.collect()} == want


def test_stopped_streams_go_on_with_a_new_query(spark, tmp_path, monkeypatch):
    schema = "k LONG, v LONG, op STRING, x STRING"
    base = spark.createDataFrame([(k, 0, "upsert", "base") for k in range(20)], schema)
    state, folder = str(tmp_path / "state"), tmp_path / "in"
    folder.mkdir()

    def arrive(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        for file in (tmp_path / f"part{n}").glob("*.parquet"):
            (folder / f"{n}-{file.name}").write_bytes(file.read_bytes())

    def run(first):
        return twins.stream_profile_upsert(spark, str(folder), base.schema, lambda df: df, first, "k", ["v"], ["x"], rows_per_bucket=5, files_per_batch=1, state=state)

    for n in range(3):
        arrive(n, [(k, n + 1, "upsert", f"round {n}") for k in range(n, 20)])
    run(base)
    arrive(3, [(5, 9, "upsert", "late"), (6, 9, "delete", "")])
    whole, calls = profiles.latest_versions, []

    def fails(*given):
        calls.append(1)
        raise RuntimeError("stopped in the middle of a batch")

    monkeypatch.setattr(profiles, "latest_versions", fails)
    with pytest.raises(Exception, match="stopped in the middle"):
        run(base)
    monkeypatch.setattr(profiles, "latest_versions", whole)
    other = spark.createDataFrame([], schema)  # the base is not read again
    got = {r.k: (r.v, r.x) for r in run(other).collect()}
    want = {k: (min(k, 2) + 1, f"round {min(k, 2)}") for k in range(20)} | {5: (9, "late")}
    del want[6]
    assert calls and got == want
    kept = {int(f.name.partition("=")[2]) for f in (tmp_path / "state" / "profiles").glob("bucket=*/batch=*")}
    assert kept <= {2, 3} and len(list((tmp_path / "state" / "versions").iterdir())) == 2


def test_stopped_arm_sums_go_on(spark, tmp_path):
    schema = "arm STRING, reward INT, x0 DOUBLE"
    rows = [[("a", 1, 1.0), ("b", 0, 2.0)], [("a", 0, 3.0)], [("b", 1, 0.5), ("c", 1, 1.0)]]
    folder = tmp_path / "in"
    got = None
    for n, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        got = twins.stream_arm_sums(spark, str(folder), spark.createDataFrame([], schema).schema, lambda df: df, ["x0"], str(tmp_path / "state"))
    everything = spark.createDataFrame([r for part in rows for r in part], schema)
    want = bandit.linucb_sums(everything, "arm", ["x0"], "reward").toPandas().sort_values("arm")
    mine = got.toPandas().sort_values("arm")[list(want.columns)]
    assert list(mine.arm) == list(want.arm) and np.allclose(mine.drop(columns="arm"), want.drop(columns="arm"))


@pytest.mark.parametrize("both", [True, False])
def test_common_weights_by_brute_force(spark, both):
    rng = np.random.default_rng(6)
    w = {(int(a), int(b)): float(x) for a, b, x in zip(rng.integers(0, 14, 70), rng.integers(0, 14, 70), rng.integers(1, 5, 70))}
    if both:
        w |= {(b, a): x for (a, b), x in w.items()}
    edges = spark.createDataFrame([(a, b, x) for (a, b), x in w.items()], "src LONG, dst LONG, w DOUBLE")
    got = {(r.prev, r.cur): r.common for r in wk.common_weights(edges).collect()}
    want = {}
    for cur, prev in w:
        total = sum(x for (s, g), x in w.items() if s == cur and (prev, g) in w)
        if total:
            want[prev, cur] = total
    assert got == want


def test_a_hub_makes_no_two_step_pairs(spark):
    star = spark.range(1, 100_001).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("w"))
    rows = wk.second_order(wk.undirected(star))
    assert rows.count() == 200_000 and rows.where("near > 1").count() == 0


def test_window_pairs_by_hand(spark):
    rows = [("s", p, x) for p, x in enumerate("abcab")] + [("t", 7, "c"), ("t", 8, "a"), ("t", 11, "b")]
    got = {(r.c, r.o): r.n for r in embed.window_pairs(spark.createDataFrame(rows, "seq STRING, pos LONG, node STRING"), 2).collect()}
    want = {}
    for s, p, x in rows:
        for t, q, y in rows:
            if s == t and 0 < abs(p - q) <= 2:
                want[x, y] = want.get((x, y), 0) + 1
    assert got == want


@pytest.mark.parametrize("block", [8192, 3])
def test_skip_gram_rounds_match_dense_rounds(spark, block):
    """Two groups of nodes that meet inside and hardly across; three rounds against the same rounds by dense algebra."""
    nodes = 10
    rows = [(a, b, 8.0 if a % 2 == b % 2 else 1.0) for a in range(nodes) for b in range(nodes) if a != b]
    pairs = spark.createDataFrame(rows, "c LONG, o LONG, n DOUBLE")
    n = np.zeros((nodes, nodes))
    for a, b, x in rows:
        n[a, b] = x
    vocab = spark.createDataFrame([(i, float(n[i].sum()), i) for i in range(nodes)], "item_id LONG, n DOUBLE, idx LONG")
    neg = np.zeros((nodes, nodes))
    for r in sampling.unigram_negatives(vocab.select(F.col("item_id").alias("user_id"), "item_id"), vocab, embed.DRAWS).collect():
        neg[r.user_id, r.neg] += n[r.user_id].sum() * 5 / embed.DRAWS
    unit = lambda i, d: int(hashlib.md5(f"u-{i}-{d}".encode()).hexdigest()[:8], 16) / 2**32
    u = np.array([[(unit(i, d) - 0.5) / 2.0 for d in range(4)] for i in range(nodes)])
    v = np.zeros((nodes, 4))
    losses = []
    for _ in range(12):
        p = 1 / (1 + np.exp(-u @ v.T))
        losses.append(-(n * np.log(p) + neg * np.log(1 - p)).sum())
        pull, w = n * (1 - p) - neg * p, n + neg
        u, v = u + 4.0 / (1 + w.sum(1))[:, None] * (pull @ v), v + 4.0 / (1 + w.sum(0))[:, None] * (pull.T @ u)
        if len(losses) == 3:
            third = u
    got = embed.skip_gram(pairs, 4, 3, block=block).collect()
    assert np.allclose(np.array([r.vec for r in sorted(got, key=lambda r: r.id)]), third, atol=1e-9)
    assert losses[-1] < losses[0]
    unit_u = u / np.linalg.norm(u, axis=1, keepdims=True)
    cosine = unit_u @ unit_u.T
    same = np.equal.outer(np.arange(nodes) % 2, np.arange(nodes) % 2) & ~np.eye(nodes, dtype=bool)
    assert cosine[same].mean() > cosine[~same & ~np.eye(nodes, dtype=bool)].mean()


def test_a_cell_of_skip_gram_holds_its_pairs_not_all_of_its_blocks(monkeypatch):
    width, size = 3000, 2
    monkeypatch.setattr(embed, "STEP_CELLS", 6)
    rng = np.random.default_rng(2)
    c, o = rng.permutation(width)[:50], rng.permutation(width)[:50]
    c[:7] = c[0]
    pos, neg, u, v = rng.random(50), rng.random(50), rng.normal(size=(width, size)), rng.normal(size=(width, size))
    pairs = pa.table({"c": c, "o": o, "pos": pos, "neg": neg})
    vectors = pa.table({"side": ["c"] * width + ["o"] * width, "idx": np.tile(np.arange(width), 2), "vec": np.concatenate([u, v]).tolist()})
    tracemalloc.start()
    got = embed._gradients(width, size)((pa.scalar(0), pa.scalar(0)), pairs, vectors).to_pylist()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < width * width  # a table of all pairs has eight times as many bytes
    chance = 1 / (1 + np.exp(-(u[c] * v[o]).sum(1)))
    pull = pos * (1 - chance) - neg * chance
    for side, nodes, other in (("c", c, v[o]), ("o", o, u[c])):
        found = {r["idx"]: r for r in got if r["side"] == side}
        assert set(found) == set(nodes.tolist())
        for x, r in found.items():
            assert np.allclose(r["g"], (pull[:, None] * other)[nodes == x].sum(0)) and np.isclose(r["w"], (pos + neg)[nodes == x].sum())


def test_biased_walks_end_on_a_node_without_edges(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("c", "a", 2.0)], "src STRING, dst STRING, w DOUBLE")
    trail = wk.biased_walks(edges, walks=3, length=6).collect()
    paths = {}
    for r in sorted(trail, key=lambda r: (r.walk, r.step)):
        paths.setdefault(r.walk, []).append(r.node)
    assert sorted(map(tuple, paths.values())) == [("a", "b")] * 3 + [("c", "a", "b")] * 3
