from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrank.operators.gram import mirror, pair_sums, product_sums


def _entries(spark, seed=1, groups=30, members=25):
    rng = np.random.default_rng(seed)
    rows = {(int(g), int(m)): float(rng.integers(1, 6)) for g, m in zip(
        rng.integers(0, groups, 400), rng.integers(0, members, 400))}
    rows.update({(99, m): 2.0 for m in range(members)})  # one group with every member
    return rows, spark.createDataFrame([(g, m, x) for (g, m), x in rows.items()], "g LONG, m LONG, x DOUBLE")


def _brute(rows):
    by_group = defaultdict(dict)
    for (g, m), x in rows.items():
        by_group[g][m] = x
    out = defaultdict(lambda: [0.0, 0])
    for members in by_group.values():
        for a, b in combinations(sorted(members), 2):
            out[a, b][0] += members[a] * members[b]
            out[a, b][1] += 1
    return out


@pytest.mark.parametrize("heavy,block,chunk", [(1000, 8, 4), (20, 8, 4), (0, 4, 3), (0, 100, 100)])
def test_pair_sums_light_and_blocked(spark, heavy, block, chunk):
    rows, df = _entries(spark)
    want = _brute(rows)
    got = {(r.a, r.b): (r.value, r.n) for r in pair_sums(df, "g", "m", "x", heavy, block, chunk).collect()}
    assert got.keys() == want.keys()
    for key, (value, n) in got.items():
        assert value == pytest.approx(want[key][0]) and n == want[key][1]


def test_pair_sums_string_members(spark):
    rows, df = _entries(spark, 2)
    text = df.withColumn("m", F.format_string("m%03d", "m"))
    light = {(r.a, r.b): r.value for r in pair_sums(text, "g", "m", "x", 1000).collect()}
    dense = {(r.a, r.b): r.value for r in pair_sums(text, "g", "m", "x", 0, 7, 5).collect()}
    assert light.keys() == dense.keys()
    assert all(light[k] == pytest.approx(dense[k]) for k in light)


@pytest.mark.parametrize("heavy", [1000, 0])
def test_product_sums(spark, heavy):
    rows, df = _entries(spark, 3)
    left = df.select("g", F.col("m").alias("a"), "x")
    right = df.select("g", F.col("m").alias("b"), "x")
    a = np.zeros((100, 25))
    for (g, m), x in rows.items():
        a[g, m] = x
    want = a.T @ a
    got = np.zeros((25, 25))
    for r in product_sums(left, right, heavy, 6, 5).collect():
        got[r.a, r.b] = r.value
    assert np.allclose(got, want)


def test_mirror_lists_both_directions(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "a LONG, b LONG, w DOUBLE")
    assert sorted(map(tuple, mirror(df).collect())) == [(1, 2, 0.5), (2, 1, 0.5)]


def test_cancelling_sums_are_listed_on_every_path(spark):
    rows = [(g, m, 1.0 if (g + m) % 2 else -1.0) for g in range(2) for m in range(20)]
    left = spark.createDataFrame(rows, "g INT, a INT, x DOUBLE")
    right = left.withColumnRenamed("a", "b")
    joined = product_sums(left, right, heavy=1000).orderBy("a", "b").collect()
    blocked = product_sums(left, right, heavy=2, block=8, chunk=1).orderBy("a", "b").collect()
    assert len(joined) == 400 and joined == blocked


def test_chunked_groups_match_the_join(spark):
    rows = [(g, m, float(1 + (g * m) % 5)) for g in range(6) for m in range(3 + 17 * g)]
    entries = spark.createDataFrame(rows, "g INT, m INT, x DOUBLE")
    whole = pair_sums(entries, "g", "m", "x", heavy=1000).orderBy("a", "b").collect()
    assert pair_sums(entries, "g", "m", "x", heavy=4, block=1).orderBy("a", "b").collect() == whole
    assert pair_sums(entries, "g", "m", "x", heavy=8, block=1000).orderBy("a", "b").collect() == whole


@pytest.mark.parametrize("heavy", [1000, 12])
def test_sparse_pairs_are_summed_in_tasks_of_bounded_size(spark, heavy):
    rng = np.random.default_rng(5)
    rows = {(g, m): float(1 + (g + m) % 5) for g in range(40) for m in [0, *rng.choice(np.arange(1, 900), 5 + g // 2, replace=False).tolist()]}
    df = spark.createDataFrame([(g, m, x) for (g, m), x in rows.items()], "g LONG, m LONG, x DOUBLE")
    # member 0 is in every group, so that it is dealt to copies by partner
    got = pair_sums(df, "g", "m", "x", heavy, 64, 8, task_pairs=50)
    assert got.rdd.getNumPartitions() >= sum(k * (k - 1) // 2 for k in (6 + g // 2 for g in range(40)) if k <= heavy) // 50
    want = _brute(rows)
    found = {(r.a, r.b): (r.value, r.n) for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(value == pytest.approx(want[key][0]) and n == want[key][1] for key, (value, n) in found.items())
    counted = {(r.a, r.b): (r.value, r.n) for r in pair_sums(df, "g", "m", heavy=heavy, block=64, chunk=8, task_pairs=50).collect()}
    assert counted == {key: (float(n), n) for key, (_, n) in want.items()}
