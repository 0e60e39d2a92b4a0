import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyrank.operators import clusters as cl, learning as ln


def table(spark, x):
    df = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "id LONG, x ARRAY<DOUBLE>")
    return df.select("id", array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    return np.concatenate([rng.normal(c, 0.4, (60, 3)) for c in ((0, 0, 0), (4, 0, 0), (0, 4, 1), (3, 3, 3))])


def test_sweep_is_plain_rounds_of_moving_centres(spark, points):
    rows = table(spark, points).repartition(3)
    start = cl._start(rows, 7, 100, 2)
    sweep = cl.kmeans_sweep(rows, (2, 4, 7), seed=2, sample=100)
    for k in (2, 4, 7):
        at, steps = start[:k].copy(), []
        for _ in sweep.within[k]:
            apart = ((points[:, None] - at) ** 2).sum(2)
            label = apart.argmin(1)
            steps.append(apart.min(1).sum())
            at = np.array([points[label == c].mean(0) if (label == c).any() else at[c] for c in range(k)])
        assert np.allclose(sweep.centres[k], at) and np.allclose(sweep.within[k], steps)
        assert sweep.settled[k] and steps == sorted(steps, reverse=True)


def test_quality_is_that_of_the_library_on_the_same_labels(spark, points):
    rows = table(spark, points)
    got = {r.k: r for r in cl.kmeans_quality(rows, (3, 4), seed=1).collect()}
    sweep = cl.kmeans_sweep(rows, (3, 4), seed=1)
    for k in (3, 4):
        label = ((points[:, None] - sweep.centres[k]) ** 2).sum(2).argmin(1)
        labelled = rows.join(spark.createDataFrame([(i, int(c)) for i, c in enumerate(label)], "id LONG, cluster INT"), "id")
        want = ClusteringEvaluator(predictionCol="cluster").evaluate(labelled)
        ch = ln.calinski_harabasz(labelled.select("id", vector_to_array("features").alias("vec"), "cluster")).first().ch
        assert got[k].silhouette == pytest.approx(want) and got[k].ch == pytest.approx(ch) and got[k].clusters == k
    assert got[4].ch > got[3].ch


def test_few_equal_and_missing_rows(spark):
    rows = table(spark, [[1, 2]] * 5 + [[3, 4]])
    more = rows.unionByName(rows.select("id", F.lit(None).cast(rows.schema["features"].dataType).alias("features")))
    got = {r.k: r for r in cl.kmeans_quality(more, (1, 2, 5)).collect()}
    assert [got[k].clusters for k in (1, 2, 5)] == [1, 2, 2]
    assert got[1].silhouette is None and got[1].ch is None
    assert got[2].silhouette == pytest.approx(5 / 6)  # the row alone counts 0
    empty = cl.kmeans_quality(rows.limit(0), (2, 3)).collect()
    assert [(r.k, r.clusters, r.silhouette, r.ch) for r in empty] == [(2, 0, None, None), (3, 0, None, None)]


def test_tiles_leave_out_far_centres_only(monkeypatch):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(700, 3)), 1)
    x = x[np.lexsort(x.T)]
    monkeypatch.setattr(cl, "TILE", 50)
    centres = [x[rng.choice(700, k)] for k in (1, 9, 40)]
    tiles = list(cl._nearest(x, centres))
    for j, at in enumerate(centres):
        apart = ((x[:, None] - at) ** 2).sum(2)
        got = np.concatenate([found[j][1] for _, _, found in tiles])
        label = np.concatenate([found[j][0] for _, _, found in tiles])
        assert np.allclose(got, apart.min(1)) and np.allclose(apart[np.arange(700), label], apart.min(1))
    narrow = x[:50] * 0.1
    assert len(cl._Centres.of(centres).near(narrow).k) < 50


def test_rows_of_one_partition_are_spread(spark, points, monkeypatch):
    monkeypatch.setattr(cl, "LEAST_ROWS", 60)
    rows = table(spark, points).coalesce(1)
    sizes = [sum(len(x) for x in part) for part in cl._pack(rows).rdd.map(lambda r: [[0] * r.n]).glom().map(lambda p: [x for b in p for x in b]).collect()]
    assert sum(sizes) == 240 and max(sizes) < 150
