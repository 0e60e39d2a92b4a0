import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyrank.operators import boosting as bo, learning as ln, metrics as m


def table(spark, x, y):
    rows = [(k, float(b), [float(v) for v in a]) for k, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id LONG, label DOUBLE, x ARRAY<DOUBLE>")
    return df.select("id", "label", array_to_vector("x").alias("features"))


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 12, (900, 4)).astype(float)
    x[:, 3] = rng.normal(size=900)
    chance = 1 / (1 + np.exp(-(np.sin(x[:, 0]) * 2 + (x[:, 1] > 6) * (x[:, 2] - 5) * 0.5)))
    return x, (rng.random(900) < chance).astype(float)


def brute(x, y, setting, cuts):
    """One split at a time over raw rows: every cut of every leaf is tried again after each split."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(setting.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        parts = [np.arange(len(y))]

        def score(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + setting.ridge)

        while len(parts) < setting.leaves:
            best = None
            for k, rows in enumerate(parts):
                for f, edges in enumerate(cuts):
                    for edge in edges:
                        left, right = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
                        if min(len(left), len(right)) < setting.least_rows:
                            continue
                        gain = round(score(left) + score(right) - score(rows), 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, k, left, right)
            if best is None:
                break
            parts[best[1]:best[1] + 1] = best[2:]
        for rows in parts:
            margin[rows] -= setting.rate * g[rows].sum() / (h[rows].sum() + setting.ridge)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("here", [0, 5_000, 1 << 21])
def test_trees_are_those_of_one_split_at_a_time(spark, points, monkeypatch, here):
    x, y = points
    rows = table(spark, x, y).repartition(3)
    setting = bo.Setting(trees=3, leaves=9, rate=0.3, rows=1.0, columns=1.0, ridge=0.5, least_rows=15)
    monkeypatch.setattr(bo, "HERE", here)
    model = bo.fit(rows, [setting])[0]
    got = {r.id: r.pred for r in bo.scores(model, rows).collect()}
    want = brute(x, y, setting, model.cuts)
    assert np.allclose([got[k] for k in range(len(y))], want, atol=1e-9)
    assert all(t.leaf.max() == 8 for t in model.trees)


def test_passes_and_tasks_agree_with_drawn_rows_and_few_cells(spark, points, monkeypatch):
    rows = table(spark, *points).repartition(3)
    setting = bo.Setting(trees=bo.STEP + 2, leaves=12, rate=0.1, least_rows=5)
    once = bo.scores(bo.fit(rows, [setting])[0], rows).orderBy("id").toPandas()
    monkeypatch.setattr(bo, "HERE", 0)
    monkeypatch.setattr(bo, "CELLS", 1)  # one leaf a pass
    again = bo.scores(bo.fit(rows.repartition(5), [setting])[0], rows).orderBy("id").toPandas()
    assert np.allclose(once["pred"], again["pred"], atol=1e-9)


def test_models_of_a_grid_are_those_fitted_alone(spark, points):
    rows = table(spark, *points)
    grid = [bo.Setting(trees=2, leaves=6, rate=rate, fold=fold) for rate in (0.1, 0.3) for fold in (-1, 1)]
    for setting, model in zip(grid, bo.fit(rows, grid)):
        alone = bo.fit(rows, [setting])[0]
        assert model.base == pytest.approx(alone.base)
        for a, b in zip(model.trees, alone.trees):
            assert np.array_equal(a.feature, b.feature) and np.allclose(a.value, b.value)


def test_a_fold_left_out_does_not_change_the_model(spark, points):
    rows = table(spark, *points)
    inside = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(3)) == 1
    setting = bo.Setting(trees=3, leaves=6, rate=0.2, fold=1)
    turned = rows.withColumn("label", F.when(inside, 1 - F.col("label")).otherwise(F.col("label")))
    one, two = (bo.scores(bo.fit(r, [setting])[0], rows).orderBy("id").toPandas()["pred"] for r in (rows, turned))
    assert np.allclose(one, two)


def test_ranks_held_out_rows_no_worse_than_the_library(spark, points):
    x, y = points
    whole = table(spark, x, y)
    train, test = whole.where("id < 600"), whole.where("id >= 600")

    def auc(scored):
        return m.roc_auc(scored.withColumn("y", F.col("label").cast("int")), "pred", "y").first().auc

    library = GBTClassifier(maxDepth=3, maxIter=20, stepSize=0.1, seed=9).fit(train)
    mine = bo.fit(train, [bo.Setting(trees=20, leaves=8, rate=0.1)])[0]
    assert auc(bo.scores(mine, test)) >= auc(ln.probability(library.transform(test)))


def test_loss_is_that_of_the_scores(spark, points):
    rows = table(spark, *points)
    model = bo.fit(rows, [bo.Setting(trees=4, leaves=6, rate=0.2)])[0]
    found = {r.tree: r for r in bo.progress([model], rows).where("not held").collect()}
    scored = bo.scores(model, rows).toPandas()
    want = -np.log(np.where(scored["label"] > 0.5, scored["pred"], 1 - scored["pred"])).sum()
    assert found[4].loss == pytest.approx(want) and found[4].n == 900
    assert [found[k].loss > found[k + 1].loss for k in range(4)] == [True] * 4


def test_odd_tables(spark):
    kind = "id LONG, label DOUBLE, x ARRAY<DOUBLE>"

    def rows(data):
        df = spark.createDataFrame(data, kind)
        return df.select("id", "label", F.when(F.col("x").isNotNull(), array_to_vector("x")).alias("features"))

    setting = bo.Setting(trees=2, leaves=4, rows=1.0, least_rows=1)
    some = rows([(1, 1.0, [0.0, float("nan")]), (2, 0.0, [0.0, 1.0]), (2, 0.0, [0.0, 1.0]), (3, None, [1.0, 1.0]), (None, 1.0, None)])
    empty = bo.fit(some.limit(0), [setting])[0]
    assert [r.pred for r in bo.scores(empty, some).collect()] == [0.5] * 4 and empty.trees == []
    alike = bo.fit(some.where("label = 0"), [setting])[0]
    assert [t.leaf.max() for t in alike.trees] == [0, 0]
    both = bo.fit(some, [setting])[0]
    assert {r.id: r.pred > 1 / 3 for r in bo.scores(both, some.where("id < 3")).collect()} == {1: True, 2: False}


def test_rows_of_one_partition_are_spread_and_a_tree_takes_a_pass_a_level(spark, points, monkeypatch):
    x, y = points
    rows = table(spark, x, y).coalesce(1)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 300)
    assert bo.dealt(rows, 900).rdd.getNumPartitions() == 3
    monkeypatch.setattr(bo, "TASK_ROWS", 50)
    assert bo.dealt(rows, 900).rdd.getNumPartitions() == 18
    calls = {"grown": 0, "best": 0}

    def counted(name, fn):
        def call(*args):
            calls[name] += 1
            return fn(*args)

        return call

    monkeypatch.setattr(bo, "_grown", counted("grown", bo._grown))
    monkeypatch.setattr(bo, "_best_splits", counted("best", bo._best_splits))
    monkeypatch.setattr(bo, "HERE", 350 * 28)  # leaves of more than 350 rows are large
    setting = bo.Setting(trees=2, leaves=12, rate=0.2, rows=1.0, columns=1.0)
    soon = bo.fit(rows, [setting])[0]
    calls.update(grown=0, best=0)
    monkeypatch.setattr(bo, "WAIT", 1000)
    late = bo.fit(rows, [setting])[0]
    assert calls["grown"] == 2 and calls["best"] >= 2
    for one, two in zip(soon.trees, late.trees):
        assert np.allclose(np.sort(one.value[one.leaf >= 0]), np.sort(two.value[two.leaf >= 0]))


def test_the_grid_has_the_reference_s_trees():
    assert ln.CTR_TREES.trees == 1500 and ln.CTR_TREES.depth == 10


def test_a_small_table_grows_in_one_task_a_model_as_in_passes(spark, points, monkeypatch):
    rows = table(spark, *points).repartition(3)
    grid = [bo.Setting(trees=bo.STEP + 2, leaves=12, rate=rate, least_rows=5, fold=fold) for rate in (0.1, 0.3) for fold in (-1, 1)]
    passes = []
    grow = bo._best_splits
    monkeypatch.setattr(bo, "_best_splits", lambda *args: passes.append(1) or grow(*args))
    whole, right = bo._fitted(rows, grid, 3)
    assert not passes
    monkeypatch.setattr(bo, "HERE", 0)
    split, same = bo._fitted(rows.repartition(5), grid, 3)
    assert passes and [len(m.trees) for m in whole] == [len(m.trees) for m in split] == [bo.STEP + 2] * 4
    for a, b in zip(whole, split):
        assert all(np.array_equal(x.leaf.max(), y.leaf.max()) for x, y in zip(a.trees, b.trees))
        one, two = (bo.scores(m, rows).orderBy("id").toPandas()["pred"] for m in (a, b))
        assert np.allclose(one, two, atol=1e-9)
    # held-out rows predicted right, counted from the margins, are those of the trees
    counted = {r.model: r.right for r in bo.progress(whole, rows).where(f"held and tree = {bo.STEP + 2}").collect()}
    assert {m: n for m, n in right.items() if grid[m].fold >= 0} == {m: n for m, n in counted.items() if grid[m].fold >= 0}
    assert right == same


def test_written_tables_go(spark, points):
    from tallyrank.session import discard, shared_folder, written

    saved = written(table(spark, *points).select("id"), "gone")
    name = saved.inputFiles()[0].split("/")[-2]
    assert saved.count() == 900
    discard(saved)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    discard(spark.range(1))
