from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyrank.operators import boosting as bo, factor as fa, learning as ln, metrics as m, text as tx


@pytest.fixture(scope="module")
def examples(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        a, b, c = (float(v) for v in rng.normal(size=3))
        rows.append((k, float(a + 0.5 * b > 0), [a, b, c]))
    df = spark.createDataFrame(rows, "id LONG, label DOUBLE, x ARRAY<DOUBLE>")
    whole = df.select("id", "label", array_to_vector("x").alias("features")).cache()
    return whole.where("id < 200"), whole.where("id >= 200")


def small_gbdt(train, test):
    return ln.gbdt(train, test, replace(ln.CTR_TREES, trees=5, depth=3), (0.1, 0.2))


def small_gbdt_lr(train, test):
    return ln.gbdt_lr(train, test, bo.Setting(trees=12, leaves=6, rate=0.2))


@pytest.mark.parametrize("model", [ln.fm_classifier, ln.logistic_wide, small_gbdt, small_gbdt_lr])
def test_classifiers_rank_a_separable_set(examples, model):
    train, test = examples
    scored = model(train, test)
    assert scored.count() == 100
    auc = m.roc_auc(scored.withColumn("y", F.col("label").cast("int")), "pred", "y").first().auc
    assert auc > 0.8


def test_leaf_features_list_every_tree(examples):
    train, test = examples
    rows = ln.gbdt_leaf_features(train, test, bo.Setting(trees=3, leaves=5))
    assert rows.count() == 300 and rows.where("leaf < 0 or leaf > 4 or tree > 2").count() == 0


def test_selection_keeps_the_informative_features(examples):
    train, _test = examples
    linear = {r.feature: r.kept for r in ln.select_from_linear(train).collect()}
    forest = {r.feature: r.importance for r in ln.select_from_forest(train).collect()}
    assert linear[0] and not linear[2]
    assert forest[0] > forest[2] and sum(forest.values()) == pytest.approx(1.0)


def test_out_of_fold_predicts_each_row_once(examples):
    train, test = examples
    out, mean = ln.oof_predictions(train, test, 3)
    rows = out.collect()
    assert sorted(r.id for r in rows) == list(range(200)) and {r.fold for r in rows} == {0, 1, 2}
    assert mean.count() == 100 and mean.where("pred < 0 or pred > 1").count() == 0


def test_ctcvr_is_the_product(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(200):
        x = float(rng.normal())
        click = float(x + rng.normal() > 0)
        rows.append((k, click, float(click and rng.random() < 0.5), [x]))
    df = spark.createDataFrame(rows, "id LONG, click DOUBLE, convert DOUBLE, v ARRAY<DOUBLE>")
    got = ln.ctcvr_model(df.withColumn("features", array_to_vector("v"))).collect()
    assert len(got) == 200 and all(r.ctcvr == pytest.approx(r.ctr * r.cvr) for r in got)


def test_library_als_and_topics(spark, ratings):
    recs = fa.als_mllib(ratings, rank=2, rounds=3, n=3)
    assert recs.groupBy("user_id").count().where("count <> 3").count() == 0
    docs = spark.createDataFrame(
        [(k, "red apple fruit apple" if k % 2 else "fast train rail train") for k in range(12)], "id LONG, t STRING")
    topics = tx.lda_topics(docs, "id", "t", k=2, top=2, rounds=10).collect()
    assert len(topics) == 4 and {r.topic for r in topics} == {0, 1}
    latent = tx.lsi_topics(docs, "id", "t", k=2, top=1).collect()
    assert {r.token for r in latent} == {"apple", "train"}
