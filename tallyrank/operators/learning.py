"""Clusters, supervised models and their ensembles over (id, label, features) rows."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    FMClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_int, key_digest
from tallyrank.operators import boosting as bo
from tallyrank.operators.ranking import position
from tallyrank.operators.splits import stratified_folds
from tallyrank.session import hold


def assemble(df: DataFrame, key: str, label: Column | None, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(id, label, features): numbers as they are, categories one-hot."""
    stages = [StringIndexer(inputCols=categorical, outputCols=[f"{c}_i" for c in categorical], handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}_i" for c in categorical], outputCols=[f"{c}_v" for c in categorical]),
              VectorAssembler(inputCols=[*numeric, *[f"{c}_v" for c in categorical]], outputCol="features")]
    rows = Pipeline(stages=stages).fit(df).transform(df)
    tag = label if label is not None else F.lit(0)
    return rows.select(F.col(key).alias("id"), tag.cast("double").alias("label"), "features")


def probability(scored: DataFrame) -> DataFrame:
    return scored.select("id", "label", vector_to_array("probability")[1].alias("pred"))


def fm_classifier(train: DataFrame, test: DataFrame, factors: int = 10, rounds: int = 20, seed: int = 9) -> DataFrame:
    model = FMClassifier(factorSize=factors, solver="adamW", maxIter=rounds, stepSize=0.05, seed=seed).fit(train)
    return probability(model.transform(test))


def logistic_wide(train: DataFrame, test: DataFrame, strength: float = 0.001, l1: float = 1.0) -> DataFrame:
    """The linear part with an L1 penalty."""
    model = LogisticRegression(regParam=strength, elasticNetParam=l1, maxIter=30).fit(train)
    return probability(model.transform(test))


CTR_TREES = bo.Setting(trees=1500, leaves=1024, depth=10, rows=0.7, fresh=1, columns=0.5, ridge=1.0, least_rows=1,
                       least_weight=1.2, least_gain=0.4)
LEAF_TREES = bo.Setting(trees=100, leaves=64, rate=0.01, rows=0.8, fresh=5, columns=0.9)


def gbdt(train: DataFrame, test: DataFrame, setting: bo.Setting = CTR_TREES,
         rates: tuple[float, ...] = (0.01, 0.02, 0.03, 0.04, 0.05), folds: int = 3) -> DataFrame:
    """(id, label, pred): boosted trees with the learning rate that predicts most held-out rows right."""
    rate = bo.search(train, setting, rates, folds)
    return bo.scores(bo.fit(train, [replace(setting, rate=rate)])[0], test)


def gbdt_leaf_features(train: DataFrame, rows: DataFrame, setting: bo.Setting = LEAF_TREES) -> DataFrame:
    """(id, label, tree, leaf): the one-hot position of each row in each boosted tree."""
    model = bo.fit(train, [setting])[0]
    return bo.leaves(model, rows).select("id", "label", F.posexplode("leaves").alias("tree", "leaf"))


def gbdt_lr(train: DataFrame, test: DataFrame, setting: bo.Setting = LEAF_TREES, c: float = 0.05) -> DataFrame:
    """(id, label, pred): boosted-tree leaves, one-hot, into a logistic regression whose summed loss counts ``c`` times
    against half the squared weights."""
    model = bo.fit(train, [setting])[0]
    names = [f"t{k}" for k in range(len(model.trees))]

    def spread(rows: DataFrame) -> DataFrame:
        return bo.leaves(model, rows).select("id", "label", *[F.col("leaves")[k].alias(n) for k, n in enumerate(names)])

    encode = OneHotEncoder(inputCols=names, outputCols=[f"{n}_v" for n in names], handleInvalid="keep", dropLast=False)
    pack = VectorAssembler(inputCols=[f"{n}_v" for n in names], outputCol="features")
    rows = hold(spread(bo.dealt(train, train.count())))
    linear = LogisticRegression(regParam=1 / (c * max(rows.count(), 1)), standardization=False, maxIter=100)
    return probability(Pipeline(stages=[encode, pack, linear]).fit(rows).transform(spread(test)))


def select_from_linear(train: DataFrame) -> DataFrame:
    """(feature, coef, kept): kept where |coef| is at least the mean |coef|."""
    model = LogisticRegression(maxIter=30, regParam=0.01).fit(train)
    coefs = model.coefficients.toArray()
    cut = float(np.mean(np.abs(coefs)))
    rows = [(i, float(c), bool(abs(c) >= cut)) for i, c in enumerate(coefs)]
    return train.sparkSession.createDataFrame(rows, "feature INT, coef DOUBLE, kept BOOLEAN")


def select_from_forest(train: DataFrame, limit: float = 0.05, trees: int = 10) -> DataFrame:
    """(feature, importance, kept): kept where the forest importance reaches ``limit``."""
    model = RandomForestClassifier(numTrees=trees, maxDepth=4, seed=9).fit(train)
    values = model.featureImportances.toArray()
    rows = [(i, float(v), bool(v >= limit)) for i, v in enumerate(values)]
    return train.sparkSession.createDataFrame(rows, "feature INT, importance DOUBLE, kept BOOLEAN")


def oof_predictions(train: DataFrame, test: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """(out-of-fold predictions of the training rows, mean of the fold models on the test rows)."""
    folds = hold(stratified_folds(train, "id", "label", k))
    outs, tests = [], []
    for fold in range(k):
        model = LogisticRegression(maxIter=20).fit(folds.where(F.col("fold") != fold))
        outs.append(probability(model.transform(folds.where(F.col("fold") == fold))).withColumn("fold", F.lit(fold)))
        tests.append(probability(model.transform(test)))
    out, extra = outs[0], tests[0]
    for more in outs[1:]:
        out = out.unionByName(more)
    for more in tests[1:]:
        extra = extra.unionByName(more)
    return out, extra.groupBy("id").agg(F.avg("pred").alias("pred"))


def ctcvr_model(rows: DataFrame) -> DataFrame:
    """(id, ctr, cvr, ctcvr): P(click), P(convert | click) and their product.

    ``rows`` is (id, click, convert, features); the second model sees clicked rows only.
    """
    click = LogisticRegression(labelCol="click", maxIter=20).fit(rows)
    convert = LogisticRegression(labelCol="convert", maxIter=20).fit(rows.where(F.col("click") == 1))
    first = click.transform(rows).select("id", "features", vector_to_array("probability")[1].alias("ctr"))
    both = convert.transform(first).select("id", "ctr", vector_to_array("probability")[1].alias("cvr"))
    return both.withColumn("ctcvr", F.col("ctr") * F.col("cvr"))


def funnel(log: DataFrame, key: str, click: Column, convert: Column) -> DataFrame:
    """(key, ctr, cvr, ctcvr) counted from logged flags; NULL cvr without clicks."""
    totals = log.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(click.cast("int")).alias("c"), F.sum(convert.cast("int")).alias("v"))
    ctr = F.col("c") / F.col("n")
    cvr = F.when(F.col("c") > 0, F.col("v") / F.col("c"))
    return totals.select(key, ctr.alias("ctr"), cvr.alias("cvr"), (ctr * F.coalesce(cvr, F.lit(0.0))).alias("ctcvr"))


def pairwise_statistics(rows: DataFrame, group: str, features: list[str]) -> DataFrame:
    """(part, i, j, x): over all pairs of a positive and a negative row of one group, the sums
    of (x+ - x-)_i ('d') and of (x+ - x-)_i (x+ - x-)_j ('m').

    Expanding the products leaves only per-group sums of x and x x' by label, so the pairs
    are never listed and a huge group is one row after the map side.
    """
    d = len(features)
    sums = []
    for tag, label in (("p", 1), ("q", 0)):
        mine = F.col("label") == label
        sums.append(F.sum(mine.cast("double")).alias(f"n{tag}"))
        for i in range(d):
            sums.append(F.sum(F.when(mine, F.col(features[i])).otherwise(0.0)).alias(f"s{tag}{i}"))
            for j in range(i + 1):
                product = F.col(features[i]) * F.col(features[j])
                sums.append(F.sum(F.when(mine, product).otherwise(0.0)).alias(f"x{tag}{i}_{j}"))
    groups = rows.groupBy(group).agg(*sums)
    cells = []
    for i in range(d):
        first = F.expr(f"nq * sp{i} - np * sq{i}")
        cells.append(F.struct(F.lit("d").alias("part"), F.lit(i).alias("i"), F.lit(0).alias("j"), first.alias("x")))
        for j in range(i + 1):
            second = F.expr(f"nq * xp{i}_{j} + np * xq{i}_{j} - sp{i} * sq{j} - sq{i} * sp{j}")
            cells.append(F.struct(F.lit("m").alias("part"), F.lit(i).alias("i"), F.lit(j).alias("j"), second.alias("x")))
    spread = groups.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    return spread.groupBy("part", "i", "j").agg(F.sum("x").alias("x"))


def pairwise_rank(rows: DataFrame, group: str, features: list[str], ridge: float = 1.0) -> DataFrame:
    """(feature, weight) minimising the squared error of w.(x+ - x-) against 1 over all pairs."""
    d = len(features)
    matrix, vector = np.eye(d) * ridge, np.zeros(d)
    for part, i, j, x in pairwise_statistics(rows, group, features).collect():
        if part == "d":
            vector[i] += x
        else:
            matrix[i, j] += x
            if i != j:
                matrix[j, i] += x
    weights = np.linalg.solve(matrix, vector)
    return rows.sparkSession.createDataFrame(
        [(f, float(w)) for f, w in zip(features, weights)], "feature STRING, weight DOUBLE")


def kmeans_labels(rows: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(id, features, cluster) from (id, features)."""
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return model.transform(rows).select("id", "features", "cluster")


def calinski_harabasz(labelled: DataFrame) -> DataFrame:
    """(ch) = (between / (k - 1)) / (within / (n - k)) of (id, vec, cluster) rows.

    All terms follow from counts, sums and squared sums per cluster and dimension.
    """
    cells = labelled.select("cluster", F.posexplode("vec").alias("dim", "x"))
    sums = cells.groupBy("cluster", "dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    dims = sums.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("m"), F.count(F.lit(1)).alias("k"))
    total = dims.agg(
        F.max("n").alias("n"), F.max("k").alias("k"), F.sum(F.col("q") - F.col("m")).alias("within"),
        F.sum(F.col("m") - F.col("s") * F.col("s") / F.col("n")).alias("between"))
    ch = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("n") - F.col("k")))
    return total.select(ch.alias("ch"))


def cluster_draw(users: DataFrame, inter: DataFrame, n: int = 10) -> DataFrame:
    """(user_id, item_id, rank): ``n`` items from all items of the user's cluster, all if fewer.

    The cluster's items stand in digest order and a user takes ``n`` in a row from a hashed
    start, so a user costs ``n`` rows however many items the cluster has.
    """
    items = inter.select("user_id", "item_id").join(users, "user_id").select("cluster", "item_id").distinct()
    hashed = items.withColumn("_h", key_digest("item_id"))
    numbered = position(hashed, ["cluster"], [F.col("_h"), F.col("item_id")], F.substring("_h", 1, 2), "at", "m")
    sizes = numbered.groupBy("cluster").agg(F.max("m").alias("m"))
    wanted = users.join(sizes, "cluster").select(
        "user_id", "cluster", "m", F.explode(F.sequence(F.lit(1), F.least(F.lit(n), F.col("m")).cast("int"))).alias("rank"))
    wanted = wanted.withColumn("at", F.pmod(hash_int("user_id") + F.col("rank"), F.col("m"))).drop("m")
    return wanted.join(numbered.select("cluster", "at", "item_id"), ["cluster", "at"]).select(
        "user_id", "item_id", F.col("rank").cast("bigint").alias("rank"))
