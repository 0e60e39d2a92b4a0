"""Bandit scores and state over logged events."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.ranking import top_k
from tallyrank.session import hold

GOOD_REWARD, BAD_REWARD, EXPLORE = 0.6, -16.0, 0.25  # fixed values of the linear bandit


def ucb_scores(log: DataFrame, arm: str, reward: str) -> DataFrame:
    """(arm, n, score): mean reward + sqrt(2 ln T / n) with T all pulls; 1 for unpulled arms."""
    total = log.agg(F.count(reward)).scalar()
    arms = log.groupBy(F.col(arm).alias("arm")).agg(F.count(reward).alias("n"), F.avg(reward).alias("mean"))
    bound = F.when(F.col("n") == 0, F.lit(1.0)).otherwise(F.sqrt(2.0 * F.log(total.cast("double")) / F.col("n")))
    return arms.select("arm", "n", (F.coalesce("mean", F.lit(0.0)) + bound).alias("score"))


def linucb_sums(log: DataFrame, arm: str, features: list[str], reward: str) -> DataFrame:
    """(arm, a_i_j ..., b_i ...): sums of x x' (lower half) and reward * x per arm.

    Plain sums, so the same expressions run on a stream, and a hot arm is combined on
    the map side. A = I + the summed half, b as it is.
    """
    d = len(features)
    paid = F.when(F.col(reward) == 1, GOOD_REWARD).otherwise(BAD_REWARD)
    a = [F.sum(F.col(features[i]) * F.col(features[j])).alias(f"a_{i}_{j}") for i in range(d) for j in range(i + 1)]
    b = [F.sum(paid * F.col(features[i])).alias(f"b_{i}") for i in range(d)]
    return log.groupBy(F.col(arm).alias("arm")).agg(*a, *b)


def linucb_state(sums: DataFrame, d: int) -> DataFrame:
    """(arm, part, i, j, x): the entries of A (lower half, identity added) and of b."""
    cells = [
        F.struct(F.lit("A").alias("part"), F.lit(i).alias("i"), F.lit(j).alias("j"),
                 (F.col(f"a_{i}_{j}") + (1.0 if i == j else 0.0)).alias("x"))
        for i in range(d) for j in range(i + 1)]
    cells += [F.struct(F.lit("b").alias("part"), F.lit(i).alias("i"), F.lit(0).alias("j"),
                       F.col(f"b_{i}").alias("x")) for i in range(d)]
    return sums.select("arm", F.explode(F.array(*cells)).alias("_c")).select("arm", "_c.*")


def _solve(d: int):
    def solve(frames):
        for pdf in frames:
            a = np.zeros((len(pdf), d, d))
            for i in range(d):
                for j in range(i + 1):
                    a[:, i, j] = a[:, j, i] = pdf[f"a_{i}_{j}"].to_numpy(float)
            inverse = np.linalg.inv(a + np.eye(d))
            theta = (inverse @ pdf[[f"b_{i}" for i in range(d)]].to_numpy(float)[:, :, None])[:, :, 0]
            yield pd.DataFrame({"arm": pdf["arm"], "theta": list(theta), "inverse": list(inverse.reshape(len(pdf), -1))})

    return solve


def linucb_theta(sums: DataFrame, d: int) -> DataFrame:
    """(arm, theta, inverse): the small systems of a batch of arms solved together."""
    return sums.mapInPandas(_solve(d), "arm string, theta array<double>, inverse array<double>")


def _score_cell(features: list[str]):
    def score(key, contexts: pd.DataFrame, arms: pd.DataFrame) -> pd.DataFrame:
        if contexts.empty or arms.empty:
            return pd.DataFrame({"key": contexts["key"][:0], "arm": arms["arm"][:0], "score": []})
        x = contexts[features].to_numpy(dtype=float)
        d = x.shape[1]
        theta = np.stack(arms["theta"].to_numpy())
        inverse = np.stack(arms["inverse"].to_numpy()).reshape(-1, d, d)
        spread = np.einsum("ni,aij,nj->na", x, inverse, x)
        total = np.round(x @ theta.T + EXPLORE * np.sqrt(np.maximum(spread, 0.0)), 9)
        names = arms["arm"].to_numpy()
        order = np.argsort(names.astype(str), kind="stable")  # ties go to the first arm by name
        best = order[np.argmax(total[:, order], axis=1)]
        return pd.DataFrame({
            "key": contexts["key"].to_numpy(), "arm": names[best], "score": total[np.arange(len(x)), best]})

    return score


def linucb_scores(contexts: DataFrame, key: str, features: list[str], state: DataFrame, block: int = 4096) -> DataFrame:
    """(key, arm, score): the best arm per context by theta.x + 0.25 sqrt(x' A^-1 x).

    Contexts and arms are dealt to blocks; a cell scores its block pair as arrays and
    returns one row per context, and the cells' best rows are merged.
    """
    rows = hold(contexts.select(F.col(key).alias("key"), *features))
    arms = hold(state)
    cblocks, ablocks = max(1, -(-rows.count() // block)), max(1, -(-arms.count() // block))
    left = rows.withColumn("cb", F.pmod(F.xxhash64("key"), F.lit(cblocks)).cast("int")).withColumn(
        "ab", F.explode(F.sequence(F.lit(0), F.lit(ablocks - 1))))
    right = arms.withColumn("ab", F.pmod(F.xxhash64("arm"), F.lit(ablocks)).cast("int")).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(cblocks - 1))))
    kind = rows.schema["key"].dataType.simpleString()
    found = left.groupBy("cb", "ab").cogroup(right.groupBy("cb", "ab")).applyInPandas(
        _score_cell(features), f"key {kind}, arm string, score double")
    best = top_k(found, ["key"], [F.desc("score"), F.asc("arm")], 1).drop("rank")
    return best.withColumnRenamed("key", key)
