"""Ranking, rating and classification metrics.

``recs`` is (user_id, item_id, rank, score) and ``truth`` (user_id, item_id), both
distinct on (user, item). Every metric is a partial aggregate over a (user, item) join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyrank.operators.ranking import position, running_total

KEY = ["user_id", "item_id"]


def _hit_rows(recs: DataFrame, truth: DataFrame) -> DataFrame:
    marked = truth.select(*KEY).withColumn("_t", F.lit(1))
    return recs.join(marked, KEY, "left").withColumn("hit", F.coalesce("_t", F.lit(0))).drop("_t")


def _truth_of_recommended(recs: DataFrame, truth: DataFrame) -> DataFrame:
    return truth.join(recs.select("user_id").distinct(), "user_id", "left_semi")


def precision_at_n(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """All hits over all recommended items."""
    return _hit_rows(recs, truth).agg((F.sum("hit") / F.count(F.lit(1))).alias("precision"))


def recall_at_n(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """All hits over the truth items of the users who got recommendations."""
    total = _truth_of_recommended(recs, truth).agg(F.count(F.lit(1))).scalar()
    return _hit_rows(recs, truth).agg((F.sum("hit") / total).alias("recall"))


def coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    total = items.agg(F.countDistinct("item_id")).scalar()
    return recs.agg((F.countDistinct("item_id") / total).alias("coverage"))


def avg_popularity(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Mean ln(1 + train interactions) of the recommended items, 0 for unknown ones.

    Recommendations are counted per item first, so the join is item by item.
    """
    listed = recs.groupBy("item_id").agg(F.count(F.lit(1)).alias("times"))
    popular = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    rows = listed.join(popular, "item_id", "left").withColumn("p", F.log1p(F.coalesce("n", F.lit(0))))
    return rows.agg((F.sum(F.col("p") * F.col("times")) / F.sum("times")).alias("popularity"))


def distinct_item_ratio(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """Distinct recommended items over distinct truth items."""
    total = truth.agg(F.countDistinct("item_id")).scalar()
    return recs.agg((F.countDistinct("item_id") / total).alias("ratio"))


def rmse(rows: DataFrame, pred: str, actual: str) -> DataFrame:
    """As coded, the root of the squared sum over n, and the true RMSE."""
    squares = F.sum((F.col(pred) - F.col(actual)) * (F.col(pred) - F.col(actual)))
    n = F.count(F.lit(1))
    return rows.agg((F.sqrt(squares) / n).alias("rmse_as_coded"), F.sqrt(squares / n).alias("rmse"))


def mae(rows: DataFrame, pred: str, actual: str) -> DataFrame:
    return rows.agg(F.avg(F.abs(F.col(pred) - F.col(actual))).alias("mae"))


def rmse_observed(rows: DataFrame, pred: str, actual: str) -> DataFrame:
    """True RMSE over the entries with a positive rating."""
    seen = rows.where(F.col(actual) > 0)
    return rmse(seen, pred, actual).select(F.col("rmse").alias("rmse_observed"))


def accuracy(rows: DataFrame, pred: str, label: str) -> DataFrame:
    return rows.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def roc_auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve; ties count one half.

    Rows are first counted per score; the running count of negatives goes over score ranges.
    """
    counts = rows.groupBy(F.col(score).alias("score")).agg(
        F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg")
    )
    below = running_total(
        counts.withColumn("_all", F.lit(0)), ["_all"], [F.col("score")], None, "neg", "upto"
    )
    wins = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") + 0.5 * F.col("neg")))
    return below.agg((wins / (F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def _gini(rows: DataFrame, order: str, actual: str, key: str) -> DataFrame:
    """The sum of cumulative actuals is sum(actual * (n - position)): no running sum needed."""
    keyed = rows.withColumn("_all", F.lit(0))
    numbered = position(keyed, ["_all"], [F.desc(order), F.asc(key)], None, "_pos", "_n")
    n = F.max("_n")
    total = F.sum(actual)
    cumulative = F.sum(F.col(actual) * (F.col("_n") - F.col("_pos"))) / total
    return numbered.agg(((cumulative - (n + 1) / 2.0) / n).alias("gini"))


def gini_normalized(rows: DataFrame, pred: str, actual: str, key: str) -> DataFrame:
    """Gini by predicted order over Gini by actual order, ties in key order."""
    best = _gini(rows, actual, actual, key)
    return _gini(rows, pred, actual, key).select(
        (F.col("gini") / best.select("gini").scalar()).alias("gini_normalized")
    )


def map_at_n(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """Mean over recommended users of sum(hits so far / rank) / truth size, 0 without truth."""
    inside = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = _hit_rows(recs, truth).withColumn("_h", F.sum("hit").over(inside))
    users = rows.groupBy("user_id").agg(F.sum(F.col("hit") * F.col("_h") / F.col("rank")).alias("ap"))
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return users.join(sizes, "user_id", "left").agg(
        F.avg(F.coalesce(F.col("ap") / F.col("n"), F.lit(0.0))).alias("map")
    )


def hr_mrr_ndcg(recs: DataFrame, relevant: DataFrame) -> DataFrame:
    """One relevant item per user: hit, 1 / rank and 1 / log2(rank + 1), averaged over users."""
    found = relevant.select(*KEY).join(recs.select(*KEY, "rank"), KEY, "left")
    return found.agg(
        F.avg(F.col("rank").isNotNull().cast("double")).alias("hr"),
        F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))).alias("mrr"),
        F.avg(F.coalesce(1.0 / F.log2(F.col("rank") + 1.0), F.lit(0.0))).alias("ndcg"),
    )


def rank_hr_ndcg(positives: DataFrame, negatives: DataFrame, k: int = 10) -> DataFrame:
    """position = negatives scoring at least the positive; hit below k; ln 2 / ln(position + 2)."""
    held = positives.select("user_id", F.col("score").alias("_s"))
    above = (
        negatives.join(held, "user_id")
        .groupBy("user_id")
        .agg(F.sum((F.col("score") >= F.col("_s")).cast("bigint")).alias("position"))
    )
    users = positives.select("user_id").join(above, "user_id", "left").na.fill(0, ["position"])
    inside = F.col("position") < k
    gain = F.when(inside, F.log(F.lit(2.0)) / F.log(F.col("position") + 2.0)).otherwise(0.0)
    return users.agg(F.avg(inside.cast("double")).alias("hr"), F.avg(gain).alias("ndcg"))


def recall_ndcg_hit(recs: DataFrame, truth: DataFrame, order: str = "item_id") -> DataFrame:
    """Averages over truth users; gains are indexed by the item's place in the truth list."""
    placed = position(truth, ["user_id"], [F.col(order)], None, "no")
    marked = placed.join(recs.select(*KEY).withColumn("_r", F.lit(1)), KEY, "left")
    users = marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("_r", F.lit(0))).alias("hits"),
        F.sum(F.when(F.col("_r") == 1, 1.0 / F.log2(F.col("no") + 2.0)).otherwise(0.0)).alias("dcg"),
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.col("hits"), F.lit(1)).cast("int")),
        F.lit(0.0), lambda acc, x: acc + 1.0 / F.log2(x + 1.0),
    )
    hit = F.col("hits") > 0
    return users.agg(
        F.avg(F.col("hits") / F.col("n")).alias("recall"),
        F.avg(F.when(hit, F.col("dcg") / ideal).otherwise(0.0)).alias("ndcg"),
        F.avg(hit.cast("double")).alias("hitrate"),
    )


def category_diversity(recs: DataFrame, categories: DataFrame) -> DataFrame:
    """Mean over users of the share of item pairs in a list with different categories.

    Counted from category sizes, 1 - sum c(c-1) / n(n-1), so no pairs are listed.
    """
    counts = recs.join(categories, "item_id").groupBy("user_id", "category").agg(
        F.count(F.lit(1)).alias("c"))
    users = counts.groupBy("user_id").agg(
        F.sum(F.col("c") * (F.col("c") - 1)).alias("same"), F.sum("c").alias("n"))
    share = 1 - F.col("same") / (F.col("n") * (F.col("n") - 1))
    return users.where(F.col("n") > 1).agg(F.avg(share).alias("diversity"))


def user_auc(positives: DataFrame, unseen: DataFrame) -> DataFrame:
    """Mean over users of the share of unseen items scored below the held-out item."""
    held = positives.select("user_id", F.col("score").alias("_s"))
    users = unseen.join(held, "user_id").groupBy("user_id").agg(
        F.avg((F.col("score") < F.col("_s")).cast("double")).alias("auc"))
    return users.agg(F.avg("auc").alias("user_auc"))


def recall_macro(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """Mean per-user recall and the share of users with a hit."""
    marked = truth.select(*KEY).join(recs.select(*KEY).withColumn("_r", F.lit(1)), KEY, "left")
    users = marked.groupBy("user_id").agg(
        F.avg(F.coalesce("_r", F.lit(0)).cast("double")).alias("recall"))
    return users.agg(
        F.avg("recall").alias("recall"), F.avg((F.col("recall") > 0).cast("double")).alias("hitrate"))


def fold_mean_std(folds: DataFrame, score: str) -> DataFrame:
    return folds.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))


def novelty_report(recs: DataFrame, truth: DataFrame, train: DataFrame) -> DataFrame:
    """One row: precision, recall, coverage, popularity."""
    return precision_at_n(recs, truth).select(
        "precision",
        recall_at_n(recs, truth).scalar().alias("recall"),
        coverage(recs, train).scalar().alias("coverage"),
        avg_popularity(recs, train).scalar().alias("popularity"),
    )


def precision_fixed_n(recs: DataFrame, truth: DataFrame, train: DataFrame, n: int = 10) -> DataFrame:
    """Hits over n * train users, recall over the train users' truth, coverage of train items."""
    users = train.select("user_id").distinct()
    asked = users.agg(F.count(F.lit(1))).scalar()
    wanted = truth.join(users, "user_id", "left_semi").agg(F.count(F.lit(1))).scalar()
    items = train.agg(F.countDistinct("item_id")).scalar()
    return _hit_rows(recs, truth).agg(
        (F.sum("hit") / (F.lit(float(n)) * asked)).alias("precision"),
        (F.sum("hit") / wanted).alias("recall"),
        (F.countDistinct("item_id") / items).alias("coverage"),
    )
