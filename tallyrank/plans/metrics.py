"""Evaluation queries.

Most run on the customer x brand ratings, split by hash, where held-out items are
actually recommended: lists come from item-based filtering and scores from the
similarity-weighted prediction, both on the train part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_int, hash_prefix
from tallyrank.operators import metrics as m
from tallyrank.operators import neighbours as nb
from tallyrank.operators.splits import random_items
from tallyrank.plans.neighbours import BRAND_PREDICT, ITEM_RECS, TOP_N, _sim_views
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.session import hold

query = REGISTRY.query


def _split(t):
    below = hash_prefix("user_id", "item_id") < "b3"
    return t.brand_ratings.where(below), t.brand_ratings.where(~below)


def _lists(t):
    train, test = _split(t)
    return hold(nb.item_cf_recommend(train, nb.item_similarity(train))), test, train


def _scored_test(t):
    """Held-out ratings with their prediction, rounded so both engines see equal ties."""
    train, test = _split(t)
    pred = nb.predict_by_items(train).withColumn("pred", F.round("pred", 6))
    return test.join(pred, ["user_id", "item_id"])


def _held_and_unseen(t):
    """Scores of one held-out brand per user and of the brands the user never bought."""
    train, test = _split(t)
    pred = hold(nb.predict_by_items(train).select("user_id", "item_id", F.round("pred", 6).alias("score")))
    held = random_items(test).select("user_id", "item_id").join(pred, ["user_id", "item_id"])
    unseen = pred.join(t.brand_ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return held, unseen


SPLIT = {
    "train": "SELECT * FROM brand WHERE substr(md5(concat(user_id, '-', item_id)), 1, 2) < 'b3'",
    "test": "SELECT * FROM brand WHERE substr(md5(concat(user_id, '-', item_id)), 1, 2) >= 'b3'",
}
LISTS = {**SPLIT, **_sim_views("item_id", False), "scored": ITEM_RECS, "recs": TOP_N.format(n=10),
         "hits": "SELECT r.*, CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS hit FROM recs r LEFT JOIN test t USING (user_id, item_id)"}
SCORES = {
    **SPLIT,
    **{k: v.replace("FROM brand", "FROM train") for k, v in BRAND_PREDICT.items()},
    "p": "SELECT user_id, item_id, round(pred, 6) AS pred FROM pred",
    "rated": "SELECT t.user_id, t.item_id, t.rating, p.pred FROM test t JOIN p USING (user_id, item_id)",
}
SCORES["sim"] = SCORES["sim"].replace("JOIN brand", "JOIN train")
HELD = {
    **SCORES,
    "held": """SELECT h.user_id, h.item_id, p.pred AS score FROM (SELECT *, row_number() OVER (
                 PARTITION BY user_id ORDER BY md5(concat(user_id, '-', item_id)), item_id) AS r FROM test) h
               JOIN p USING (user_id, item_id) WHERE r = 1""",
    "unseen": "SELECT p.user_id, p.item_id, p.pred AS score FROM p ANTI JOIN brand b USING (user_id, item_id)",
}


def _round_all(df):
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query("precision_at_n", with_views("brand", "SELECT round(sum(hit) / count(*), 6) AS precision FROM hits", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.precision_at_n(recs, test))


@query("recall_at_n", with_views("brand", """
    SELECT round(sum(hit) / (SELECT count(*) FROM test WHERE user_id IN (SELECT user_id FROM recs)), 6) AS recall
    FROM hits""", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.recall_at_n(recs, test))


@query("coverage", with_views("brand", """
    SELECT round(count(DISTINCT item_id) / CAST((SELECT count(DISTINCT item_id) FROM train) AS DOUBLE), 6) AS coverage
    FROM recs""", **LISTS))
def _(t):
    recs, _test, train = _lists(t)
    return _round_all(m.coverage(recs, train))


@query("avg_popularity", with_views("brand", """
    SELECT round(avg(ln(1 + coalesce(n, 0))), 6) AS popularity FROM recs
    LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) USING (item_id)""", **LISTS))
def _(t):
    recs, _test, train = _lists(t)
    return _round_all(m.avg_popularity(recs, train))


@query("distinct_item_ratio", with_views("brand", """
    SELECT round(count(DISTINCT item_id) / CAST((SELECT count(DISTINCT item_id) FROM test) AS DOUBLE), 6) AS ratio
    FROM recs""", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.distinct_item_ratio(recs, test))


@query("rmse_as_coded", with_views("brand", """
    SELECT round(sqrt(sum((pred - rating) * (pred - rating))) / count(*), 6) AS rmse_as_coded,
           round(sqrt(avg((pred - rating) * (pred - rating))), 6) AS rmse FROM rated""", **SCORES))
def _(t):
    return _round_all(m.rmse(_scored_test(t), "pred", "rating"))


@query("mae", with_views("brand", "SELECT round(avg(abs(pred - rating)), 6) AS mae FROM rated", **SCORES))
def _(t):
    return _round_all(m.mae(_scored_test(t), "pred", "rating"))


@query("rmse_observed", with_views("brand", """
    SELECT round(sqrt(avg((pred - rating) * (pred - rating))), 6) AS rmse_observed FROM rated WHERE rating > 0""", **SCORES))
def _(t):
    return _round_all(m.rmse_observed(_scored_test(t), "pred", "rating"))


def _labelled(t):
    rows = _scored_test(t)
    return rows.withColumn("label", (F.col("rating") >= 4).cast("int")).withColumn(
        "guess", (F.col("pred") >= 2).cast("int"))


@query("accuracy", with_views("brand", """
    SELECT round(avg(CASE WHEN (pred >= 2) = (rating >= 4) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rated""", **SCORES))
def _(t):
    return _round_all(m.accuracy(_labelled(t), "guess", "label"))


@query("roc_auc", with_views("brand", """
    SELECT round((sum(CASE WHEN rating >= 4 THEN avg_rank ELSE 0 END) - p * (p + 1) / 2.0) / (p * n), 6) AS auc
    FROM ranked, (SELECT CAST(sum(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS DOUBLE) AS p,
                         CAST(sum(CASE WHEN rating >= 4 THEN 0 ELSE 1 END) AS DOUBLE) AS n FROM rated)
    GROUP BY p, n""", **SCORES,
    ranked="""SELECT rating, (rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0) AS avg_rank
              FROM rated"""))
def _(t):
    return _round_all(m.roc_auc(_labelled(t), "pred", "label"))


@query("gini_normalized", with_views("brand", """
    SELECT round(((SELECT sum(c) FROM by_pred) / s - (n + 1) / 2.0) / ((SELECT sum(c) FROM by_act) / s - (n + 1) / 2.0), 6)
           AS gini_normalized FROM (SELECT sum(rating) AS s, count(*) AS n FROM rated)""", **SCORES,
    by_pred="""SELECT sum(rating) OVER (ORDER BY pred DESC, concat(user_id, '-', item_id)
               ROWS UNBOUNDED PRECEDING) AS c FROM rated""",
    by_act="""SELECT sum(rating) OVER (ORDER BY rating DESC, concat(user_id, '-', item_id)
              ROWS UNBOUNDED PRECEDING) AS c FROM rated"""))
def _(t):
    rows = hold(_scored_test(t).withColumn("key", F.concat_ws("-", "user_id", "item_id")))
    return _round_all(m.gini_normalized(rows, "pred", "rating", "key"))


@query("map_at_n", with_views("brand", """
    SELECT round(avg(coalesce(ap / n, 0)), 6) AS map FROM (
      SELECT user_id, sum(hit * h / CAST(rank AS DOUBLE)) AS ap FROM (
        SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank) AS h FROM hits) GROUP BY 1)
    LEFT JOIN (SELECT user_id, count(*) AS n FROM test GROUP BY 1) USING (user_id)""", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.map_at_n(recs, test))


@query("hr_mrr_ndcg", with_views("brand", """
    SELECT round(avg(CASE WHEN rank IS NULL THEN 0.0 ELSE 1.0 END), 6) AS hr,
           round(avg(coalesce(1.0 / rank, 0)), 6) AS mrr, round(avg(coalesce(1.0 / log2(rank + 1), 0)), 6) AS ndcg
    FROM one LEFT JOIN recs USING (user_id, item_id)""", **LISTS,
    one="""SELECT user_id, item_id FROM (SELECT *, row_number() OVER (
             PARTITION BY user_id ORDER BY md5(concat(user_id, '-', item_id)), item_id) AS r FROM test) WHERE r = 1"""))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.hr_mrr_ndcg(recs, random_items(test)))


@query("rank_hr_ndcg", with_views("brand", """
    SELECT round(avg(CASE WHEN position < 3 THEN 1.0 ELSE 0.0 END), 6) AS hr,
           round(avg(CASE WHEN position < 3 THEN ln(2.0) / ln(position + 2) ELSE 0.0 END), 6) AS ndcg FROM (
      SELECT h.user_id, count(u.score) AS position FROM held h
      LEFT JOIN unseen u ON u.user_id = h.user_id AND u.score >= h.score GROUP BY 1)""", **HELD))
def _(t):
    held, unseen = _held_and_unseen(t)
    return _round_all(m.rank_hr_ndcg(held, unseen, 3))


@query("recall_ndcg_hit_multi", with_views("brand", """
    SELECT round(avg(hits / CAST(n AS DOUBLE)), 6) AS recall,
           round(avg(CASE WHEN hits > 0 THEN dcg / (SELECT sum(1 / log2(k + 1)) FROM generate_series(1, 10) g(k)
                     WHERE k <= hits) ELSE 0 END), 6) AS ndcg,
           round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hitrate
    FROM (SELECT user_id, count(*) AS n, count(r) AS hits, sum(CASE WHEN r IS NULL THEN 0 ELSE 1 / log2(no + 2) END) AS dcg
          FROM (SELECT t.user_id, recs.rank AS r, row_number() OVER (PARTITION BY t.user_id ORDER BY t.item_id) - 1 AS no
                FROM test t LEFT JOIN recs USING (user_id, item_id)) GROUP BY 1)""", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.recall_ndcg_hit(recs, test))


@query("category_diversity", with_views("train catalogue", """
    SELECT round(avg(d), 6) AS diversity FROM (
      SELECT user_id, 1 - sum(c * (c - 1)) / CAST(sum(c) * (sum(c) - 1) AS DOUBLE) AS d FROM (
        SELECT user_id, category, count(*) AS c FROM recs JOIN catalogue USING (item_id) GROUP BY 1, 2)
      GROUP BY 1 HAVING sum(c) > 1)""", **_sim_views("item_id", False), scored=ITEM_RECS, recs=TOP_N.format(n=10)))
def _(t):
    recs = nb.item_cf_recommend(t.train, nb.item_similarity(t.train))
    return _round_all(m.category_diversity(recs, t.item_category))


@query("user_auc", with_views("brand", """
    SELECT round(avg(a), 6) AS user_auc FROM (
      SELECT h.user_id, avg(CASE WHEN u.score < h.score THEN 1.0 ELSE 0.0 END) AS a
      FROM held h JOIN unseen u ON u.user_id = h.user_id GROUP BY 1)""", **HELD))
def _(t):
    held, unseen = _held_and_unseen(t)
    return _round_all(m.user_auc(held, unseen))


@query("recall_n", with_views("brand", """
    SELECT round(avg(r), 6) AS recall, round(avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END), 6) AS hitrate FROM (
      SELECT t.user_id, avg(CASE WHEN recs.rank IS NULL THEN 0.0 ELSE 1.0 END) AS r
      FROM test t LEFT JOIN recs USING (user_id, item_id) GROUP BY 1)""", **LISTS))
def _(t):
    recs, test, _train = _lists(t)
    return _round_all(m.recall_macro(recs, test))


@query("cv_mean_std", with_views("brand", """
    SELECT round(avg(a), 6) AS mean, round(stddev_pop(a), 6) AS std FROM (
      SELECT CAST('0x' || substr(md5(concat(user_id, '-', item_id)), 1, 8) AS BIGINT) % 3 AS fold,
             avg(CASE WHEN (pred >= 2) = (rating >= 4) THEN 1.0 ELSE 0.0 END) AS a FROM rated GROUP BY 1)""", **SCORES))
def _(t):
    rows = _labelled(t).withColumn("fold", F.pmod(hash_int("user_id", "item_id"), F.lit(3)))
    folds = rows.groupBy("fold").agg(F.avg((F.col("guess") == F.col("label")).cast("double")).alias("score"))
    return _round_all(m.fold_mean_std(folds, "score"))


REPORT = """SELECT round({hits} / CAST({asked} AS DOUBLE), 6) AS precision,
    round({hits} / CAST((SELECT count(*) FROM test WHERE user_id IN (SELECT user_id FROM {users})) AS DOUBLE), 6) AS recall,
    round((SELECT count(DISTINCT item_id) FROM recs) / CAST((SELECT count(DISTINCT item_id) FROM train) AS DOUBLE), 6) AS coverage"""
N_HITS = "(SELECT count(*) FROM recs JOIN test USING (user_id, item_id))"


@query("novelty_report", with_views("train test", REPORT.format(
    hits=N_HITS, asked="(SELECT count(*) FROM recs)", users="recs") + """,
    (SELECT round(avg(ln(1 + n)), 6) FROM recs JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) USING (item_id))
    AS popularity""", **_sim_views("item_id", False), scored=ITEM_RECS, recs=TOP_N.format(n=10)))
def _(t):
    recs = hold(nb.item_cf_recommend(t.train, nb.item_similarity(t.train)))
    return _round_all(m.novelty_report(recs, t.test, t.train))


@query("precision_fixed_n", with_views("brand", REPORT.format(
    hits=N_HITS, asked="(SELECT 10 * count(DISTINCT user_id) FROM train)", users="train"), **LISTS))
def _(t):
    recs, test, train = _lists(t)
    return _round_all(m.precision_fixed_n(recs, test, train, 10))
