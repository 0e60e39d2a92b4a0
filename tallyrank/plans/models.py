"""Factor models, sparse linear models, clusters and supervised models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_prefix
from tallyrank.operators import blockwise as bw
from tallyrank.operators import boosting as bo
from tallyrank.operators import clusters as cl
from tallyrank.operators import factor as fa
from tallyrank.operators import learning as ln
from tallyrank.operators import sampling as sp
from tallyrank.operators import slim
from tallyrank.operators import vectors as vec
from tallyrank.operators.splits import last_items
from tallyrank.plans import chains
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.plans.sequences import DRAWS, IDX, KEEP, LAST, TRIES
from tallyrank.session import hold

query = REGISTRY.query


def _entries(df):
    return df.select(F.col("user_id").alias("row"), F.col("item_id").alias("col"), F.col("rating").alias("x"))


def _long(side, factors, k):
    return factors.select(F.lit(side).alias("side"), F.col("id").cast("string").alias("id"),
                          F.posexplode(F.array(*fa.names(k))).alias("dim", "x"))


def _both(left, right, k):
    return _long("user", left, k).unionByName(_long("item", right, k)).withColumn("x", F.round("x", 6))


ENTRIES = "SELECT user_id AS row, item_id AS col, rating AS x FROM {}"
ALS = chains.als(10, ENTRIES.format("train"))
MF = chains.gradient(5, ENTRIES.format("train"), 10, 0.01, 0.02, False)
BIASED = chains.gradient(5, ENTRIES.format("train"), 10, 0.01, 0.02, True)
NMF = chains.nmf(10, ENTRIES.format("brand"))
BPR = {
    "idx": IDX, "held": LAST, "pos": "SELECT user_id, item_id FROM inter ANTI JOIN held USING (user_id, item_id)",
    "tries": TRIES.format(src="pos", last=35), "draws": DRAWS,
    **chains.bpr(4, f"SELECT user_id, item_id, neg FROM ({KEEP.format(src='draws', n=1)})", 10, 0.05, 1e-4),
}
DOT = " + ".join(f"u.f{d} * v.f{d}" for d in range(10))


def _recs(left, right, seen, k, n=10):
    users, items = fa.scoring_vectors(left, right, k)
    recs = vec.best_unseen_by_vectors(users, items, seen, n)
    return recs.select("user_id", "item_id", "rank", F.round("score", 6).alias("score"))


@query("als_zero_imputed", with_views("train", chains.both_sides(10, 3), **ALS))
def _(t):
    return _both(*fa.als_zero_imputed(_entries(t.train), 3, 10), 3)


@query("als_recommend", with_views("train", chains.top_items(10, 3, 10, "train", False, "user_id", "item_id"), **ALS))
def _(t):
    left, right = fa.als_zero_imputed(_entries(t.train), 3, 10)
    return _recs(left, right, t.train, 3)


@query("als_mllib")
def _(t):
    return fa.als_mllib(t.train)


@query("mf_gradient", with_views("train", chains.both_sides(5, 10), **MF))
def _(t):
    left, right, _mean = fa.mf_gradient(_entries(t.train), 10, 5)
    return _both(left, right, 10)


@query("mf_gradient_biased", with_views("train test", f"""
    SELECT t.user_id AS row, t.item_id AS col, t.rating AS x, round(least(greatest(c + u.bias + v.bias + {DOT}, 1), 5), 6) AS pred
    FROM test t JOIN u5 u ON u.id = t.user_id JOIN v5 v ON v.id = t.item_id, center""", **BIASED))
def _(t):
    left, right, mean = fa.mf_gradient(_entries(t.train), 10, 5, biased=True)
    scored = fa.predict_entries(_entries(t.test), left, right, 10, mean, 1.0, 5.0)
    return scored.withColumn("pred", F.round("pred", 6))


@query("mf_gradient_recommend", with_views("train", chains.top_items(5, 10, 10, None, True, "query", "id"), **BIASED))
def _(t):
    left, right, _mean = fa.mf_gradient(_entries(t.train), 10, 5, biased=True)
    users, items = fa.scoring_vectors(left, right, 10)
    found = vec.nearest(users.withColumnRenamed("user_id", "query"), items, 10)
    return found.select("query", "id", "rank", F.round("score", 6).alias("score"))


def _biased_blocks(t):
    return bw.mf_blocks(_entries(t.train), 50, 30, 0.05, 0.15, mean=2.5, low=1.0, high=5.0)


@query("mf_sgd")
def _(t):
    left, right, _mean = bw.mf_blocks(_entries(t.train), 10, 30, 0.01, 0.02, biased=False)
    return _both(left, right, 10)


@query("mf_biased")
def _(t):
    left, right, mean = _biased_blocks(t)
    scored = fa.predict_entries(_entries(t.test), left, right, 50, mean, 1.0, 5.0)
    return scored.withColumn("pred", F.round("pred", 6))


@query("mf_recommend")
def _(t):
    left, right, _mean = _biased_blocks(t)
    users, items = fa.scoring_vectors(left, right, 50)
    found = vec.nearest(users.withColumnRenamed("user_id", "query"), items, 10)
    return found.select("query", "id", "rank", F.round("score", 6).alias("score"))


@query("mf_fit", with_views("train", """
    SELECT count(*) AS n, TRUE AS below_spread, TRUE AS below_gradient FROM train"""))
def _(t):
    """Whether block updates fit their ratings better than the mean and than whole gradients in as many rounds."""
    entries = hold(_entries(t.train))

    def loss(left, right, mean):
        scored = fa.predict_entries(entries, left, right, 10, mean, 1.0, 5.0)
        return scored.agg(F.count("x").alias("n"), F.avg((F.col("x") - F.col("pred")) ** 2).alias("loss"), F.var_pop("x").alias("spread"))

    blocks = loss(*bw.mf_blocks(entries, 10, 5, low=1.0, high=5.0))
    whole = loss(*fa.mf_gradient(entries, 10, 5, 0.05, 0.15, biased=True)).select(F.col("loss").alias("whole"))
    return blocks.join(whole).select(
        "n", (F.col("loss") < F.col("spread")).alias("below_spread"), (F.col("loss") < F.col("whole")).alias("below_gradient"))


@query("bpr_mf", with_views("inter", chains.both_sides(4, 10), **BPR))
def _(t):
    triples = sp.bpr_triples(t.interactions, last_items(t.interactions), t.item_category)
    users, items = fa.bpr_factors(triples, 10, 4)
    return _both(users, items, 10)


@query("truncated_svd")
def _(t):
    entries = _entries(t.brand_ratings)
    left, right, values = fa.subspace_svd(entries, 15)
    scaled = left.select("id", *[(F.col(f"f{d}") * values[d]).alias(f"f{d}") for d in range(15)])
    return fa.predict_entries(entries, scaled, right, 15)


@query("nmf", with_views("brand", chains.both_sides(10, 2), **NMF))
def _(t):
    return _both(*fa.nmf(_entries(t.brand_ratings), 2, 10), 2)


@query("slim_weights")
def _(t):
    return slim.slim_weights(t.interactions)


@query("slim_recommend")
def _(t):
    return slim.slim_recommend(t.train, slim.slim_weights(t.train), 10)


@query("slim_optimality", with_views("inter", """
    SELECT t, round(0.02 * max(n), 6) AS b, TRUE AS proven FROM (
      SELECT x.item_id AS t, y.item_id AS j, count(*) AS n FROM inter x JOIN inter y USING (user_id)
      WHERE x.item_id <> y.item_id GROUP BY 1, 2) GROUP BY 1"""))
def _(t):
    """Every column of the weights meets its optimality conditions to within the tolerance, by sums of their own."""
    found = slim.slim_optimality(t.interactions, slim.slim_weights(t.interactions))
    return found.select("t", F.round("b", 6).alias("b"), (F.col("distance") <= 1e-3).alias("proven"))


# ---- clusters ----------------------------------------------------------------------


def _user_rows(t):
    users = t.customer.withColumn("zone", F.col("c_nationkey").cast("string"))
    return ln.assemble(users.withColumn("one", F.lit(0.0)), "c_custkey", None, ["one"], ["c_mktsegment", "zone"]).drop("label")


KS = tuple(range(50, 200, 10))


def _user_points(t):
    users = t.customer.select("c_custkey", (F.col("c_acctbal") / 1e4).alias("balance"), "c_mktsegment",
                              F.col("c_nationkey").cast("string").alias("zone"))
    return ln.assemble(users, "c_custkey", None, ["balance"], ["c_mktsegment", "zone"]).drop("label")


@query("kmeans_quality")
def _(t):
    return cl.kmeans_quality(_user_points(t), KS)


@query("kmeans_progress", "SELECT CAST(k AS INTEGER) AS k, TRUE AS settled, TRUE AS falling FROM range(50, 200, 10) r(k)")
def _(t):
    """Whether each k's centres settled and no round raised the squared distances."""
    sweep = cl.kmeans_sweep(_user_points(t), KS)
    rows = []
    for k in KS:
        steps = sweep.within[k]
        rows.append((k, sweep.settled[k], all(b <= a * (1 + 1e-9) + 1e-9 for a, b in zip(steps, steps[1:]))))
    return t.spark.createDataFrame(rows, "k INT, settled BOOLEAN, falling BOOLEAN")


@query("calinski_harabasz", """
    WITH v AS (SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS dim,
                      CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
    c AS (SELECT label, dim, avg(x) AS m, count(*) AS n FROM v GROUP BY 1, 2),
    a AS (SELECT dim, avg(x) AS m FROM v GROUP BY 1),
    w AS (SELECT sum(pow(v.x - c.m, 2)) AS within FROM v JOIN c USING (label, dim)),
    b AS (SELECT sum(c.n * pow(c.m - a.m, 2)) AS between_ FROM c JOIN a USING (dim)),
    s AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)
    SELECT round((between_ / (k - 1)) / (within / (n - k)), 6) AS ch FROM w, b, s""")
def _(t):
    rows = t.embeddings.select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        F.col("label").alias("cluster"))
    return ln.calinski_harabasz(rows).select(F.round("ch", 6).alias("ch"))


@query("cluster_recommend")
def _(t):
    users = ln.kmeans_labels(_user_rows(t), 8).select(F.col("id").alias("user_id"), "cluster")
    return ln.cluster_draw(hold(users), t.interactions, 10)


@query("cluster_draw", with_views("inter", """
    SELECT w.user_id, l.item_id, w.rank FROM (
      SELECT u.user_id, u.cluster, r AS rank, (CAST('0x' || substr(md5(CAST(u.user_id AS VARCHAR)), 1, 8) AS BIGINT) + r) % s.m AS at
      FROM u JOIN (SELECT cluster, count(*) AS m FROM items GROUP BY 1) s USING (cluster), generate_series(1, 10) g(r) WHERE r <= s.m) w
    JOIN listed l ON l.cluster = w.cluster AND l.at = w.at""",
    u="SELECT c_custkey AS user_id, c_mktsegment AS cluster FROM customer",
    items="SELECT DISTINCT cluster, item_id FROM inter JOIN u USING (user_id)",
    listed="""SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY md5(CAST(item_id AS VARCHAR)), item_id) - 1 AS at
              FROM items"""))
def _(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("cluster"))
    return ln.cluster_draw(users, t.interactions, 10)


# ---- supervised --------------------------------------------------------------------


def _examples(t):
    """Orders with customer attributes; the label is a finished order."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("o_totalprice") / 1e5).alias("price"), (F.month("o_orderdate") / 12.0).alias("month"),
        (F.col("c_acctbal") / 1e4).alias("balance"), "o_orderpriority", "c_mktsegment",
        (F.col("o_orderstatus") == "F").alias("done"))
    whole = hold(ln.assemble(rows, "o_orderkey", F.col("done"), ["price", "month", "balance"],
                             ["o_orderpriority", "c_mktsegment"]))
    chosen = hash_prefix("id") < "cc"
    return whole.where(chosen), whole.where(~chosen)


def _model(name, fn):
    @query(name)
    def _(t):
        return fn(*_examples(t))


_model("fm_classifier", ln.fm_classifier)
_model("logistic_wide", ln.logistic_wide)
_model("gbdt", ln.gbdt)
_model("gbdt_lr", ln.gbdt_lr)
_model("gbdt_leaf_features", lambda train, test: ln.gbdt_leaf_features(train, train.unionByName(test)))
_model("select_from_linear", lambda train, test: ln.select_from_linear(train))
_model("select_from_forest", lambda train, test: ln.select_from_forest(train))
_model("oof_predictions", lambda train, test: ln.oof_predictions(train, test)[0].select("id", "fold", "pred"))
_model("oof_test_mean", lambda train, test: ln.oof_predictions(train, test)[1])

@query("gbdt_loss", "SELECT CAST(range AS INTEGER) AS tree, TRUE AS falling FROM range(1, 31) WHERE EXISTS (SELECT 1 FROM orders)")
def _(t):
    """Whether the training loss falls with each of the first thirty trees of gbdt_lr."""
    train, _test = _examples(t)
    models = bo.fit(train, [replace(ln.LEAF_TREES, trees=30)])
    rows = bo.progress(models, train).where(~F.col("held")).select("tree", (F.col("loss") / F.col("n")).alias("loss"))
    before = F.lag("loss").over(Window.partitionBy(F.lit(0)).orderBy("tree"))  # 31 rows
    return rows.withColumn("falling", F.col("loss") < before).where("tree > 0").select("tree", "falling")


PAIR_FEATURES = ["price", "month"]


def _pair_rows(t):
    return t.orders.select(
        "o_custkey", (F.col("o_totalprice") / 1e5).alias("price"), (F.month("o_orderdate") / 12.0).alias("month"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"))


@query("pairwise_statistics", """
    WITH rows AS (SELECT o_custkey AS g, o_totalprice / 1e5 AS x0, month(o_orderdate) / 12.0 AS x1,
                         o_orderstatus = 'F' AS y FROM orders),
    pairs AS MATERIALIZED (SELECT p.x0 - q.x0 AS d0, p.x1 - q.x1 AS d1 FROM rows p JOIN rows q ON p.g = q.g AND p.y AND NOT q.y)
    SELECT 'd' AS part, 0 AS i, 0 AS j, round(sum(d0), 4) AS x FROM pairs
    UNION ALL SELECT 'd', 1, 0, round(sum(d1), 4) FROM pairs UNION ALL SELECT 'm', 0, 0, round(sum(d0 * d0), 4) FROM pairs
    UNION ALL SELECT 'm', 1, 0, round(sum(d1 * d0), 4) FROM pairs UNION ALL SELECT 'm', 1, 1, round(sum(d1 * d1), 4) FROM pairs""")
def _(t):
    return ln.pairwise_statistics(_pair_rows(t), "o_custkey", PAIR_FEATURES).withColumn("x", F.round("x", 4))


@query("pairwise_rank", """
    WITH rows AS (SELECT o_custkey AS g, o_totalprice / 1e5 AS x0, month(o_orderdate) / 12.0 AS x1,
                         o_orderstatus = 'F' AS y FROM orders),
    pairs AS MATERIALIZED (SELECT p.x0 - q.x0 AS d0, p.x1 - q.x1 AS d1 FROM rows p JOIN rows q ON p.g = q.g AND p.y AND NOT q.y),
    s AS (SELECT sum(d0 * d0) + 1 AS a, sum(d0 * d1) AS b, sum(d1 * d1) + 1 AS c, sum(d0) AS u, sum(d1) AS v FROM pairs)
    SELECT unnest(['price', 'month']) AS feature,
           round(unnest([(c * u - b * v) / (a * c - b * b), (a * v - b * u) / (a * c - b * b)]), 6) AS weight FROM s""")
def _(t):
    return ln.pairwise_rank(_pair_rows(t), "o_custkey", PAIR_FEATURES).withColumn("weight", F.round("weight", 6))


@query("ctcvr_compose", """
    SELECT user_id, round(c / CAST(n AS DOUBLE), 6) AS ctr, round(v / nullif(CAST(c AS DOUBLE), 0), 6) AS cvr,
           round(c / CAST(n AS DOUBLE) * coalesce(v / nullif(CAST(c AS DOUBLE), 0), 0), 6) AS ctcvr FROM (
      SELECT user_id, count(*) AS n, sum(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END) AS c,
             sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS v FROM events GROUP BY 1)""")
def _(t):
    rows = ln.funnel(t.events, "user_id", F.col("event_type").isin("click", "purchase"), F.col("event_type") == "purchase")
    return rows.select("user_id", *[F.round(c, 6).alias(c) for c in ("ctr", "cvr", "ctcvr")])


@query("ctcvr_model")
def _(t):
    rows = t.events.select(
        "event_id", F.col("event_type").isin("click", "purchase").cast("double").alias("click"),
        (F.col("event_type") == "purchase").cast("double").alias("convert"),
        (F.col("value") / 100).alias("v"), (F.hour("ts") / 24.0).alias("h"))
    packed = VectorAssembler(inputCols=["v", "h"], outputCol="features").transform(rows)
    return ln.ctcvr_model(hold(packed.withColumnRenamed("event_id", "id")))
