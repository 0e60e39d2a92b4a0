"""Neighbourhood recommenders, Swing, SimRank and association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_prefix
from tallyrank.operators import graph, neighbours as nb, rules
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.sources.files import edge_weights

query = REGISTRY.query


def _rounded(df, column, digits=6):
    return df.withColumn(column, F.round(column, digits))


CO_ITEMS = """SELECT a.item_id AS i, b.item_id AS j, sum({weight}) AS c
    FROM train a JOIN train b ON a.user_id = b.user_id AND a.item_id <> b.item_id {join} GROUP BY 1, 2"""
CO_USERS = """SELECT a.user_id AS i, b.user_id AS j, sum({weight}) AS c
    FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id {join} GROUP BY 1, 2"""


def _sim_views(key: str, penalty: bool) -> dict[str, str]:
    other = "user_id" if key == "item_id" else "item_id"
    pattern = CO_ITEMS if key == "item_id" else CO_USERS
    views = {
        "cnt": f"SELECT {key} AS k, count(*) AS n FROM train GROUP BY 1",
        "pen": f"SELECT {other} AS p, 1 / ln(1 + count(*)) AS g FROM train GROUP BY 1",
        "co": pattern.format(
            weight="g" if penalty else "1.0", join=f"JOIN pen ON pen.p = a.{other}" if penalty else ""
        ),
        "sim": """SELECT i, j, c / sqrt(CAST(ci.n AS DOUBLE) * cj.n) AS w FROM co
                  JOIN cnt ci ON ci.k = i JOIN cnt cj ON cj.k = j""",
        "near": """SELECT i, j, w FROM (SELECT *, row_number() OVER (
                     PARTITION BY i ORDER BY round(w, 9) DESC, j) AS r FROM sim) WHERE r <= 20""",
    }
    return views


ITEM_RECS = """SELECT t.user_id, n.j AS item_id, sum(n.w * t.rating) AS score FROM train t JOIN near n ON n.i = t.item_id
    WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = t.user_id AND s.item_id = n.j) GROUP BY 1, 2"""
USER_RECS = """SELECT n.i AS user_id, t.item_id, sum({vote}) AS score FROM near n JOIN train t ON t.user_id = n.j
    WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = n.i AND s.item_id = t.item_id) GROUP BY 1, 2"""
TOP_N = """SELECT user_id, item_id, rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM scored) WHERE rank <= {n}"""
PAIRS = "SELECT i AS a, j AS b, round(w, 6) AS w FROM sim WHERE i < j"


@query("item_cf_similarity", with_views("train", PAIRS, **_sim_views("item_id", False)))
def _(t):
    return _rounded(nb.item_similarity(t.train), "w")


@query("item_cf_recommend", with_views("train", TOP_N.format(n=10), **_sim_views("item_id", False), scored=ITEM_RECS))
def _(t):
    recs = nb.item_cf_recommend(t.train, nb.item_similarity(t.train))
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


@query("item_iuf_similarity", with_views("train", PAIRS, **_sim_views("item_id", True)))
def _(t):
    return _rounded(nb.item_similarity(t.train, active_user_penalty=True), "w")


@query("item_iuf_recommend", with_views("train", TOP_N.format(n=10), **_sim_views("item_id", True), scored=ITEM_RECS))
def _(t):
    recs = nb.item_cf_recommend(t.train, nb.item_similarity(t.train, active_user_penalty=True))
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


@query("user_cf_similarity", with_views("train", PAIRS, **_sim_views("user_id", False)))
def _(t):
    return _rounded(nb.user_similarity(t.train), "w")


@query("user_cf_recommend", with_views(
    "train", TOP_N.format(n=10), **_sim_views("user_id", False), scored=USER_RECS.format(vote="n.w * t.rating")))
def _(t):
    recs = nb.user_cf_recommend(t.train, nb.user_similarity(t.train))
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


@query("user_iif_similarity", with_views("train", PAIRS, **_sim_views("user_id", True)))
def _(t):
    return _rounded(nb.user_similarity(t.train, popular_item_penalty=True), "w")


@query("user_iif_recommend", with_views(
    "train", TOP_N.format(n=10), **_sim_views("user_id", True), scored=USER_RECS.format(vote="n.w * t.rating")))
def _(t):
    recs = nb.user_cf_recommend(t.train, nb.user_similarity(t.train, popular_item_penalty=True))
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


@query("user_cf_implicit", with_views(
    "train", TOP_N.format(n=10), **_sim_views("user_id", False), scored=USER_RECS.format(vote="n.w")))
def _(t):
    recs = nb.user_cf_recommend(t.train, nb.user_similarity(t.train), implicit=True)
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


COSINE = """SELECT a.item_id AS i, b.item_id AS j, sum(a.rating * b.rating) / (na.n * nb.n) AS w
    FROM {src} a JOIN {src} b ON a.user_id = b.user_id {cond}
    JOIN norms na ON na.k = a.item_id JOIN norms nb ON nb.k = b.item_id GROUP BY a.item_id, b.item_id, na.n, nb.n"""


@query("dense_cosine_similarity", with_views(
    "inter", "SELECT i AS a, j AS b, round(w, 6) AS w FROM sim",
    norms="SELECT item_id AS k, sqrt(sum(rating * rating)) AS n FROM inter GROUP BY 1",
    sim=COSINE.format(src="inter", cond="AND a.item_id < b.item_id")))
def _(t):
    return _rounded(nb.dense_cosine(t.interactions), "w")


BRAND_PREDICT = {
    "norms": "SELECT item_id AS k, sqrt(sum(rating * rating)) AS n FROM brand GROUP BY 1",
    "sim": COSINE.format(src="brand", cond=""),
    "total": "SELECT i, sum(abs(w)) AS total FROM sim GROUP BY 1",
    "pred": """SELECT b.user_id, s.i AS item_id, sum(b.rating * s.w) / t.total AS pred
               FROM brand b JOIN sim s ON s.j = b.item_id JOIN total t ON t.i = s.i GROUP BY b.user_id, s.i, t.total""",
}


@query("cf_predict_item", with_views(
    "brand", "SELECT user_id, item_id, round(pred, 6) AS pred FROM pred", **BRAND_PREDICT))
def _(t):
    return _rounded(nb.predict_by_items(t.brand_ratings), "pred")


@query("cf_predict_user", with_views(
    "brand", "SELECT user_id, item_id, round(pred, 6) AS pred FROM pred",
    users="""SELECT user_id, sqrt(sum(rating * rating)) AS norm,
             sum(rating) / (SELECT count(DISTINCT item_id) FROM brand) AS mean FROM brand GROUP BY 1""",
    sim="""SELECT a.user_id AS u, b.user_id AS v, sum(a.rating * b.rating) / (ua.norm * ub.norm) AS w
           FROM brand a JOIN brand b ON a.item_id = b.item_id JOIN users ua ON ua.user_id = a.user_id
           JOIN users ub ON ub.user_id = b.user_id GROUP BY a.user_id, b.user_id, ua.norm, ub.norm""",
    base="SELECT u, sum(abs(w)) AS total, sum(w * m.mean) AS shift FROM sim JOIN users m ON m.user_id = v GROUP BY 1",
    pred="""SELECT s.u AS user_id, b.item_id, m.mean + (sum(s.w * b.rating) - x.shift) / x.total AS pred
            FROM sim s JOIN brand b ON b.user_id = s.v JOIN users m ON m.user_id = s.u JOIN base x ON x.u = s.u
            GROUP BY s.u, b.item_id, m.mean, x.shift, x.total"""))
def _(t):
    return _rounded(nb.predict_by_users(t.brand_ratings), "pred")


@query("topn_unseen", with_views(
    "brand", TOP_N.format(n=10), **BRAND_PREDICT,
    scored="SELECT p.user_id, p.item_id, p.pred AS score FROM pred p ANTI JOIN brand b USING (user_id, item_id)"))
def _(t):
    recs = nb.topn_unseen(nb.predict_by_items(t.brand_ratings), t.brand_ratings, 10)
    return _rounded(recs.select("user_id", "item_id", "rank", "score"), "score")


ITEM_PREDICT = {name: sql.replace("brand", "train") for name, sql in BRAND_PREDICT.items()}


@query("topn_unseen_items", with_views(
    "train", TOP_N.format(n=20), **ITEM_PREDICT,
    scored="SELECT p.user_id, p.item_id, p.pred AS score FROM pred p ANTI JOIN train b USING (user_id, item_id)"))
def _(t):
    """Over single items, where all predictions would be users times items."""
    return _rounded(nb.recommend_by_items(t.train, 20), "score")


WEIGHTED = """SELECT item_id, round(v / (v + m) * r + {second} / (v + m) * c, 6) AS score
    FROM items, (SELECT avg(r) AS c, avg(v) AS m FROM items)"""


@query("weighted_rating", with_views(
    "inter", WEIGHTED.format(second="m"),
    items="SELECT item_id, avg(rating) AS r, CAST(count(*) AS DOUBLE) AS v FROM inter GROUP BY 1"))
def _(t):
    return _rounded(nb.weighted_rating(t.interactions), "score")


@query("weighted_rating_as_coded", with_views(
    "inter", WEIGHTED.format(second="c"),
    items="""SELECT item_id, avg(rating) AS r, CAST(count(*) AS DOUBLE) AS v
             FROM (SELECT DISTINCT item_id, rating FROM inter) GROUP BY 1"""))
def _(t):
    return _rounded(nb.weighted_rating(t.interactions, as_coded=True), "score")


FEATURES = {
    "feat": "SELECT p_brand AS item_id, p_type AS feature, CAST(count(*) AS DOUBLE) AS x FROM part GROUP BY 1, 2",
    "norms": "SELECT item_id, sqrt(sum(x * x)) AS norm FROM feat GROUP BY 1",
    "cos": """SELECT a.item_id AS i, b.item_id AS j, (sum(a.x * b.x) + 0.001) / (na.norm * nb.norm) AS w
              FROM feat a JOIN feat b USING (feature) JOIN norms na ON na.item_id = a.item_id
              JOIN norms nb ON nb.item_id = b.item_id GROUP BY a.item_id, b.item_id, na.norm, nb.norm""",
}


def _brand_features(t):
    return t.part.groupBy(F.col("p_brand").alias("item_id"), F.col("p_type").alias("feature")).agg(
        F.count(F.lit(1)).cast("double").alias("x")
    )


@query("content_cosine", with_views("", "SELECT i AS a, j AS b, round(w, 6) AS w FROM cos WHERE i < j", **FEATURES))
def _(t):
    return _rounded(nb.content_cosine(_brand_features(t)), "w")


@query("content_user_scores", with_views(
    "brand", """SELECT b.user_id, x.item_id, round(avg((coalesce(d.d, 0) + 0.001) / (x.norm * c.norm)), 6) AS score
    FROM brand b JOIN norms c ON c.item_id = b.item_id CROSS JOIN norms x
    LEFT JOIN dots d ON d.i = x.item_id AND d.j = b.item_id
    WHERE NOT EXISTS (SELECT 1 FROM brand s WHERE s.user_id = b.user_id AND s.item_id = x.item_id)
    GROUP BY 1, 2 HAVING sum(coalesce(d.d, 0)) > 0""", **FEATURES,
    dots="SELECT a.item_id AS i, b.item_id AS j, sum(a.x * b.x) AS d FROM feat a JOIN feat b USING (feature) GROUP BY 1, 2"))
def _(t):
    return _rounded(nb.content_scores(t.brand_ratings, _brand_features(t)), "score")


@query("swing_similarity", with_views(
    "train", """SELECT x.item_id AS a, y.item_id AS b, round(sum(1 / (0.5 + o.n)), 6) AS s
    FROM both_ x JOIN both_ y ON x.u = y.u AND x.v = y.v AND x.item_id < y.item_id
    JOIN overlap o ON o.u = x.u AND o.v = x.v GROUP BY 1, 2""",
    shared="""SELECT a.user_id AS u, b.user_id AS v, a.item_id FROM train a JOIN train b
              ON a.item_id = b.item_id AND a.user_id < b.user_id""",
    overlap="SELECT u, v, count(*) AS n FROM shared GROUP BY 1, 2 HAVING count(*) >= 2",
    both_="SELECT s.u, s.v, s.item_id FROM shared s JOIN overlap USING (u, v)"))
def _(t):
    return _rounded(graph.swing_similarity(t.train), "s")


SUPPLIER_EDGES = """SELECT l_suppkey AS src, p_brand AS dst, count(*) AS w
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


def supplier_edges(t):
    clicks = t.lineitem.select("l_suppkey", "l_partkey").join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return edge_weights(clicks, "l_suppkey", "p_brand")


@query("simrank", with_views(
    "", """SELECT x.src AS a, y.src AS b, round(0.8 * sum(s.s) / (wx.w * wy.w), 9) AS s
    FROM e x JOIN ad s ON s.i = x.dst JOIN e y ON y.dst = s.j JOIN ws wx ON wx.src = x.src JOIN ws wy ON wy.src = y.src
    WHERE x.src < y.src GROUP BY x.src, y.src, wx.w, wy.w""",
    e=SUPPLIER_EDGES, ws="SELECT src, CAST(sum(w) AS DOUBLE) AS w FROM e GROUP BY 1",
    wd="SELECT dst, CAST(sum(w) AS DOUBLE) AS w FROM e GROUP BY 1",
    ad="""SELECT x.dst AS i, y.dst AS j, CASE WHEN x.dst = y.dst THEN 1.0 ELSE 0.8 * count(*) / (wx.w * wy.w) END AS s
          FROM e x JOIN e y ON x.src = y.src JOIN wd wx ON wx.dst = x.dst JOIN wd wy ON wy.dst = y.dst
          GROUP BY x.dst, y.dst, wx.w, wy.w"""))
def _(t):
    src, _dst = graph.simrank(supplier_edges(t), 0.8, 2, "src")
    return src.where("i < j").select(
        F.col("i").alias("a"), F.col("j").alias("b"), F.round("s", 9).alias("s"))


def _user_baskets(t):
    return t.brand_ratings.select(F.col("user_id").alias("basket"), F.col("item_id").alias("item"))


FREQUENT = """SELECT item_id AS item FROM brand GROUP BY 1
    HAVING count(*) / (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) FROM brand) >= 0.4"""


@query("frequent_items_pruned", with_views(
    "brand", "SELECT x.item AS a, y.item AS b, z.item AS c FROM f x JOIN f y ON x.item < y.item JOIN f z ON y.item < z.item",
    f=FREQUENT))
def _(t):
    return rules.item_triples(_user_baskets(t), 0.4)


@query("itemset_support", with_views(
    "brand", """SELECT x.item_id AS a, y.item_id AS b, z.item_id AS c, count(*) AS n FROM k x
    JOIN k y ON x.user_id = y.user_id AND x.item_id < y.item_id
    JOIN k z ON z.user_id = y.user_id AND y.item_id < z.item_id GROUP BY 1, 2, 3""",
    f=FREQUENT, k="SELECT user_id, item_id FROM brand WHERE item_id IN (SELECT item FROM f)"))
def _(t):
    return rules.triple_support(_user_baskets(t), 0.4)


RULES = {
    "one": "SELECT item, count(*) AS n FROM baskets GROUP BY 1",
    "total": "SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM baskets",
    "two": """SELECT a.item AS x, b.item AS y, count(*) AS n FROM baskets a JOIN baskets b
              ON a.basket = b.basket AND a.item <> b.item GROUP BY 1, 2
              HAVING count(*) >= 0.02 * (SELECT n FROM total)""",
    "rules": """SELECT x AS antecedent, y AS consequent, two.n / CAST(one.n AS DOUBLE) AS confidence,
                two.n / (SELECT n FROM total) AS support FROM two JOIN one ON one.item = two.x
                WHERE two.n / CAST(one.n AS DOUBLE) >= 0.1""",
}


def _mined(t):
    return rules.mine_rules(t.baskets, 0.02, 0.1)


@query("association_rules", with_views(
    "baskets", """SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(support, 6) AS support
    FROM rules""", **RULES))
def _(t):
    _sets, found = _mined(t)
    return found.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
        F.array_join(F.array_sort("consequent"), ",").alias("consequent"),
        F.round("confidence", 6).alias("confidence"), F.round("support", 6).alias("support"),
    )


@query("frequent_itemsets", with_views(
    "baskets", """SELECT item AS items, n FROM one WHERE n >= 0.02 * (SELECT n FROM total)
    UNION ALL SELECT concat(x, ',', y), n FROM two WHERE x < y""", **RULES))
def _(t):
    sets, _found = _mined(t)
    return sets.select(F.array_join(F.array_sort("items"), ",").alias("items"), F.col("freq").alias("n"))


@query("rule_comembers", with_views(
    "baskets", """SELECT antecedent AS item, consequent AS other FROM rules
    UNION SELECT consequent, antecedent FROM rules""", **RULES))
def _(t):
    _sets, found = _mined(t)
    return rules.rule_comembers(found)
