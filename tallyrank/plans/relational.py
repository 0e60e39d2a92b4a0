"""Sources, projections, attribute joins and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.functions.arrays import joined
from tallyrank.operators import relational as rel
from tallyrank.operators import splits
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.sources import files

query = REGISTRY.query


# ---- sources -----------------------------------------------------------------------


@query("read_ratings", with_views("inter", "SELECT user_id, item_id, rating, ts FROM inter"))
def _(t):
    return t.interactions


@query("read_items", """
    SELECT p_partkey AS item_id, p_name AS title, unnest([p_type, p_brand]) AS genre FROM part""")
def _(t):
    packed = t.part.select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )
    return packed.select("item_id", "title", F.explode(F.split("genres", r"\|")).alias("genre"))


@query("read_users", """
    SELECT c.c_custkey AS user_id, c.c_mktsegment AS occupation, n.n_name AS nation, r.r_name AS region
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey""")
def _(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("occupation"),
            F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
        )
    )


@query("read_events", with_views("inter", """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos, item_id, ts
    FROM inter"""))
def _(t):
    return rel.ordered_items(t.interactions).select("user_id", "pos", "item_id", "ts")


@query("read_item_category", with_views("inter catalogue", """
    SELECT c.category, count(*) AS n, count(DISTINCT i.item_id) AS n_items
    FROM inter i JOIN catalogue c USING (item_id) GROUP BY 1"""))
def _(t):
    return t.interactions.join(t.item_category, "item_id").groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("item_id").alias("n_items")
    )


@query("read_search_log", """
    SELECT event_id, 'k' AS title, CAST(json_extract(props, '$.k') AS DOUBLE) AS prob
    FROM events WHERE event_type <> 'error' AND json_extract(props, '$.k') IS NOT NULL""")
def _(t):
    kept = t.events.where(F.col("event_type") != "error")
    parsed = files.parse_predictions(kept, "props")
    return parsed.select("event_id", F.explode("props").alias("title", "prob"))


@query("read_edges", """
    SELECT l_suppkey AS src, p_brand AS dst, count(*) AS w
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def _(t):
    clicks = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return files.edge_weights(clicks, "l_suppkey", "p_brand")


@query("read_context_log", """
    SELECT CAST(event_id AS VARCHAR) AS key, 0 AS pos, value AS x FROM events
    UNION ALL SELECT CAST(event_id AS VARCHAR), 1, CAST(user_id AS DOUBLE) FROM events""")
def _(t):
    lines = t.events.select(F.concat_ws(" ", "event_id", "value", "user_id").alias("value"))
    return files.parse_context(lines).select("key", F.posexplode("features").alias("pos", "x"))


@query("write_submission", """
    SELECT c_custkey AS id, printf('%.5f', c_acctbal / 7000.0) AS target FROM customer""")
def _(t):
    scored = t.customer.withColumn("p", F.col("c_acctbal") / 7000.0)
    return files.submission_rows(scored, "c_custkey", "p")


@query("write_csv_noheader", """
    SELECT concat_ws(',', c_name, c_nationkey, c_mktsegment) AS line FROM customer""")
def _(t):
    kept = t.customer.drop("c_custkey", "c_acctbal")
    return kept.select(F.concat_ws(",", *kept.columns).alias("line"))


@query("read_skip_header", """
    SELECT s_suppkey AS id, s_nationkey AS zone, s_acctbal AS balance FROM supplier""")
def _(t):
    lines = t.supplier.select(F.concat_ws(",", "s_suppkey", "s_nationkey", "s_acctbal").alias("value"))
    head = t.spark.sql("SELECT 'id,zone,balance' AS value")
    schema = "id BIGINT, zone INT, balance DOUBLE"
    return files.parse_delimited(lines.unionByName(head), schema, "id,zone,balance")


# ---- projections and joins ---------------------------------------------------------


def _users(t):
    return t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("occupation"),
        F.col("c_nationkey").alias("zone"),
    )


def _titles(t):
    return t.part.select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
    )


JOINED = """
    SELECT i.user_id, i.item_id, i.rating, c.c_mktsegment AS occupation, c.c_nationkey AS zone,
           p.p_name AS title, p.p_type AS category
    FROM inter i {how} JOIN customer c ON i.user_id = c.c_custkey
    {how} JOIN part p ON i.item_id = p.p_partkey"""


@query("join_attributes_left", with_views("inter", JOINED.format(how="LEFT")))
def _(t):
    return rel.join_attributes(t.interactions.drop("ts"), _users(t), _titles(t), "left")


@query("join_attributes_inner", with_views("inter", JOINED.format(how="INNER")))
def _(t):
    return rel.join_attributes(t.interactions.drop("ts"), _users(t), _titles(t), "inner")


@query("lookup_profile", """
    SELECT o.o_orderkey AS sample_id, c.c_mktsegment AS occupation, c.c_nationkey AS zone
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def _(t):
    samples = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("user_id"))
    return samples.join(_users(t), "user_id").drop("user_id")


@query("first_per_key", """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def _(t):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return rel.first_per_key(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("drop_columns", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return t.customer.drop("c_name", "c_nationkey")


@query("binarize_rating", with_views("inter", """
    SELECT user_id, item_id, CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS label FROM inter"""))
def _(t):
    return t.interactions.select("user_id", "item_id", rel.binarize("rating").alias("label"))


@query("missing_count", """
    SELECT s_suppkey, CAST(s_nationkey - 6 = -1 AS INTEGER) + CAST(floor(s_acctbal / 1000) - 4 = -1 AS INTEGER)
           AS missing FROM supplier""")
def _(t):
    rows = t.supplier.select(
        "s_suppkey", (F.col("s_nationkey") - 6).alias("a"), (F.floor(F.col("s_acctbal") / 1000) - 4).alias("b")
    )
    return rows.select("s_suppkey", rel.missing_count(["a", "b"]).alias("missing"))


@query("cross_feature", """
    SELECT p_partkey, round(p_size * p_retailprice, 6) AS crossed FROM part""")
def _(t):
    return t.part.select("p_partkey", F.round(F.col("p_size") * F.col("p_retailprice"), 6).alias("crossed"))


@query("fill_defaults", """
    SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.withColumn("toxic", F.col("toxic").cast("string")).na.fill({"quality": 0, "toxic": ""})


@query("concat_tables", with_views("train test", """
    SELECT user_id, item_id, 'train' AS origin FROM train
    UNION ALL SELECT user_id, item_id, 'test' AS origin FROM test"""))
def _(t):
    train = t.train.select("user_id", "item_id", F.lit("train").alias("origin"))
    test = t.test.select("user_id", "item_id", F.lit("test").alias("origin"))
    return train.unionByName(test)


@query("distinct_values", with_views("inter", """
    SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, count(DISTINCT rating) AS ratings
    FROM inter"""))
def _(t):
    return t.interactions.agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("item_id").alias("items"),
        F.countDistinct("rating").alias("ratings"),
    )


@query("unseen_items", with_views("inter", """
    SELECT user_id, prev + 1 AS first_pos, pos - 1 AS last_pos, pos - prev - 1 AS n_items FROM (
      SELECT user_id, pos, coalesce(lag(pos) OVER (PARTITION BY user_id ORDER BY pos), -1) AS prev
      FROM marks) WHERE pos > prev + 1""",
    idx="SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part",
    marks="""SELECT user_id, pos FROM inter JOIN idx USING (item_id)
             UNION ALL SELECT DISTINCT user_id, (SELECT count(*) FROM part) FROM inter"""))
def _(t):
    return rel.unseen_runs(t.interactions, t.item_category)


@query("item_popularity", with_views("inter", "SELECT item_id, count(*) AS popularity FROM inter GROUP BY 1"))
def _(t):
    return rel.item_popularity(t.interactions)


@query("behavior_type_counts", """
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )


@query("matrix_sparsity", with_views("inter", """
    SELECT round(1 - count(*) / CAST(count(DISTINCT user_id) * count(DISTINCT item_id) AS DOUBLE), 3) AS sparsity
    FROM inter"""))
def _(t):
    return rel.matrix_sparsity(t.interactions)


@query("user_history_list", with_views("inter", """
    SELECT user_id, pos // 100 AS part, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY pos) AS items FROM (
      SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos
      FROM inter) GROUP BY 1, 2"""))
def _(t):
    return rel.history_chunks(t.interactions, ["item_id"]).select(
        "user_id", "part", joined("item_id").alias("items")
    )


@query("user_item_rating_lists", with_views("inter", """
    SELECT user_id, pos // 100 AS part, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY pos) AS items,
           string_agg(CAST(CAST(rating AS INTEGER) AS VARCHAR), ',' ORDER BY pos) AS ratings FROM (
      SELECT user_id, item_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos
      FROM inter) GROUP BY 1, 2"""))
def _(t):
    rows = t.interactions.withColumn("rating", F.col("rating").cast("int"))
    return rel.history_chunks(rows, ["item_id", "rating"]).select(
        "user_id", "part", joined("item_id").alias("items"), joined("rating").alias("ratings")
    )


@query("user_item_documents", with_views("inter", """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos,
           p_name AS title, p_type AS genres
    FROM inter JOIN part ON item_id = p_partkey"""))
def _(t):
    ordered = rel.ordered_items(t.interactions)
    return ordered.join(_titles(t), "item_id").select(
        "user_id", "pos", "title", F.col("category").alias("genres")
    )


# ---- splits and id maps ------------------------------------------------------------


def _hash_split_sql(limit):
    return with_views("inter", f"""
        SELECT user_id, item_id, CASE WHEN substr(md5(concat(user_id, '-', item_id)), 1, 2) < '{limit}'
               THEN 'train' ELSE 'test' END AS split FROM inter""")


def _hash_split(limit):
    return lambda t: splits.split_by_hash(
        t.interactions.select("user_id", "item_id"), ["user_id", "item_id"], limit
    )


query("split_bernoulli", _hash_split_sql("b3"))(_hash_split("b3"))
query("split_one_in_eight", _hash_split_sql("e0"))(_hash_split("e0"))
query("split_fraction", _hash_split_sql("cc"))(_hash_split("cc"))


@query("split_leave_last", with_views("inter", """
    SELECT user_id, item_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) = 1
           THEN 'test' ELSE 'train' END AS split FROM inter"""))
def _(t):
    return splits.split_leave_last(t.interactions).select("user_id", "item_id", "split")


@query("split_leave_one_random", with_views("inter", """
    SELECT user_id, item_id, CASE WHEN row_number() OVER (
             PARTITION BY user_id ORDER BY md5(concat(user_id, '-', item_id)), item_id) = 1
           THEN 'test' ELSE 'train' END AS split FROM inter"""))
def _(t):
    return splits.split_leave_one_random(t.interactions).select("user_id", "item_id", "split")


@query("split_stratified_kfold", """
    SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
           - 1) % 3 AS fold FROM labels""")
def _(t):
    return splits.stratified_folds(t.labels.select("doc_id", "quality"), "doc_id", "quality", 3)


@query("split_history_80", with_views("inter", """
    SELECT user_id, item_id, pos, CASE WHEN pos < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'history' ELSE 'target' END AS part
    FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos,
                 count(*) OVER (PARTITION BY user_id) AS n FROM inter)"""))
def _(t):
    return splits.split_history(t.interactions).select("user_id", "item_id", "pos", "part")


@query("split_positional", """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= 4000 THEN 'valid' ELSE 'test' END
           AS split FROM orders""")
def _(t):
    return splits.split_positional(t.orders.select("o_orderkey"), "o_orderkey", 4000)


@query("compact_ids", with_views("inter", """
    SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM inter)"""))
def _(t):
    return splits.compact_ids(t.interactions, "item_id")


@query("label_encode", """
    SELECT c_custkey, code FROM customer JOIN (
      SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS code
      FROM (SELECT DISTINCT c_mktsegment FROM customer)) USING (c_mktsegment)""")
def _(t):
    codes = splits.label_codes(t.customer, "c_mktsegment")
    return t.customer.join(codes, "c_mktsegment").select("c_custkey", "code")


@query("frequency_vocab", with_views("inter", """
    SELECT item_id, n, row_number() OVER (ORDER BY n DESC, item_id) - 1 AS idx
    FROM (SELECT item_id, count(*) AS n FROM inter GROUP BY 1 HAVING count(*) > 5)"""))
def _(t):
    return splits.frequency_vocab(t.interactions, "item_id", min_count=6)
