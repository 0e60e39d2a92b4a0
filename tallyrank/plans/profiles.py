"""Profile documents, bandit state, walks and graph embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.operators import bandit, embed
from tallyrank.operators import profiles as pf
from tallyrank.operators import walks as wk
from tallyrank.operators.ranking import position
from tallyrank.plans.chains import symmetric_inverse
from tallyrank.plans.neighbours import SUPPLIER_EDGES, supplier_edges
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.sources.tables import epoch_seconds
from tallyrank.streaming import twins

query = REGISTRY.query


@query("build_profile_docs", """
    SELECT c_custkey AS user_id, CAST(to_json({'segment': c_mktsegment, 'nation': c_nationkey, 'balance': c_acctbal,
           'orders': coalesce(n, 0)}) AS VARCHAR) AS user_info
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("orders"))
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
    ).join(counts, "user_id", "left")
    docs = pf.build_profiles(users, "user_id", ["segment", "nation", "balance", "orders"])
    return docs.withColumn("user_info", F.to_json("user_info"))


@query("profile_term", """
    SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), 'the')""")
def _(t):
    return pf.match_term(t.documents, "text", "The").select("doc_id")


@query("profile_range", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 1000 AND c_acctbal < 5000")
def _(t):
    return pf.match_range(t.customer, "c_acctbal", 1000, 5000).select("c_custkey", "c_acctbal")


# Every match takes its edges, so of adjacent phrases each second one is marked in a second pass, which
# leaves those alone that stand behind a tag.
PHRASE = r"(?i)(^|[^\p{L}\p{N}_])(of[^\p{L}\p{N}_]+the)($|[^\p{L}\p{N}_])"
AGAIN = PHRASE.replace("(^|[^\\p{L}\\p{N}_])", "(^|[^\\p{L}\\p{N}_>])", 1)


@query("profile_phrase", rf"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{PHRASE}', '\1<em>\2</em>\3', 'g'), '{AGAIN}', '\1<em>\2</em>\3', 'g')) AS digest FROM documents
    WHERE regexp_matches(text, '{PHRASE}')""")
def _(t):
    found = pf.match_phrase(t.documents, "text", "of the")
    return found.select("doc_id", F.md5("highlight").alias("digest"))


@query("profile_terms_agg", """
    SELECT c_nationkey AS term, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, term LIMIT 10""")
def _(t):
    return pf.terms_buckets(t.customer, "c_nationkey", 10)


UPSERT = """WITH rows AS (
    SELECT c_custkey AS user_id, CAST(0 AS BIGINT) AS day, CAST(-1 AS BIGINT) AS seq, 'upsert' AS op, 'new' AS stage, c_acctbal AS amount FROM customer
    UNION ALL SELECT o_custkey, CAST(epoch(o_orderdate) AS BIGINT), o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'delete' ELSE 'upsert' END,
      o_orderstatus, o_totalprice FROM orders)
    SELECT user_id, day, seq, stage, amount FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, seq DESC) AS r FROM rows) WHERE r = 1 AND op <> 'delete'"""


def _profile_changes(t):
    base = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.lit(0).cast("bigint").alias("day"), F.lit(-1).cast("bigint").alias("seq"),
        F.lit("upsert").alias("op"), F.lit("new").alias("stage"), F.col("c_acctbal").alias("amount"))
    changes = t.orders.select(
        F.col("o_custkey").alias("user_id"), epoch_seconds("o_orderdate").alias("day"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "delete").otherwise("upsert").alias("op"),
        F.col("o_orderstatus").alias("stage"), F.col("o_totalprice").alias("amount"))
    return base, changes


@query("profile_upsert", UPSERT)
def _(t):
    base, changes = _profile_changes(t)
    return pf.upsert(base, changes, "user_id", ["day", "seq"], ["stage", "amount"])


@query("stream_profile_upsert", UPSERT)
def _(t):
    base, _changes = _profile_changes(t)

    def to_changes(df):
        t2 = type("View", (), {"customer": t.customer, "orders": df})
        return _profile_changes(t2)[1]

    return twins.stream_profile_upsert(
        t.spark, f"{t.folder}/orders.parquet", t.orders.schema, to_changes, base,
        "user_id", ["day", "seq"], ["stage", "amount"])


# ---- bandits -----------------------------------------------------------------------

FEATURES = ["x0", "x1", "x2"]
BANDIT_LOG = """log AS (SELECT event_id, event_type AS arm, CASE WHEN value > (SELECT avg(value) FROM events) THEN 1 ELSE 0 END AS reward,
    1.0 AS x0, hour(ts) / 24.0 AS x1, (user_id % 10) / 10.0 AS x2 FROM events)"""


def bandit_log(events, mean):
    return events.select(
        "event_id", F.col("event_type").alias("arm"), F.when(F.col("value") > mean, 1).otherwise(0).alias("reward"),
        F.lit(1.0).alias("x0"), (F.hour("ts") / 24.0).alias("x1"), (F.pmod("user_id", F.lit(10)) / 10.0).alias("x2"))


def _log(t):
    return bandit_log(t.events, t.events.agg(F.avg("value")).scalar())


@query("ucb1_arm_scores", f"""WITH {BANDIT_LOG} SELECT arm, count(*) AS n,
    round(avg(reward) + sqrt(2 * ln((SELECT count(*) FROM log)) / count(*)), 6) AS score FROM log GROUP BY 1""")
def _(t):
    return bandit.ucb_scores(_log(t), "arm", "reward").withColumn("score", F.round("score", 6))


def _state_sql() -> str:
    d = len(FEATURES)
    cells = [f"SELECT arm, 'A' AS part, {i} AS i, {j} AS j, sum(x{i} * x{j}) + {int(i == j)} AS x FROM log GROUP BY 1"
             for i in range(d) for j in range(i + 1)]
    cells += [f"SELECT arm, 'b', {i}, 0, sum(CASE WHEN reward = 1 THEN 0.6 ELSE -16 END * x{i}) FROM log GROUP BY 1"
              for i in range(d)]
    return f"WITH {BANDIT_LOG} SELECT arm, part, i, j, round(CAST(x AS DOUBLE), 6) AS x FROM ({' UNION ALL '.join(cells)})"


@query("linucb_arm_state", _state_sql())
def _(t):
    state = bandit.linucb_state(bandit.linucb_sums(_log(t), "arm", FEATURES, "reward"), len(FEATURES))
    return state.withColumn("x", F.round("x", 6))


@query("linucb_scores", f"""WITH {BANDIT_LOG}, s AS MATERIALIZED (SELECT arm,
      {", ".join(f"sum(x{i} * x{j}) + {int(i == j)} AS a{i}{j}" for i in range(3) for j in range(i + 1))},
      {", ".join(f"sum(CASE WHEN reward = 1 THEN 0.6 ELSE -16 END * x{i}) AS b{i}" for i in range(3))} FROM log GROUP BY 1),
    d AS (SELECT arm, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in
          [f"a{i}{j}" for i in range(3) for j in range(i + 1)] + ["b0", "b1", "b2"])} FROM s),
    inv AS MATERIALIZED (SELECT arm, b0, b1, b2, {symmetric_inverse()} FROM d),
    scored AS (SELECT event_id, inv.arm,
      {" + ".join(f"i{i}{j} * b{j} * x{i}" for i in range(3) for j in range(3))}
      + 0.25 * sqrt({" + ".join(f"i{i}{j} * x{i} * x{j}" for i in range(3) for j in range(3))}) AS score FROM log, inv)
    SELECT event_id, arm, round(score, 6) AS score FROM (SELECT *, row_number() OVER (
      PARTITION BY event_id ORDER BY round(score, 9) DESC, arm) AS r FROM scored) WHERE r = 1""")
def _(t):
    log = _log(t)
    state = bandit.linucb_theta(bandit.linucb_sums(log, "arm", FEATURES, "reward"), len(FEATURES))
    best = bandit.linucb_scores(log, "event_id", FEATURES, state)
    return best.withColumn("score", F.round("score", 6))


@query("stream_linucb_state", _state_sql())
def _(t):
    mean = t.events.agg(F.avg("value")).first()[0]
    sums = twins.stream_arm_sums(
        t.spark, f"{t.folder}/events.parquet", t.events.schema, lambda df: bandit_log(df, F.lit(mean)), FEATURES)
    return bandit.linucb_state(sums, len(FEATURES)).withColumn("x", F.round("x", 6))


# ---- walks and embeddings ----------------------------------------------------------


def _graph(t):
    """Supplier-brand sales and brand pairs of one type of part: a graph with triangles."""
    sales = supplier_edges(t).select(F.concat_ws("", F.lit("s"), "src").alias("src"), "dst", "w")
    types = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("w"))
    kinds = types.select(F.col("p_brand").alias("src"), F.col("p_type").alias("dst"), "w")
    stock = t.supplier.select(
        F.concat_ws("", F.lit("s"), "s_suppkey").alias("src"),
        F.element_at(F.array(*[F.lit(x) for x in PART_TYPES]), (F.pmod("s_nationkey", F.lit(6)) + 1).cast("int")).alias("dst"),
        F.lit(1).cast("bigint").alias("w"))
    return wk.undirected(sales.unionByName(kinds).unionByName(stock))


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
GRAPH = {
    "one": f"""SELECT concat('s', src) AS src, dst, w FROM ({SUPPLIER_EDGES})
        UNION ALL SELECT p_brand, p_type, count(*) FROM part GROUP BY 1, 2
        UNION ALL SELECT concat('s', s_suppkey), ({PART_TYPES})[s_nationkey % 6 + 1], 1 FROM supplier""",
    "g": "SELECT src, dst, CAST(sum(w) AS DOUBLE) AS w FROM (SELECT src, dst, w FROM one UNION ALL SELECT dst, src, w FROM one) GROUP BY 1, 2",
}


@query("transition_probs", with_views("", """
    SELECT src, dst, round(w / sum(w) OVER (PARTITION BY src), 9) AS p FROM g""", **GRAPH))
def _(t):
    return wk.first_order(_graph(t)).withColumn("p", F.round("p", 9))


@query("transition_probs_second", with_views("", """
    SELECT prev, cur, round(4.0 / norm, 9) AS back, round(1.0 / norm, 9) AS near, round(0.25 / norm, 9) AS far FROM (
      SELECT e.src AS prev, e.dst AS cur, sum(CASE WHEN n.dst = e.src THEN n.w / 0.25
             WHEN c.src IS NOT NULL THEN n.w ELSE n.w / 4.0 END) AS norm
      FROM g e JOIN g n ON n.src = e.dst LEFT JOIN g c ON c.src = n.dst AND c.dst = e.src GROUP BY 1, 2)""", **GRAPH))
def _(t):
    rows = wk.second_order(_graph(t))
    return rows.select("prev", "cur", *[F.round(c, 9).alias(c) for c in ("back", "near", "far")])


@query("walks_uniform", "WITH RECURSIVE " + with_views("", """
    SELECT walk, CAST(step AS INTEGER) AS step, node FROM trail""", **GRAPH,
    placed="""SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY md5(dst), dst) - 1 AS place,
              count(*) OVER (PARTITION BY src) AS deg FROM g""",
    starts="SELECT DISTINCT src AS node, concat(src, '#', k) AS walk FROM placed, generate_series(0, 79) s(k)",
    nodes="SELECT DISTINCT src, deg FROM placed").replace("WITH ", "", 1).replace(" SELECT walk, CAST(step", """,
    trail AS (SELECT walk, 0 AS step, node FROM starts UNION ALL
      SELECT t.walk, t.step + 1, e.dst FROM trail t JOIN nodes n ON n.src = t.node JOIN placed e ON e.src = t.node
      AND e.place = CAST(floor(CAST('0x' || substr(md5(concat('up-', t.walk, '-', t.step + 1, '-0')), 1, 8) AS BIGINT)
                    / 4294967296.0 * n.deg) AS BIGINT) WHERE t.step < 9)
    SELECT walk, CAST(step""", 1))
def _(t):
    return wk.uniform_walks(_graph(t), 80, 10)


@query("walks_biased")
def _(t):
    return wk.biased_walks(_graph(t), 80, 10)


def _spread(vectors):
    return vectors.select("id", F.posexplode("vec").alias("dim", "x"))


@query("graph_embeddings")
def _(t):
    tokens = wk.uniform_walks(_graph(t), 80, 10).select(F.col("walk").alias("seq"), F.col("step").alias("pos"), "node")
    return _spread(embed.skip_gram(embed.window_pairs(tokens, 5), 128, 5))


@query("item2vec")
def _(t):
    return _spread(embed.skip_gram(embed.history_pairs(t.interactions), 8, 10, negatives=30))


@query("window_pairs", """
    WITH h AS (SELECT o_custkey AS seq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos,
                      o_orderpriority AS node FROM orders),
    p AS (SELECT x.node AS a, y.node AS b FROM h x JOIN h y ON x.seq = y.seq AND y.pos > x.pos AND y.pos <= x.pos + 3)
    SELECT c, o, CAST(count(*) AS DOUBLE) AS n FROM (SELECT a AS c, b AS o FROM p UNION ALL SELECT b, a FROM p) GROUP BY 1, 2""")
def _(t):
    placed = position(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    tokens = placed.select(F.col("o_custkey").alias("seq"), "pos", F.col("o_orderpriority").alias("node"))
    return embed.window_pairs(tokens, 3)


@query("history_pairs", with_views("inter", """
    SELECT x.item_id AS c, y.item_id AS o, CAST(count(*) AS DOUBLE) AS n FROM inter x JOIN inter y USING (user_id)
    WHERE x.item_id <> y.item_id GROUP BY 1, 2"""))
def _(t):
    return embed.history_pairs(t.interactions)
