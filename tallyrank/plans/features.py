"""Feature engineering, text features and profile documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.functions import features as fx
from tallyrank.functions.arrays import joined, multi_hot, slice_by_lengths
from tallyrank.operators import featureset as fs
from tallyrank.operators import text as tx
from tallyrank.operators import topics
from tallyrank.operators import vectors as vec
from tallyrank.operators.relational import ordered_items
from tallyrank.operators.splits import label_codes
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.plans.sequences import NAME_WORDS, ORDERED
from tallyrank.sources import files

query = REGISTRY.query

AGE_SQL = """CASE WHEN {x} >= 56 THEN 6 WHEN {x} BETWEEN 18 AND 24 THEN 2 WHEN {x} BETWEEN 25 AND 34 THEN 3
    WHEN {x} BETWEEN 35 AND 44 THEN 4 WHEN {x} BETWEEN 45 AND 55 THEN 5 ELSE 1 END"""
SEX_SQL = "CASE WHEN {x} = 'M' THEN 1 WHEN {x} = 'F' THEN 2 ELSE 0 END"
DECADE_SQL = """CASE WHEN {x} >= 2000 THEN 1 WHEN {x} >= 1990 THEN 2 WHEN {x} >= 1980 THEN 3
    WHEN {x} >= 1970 THEN 4 ELSE 0 END"""
FLAGS_SQL = f"list_transform({NAME_WORDS}, lambda w: CAST(list_contains(string_split(p_name, ' '), w) AS INTEGER))"


@query("age_bucket_10y", """
    SELECT p_partkey, concat(CAST((ceil(p_size / 10.0) * 10 - 10) AS BIGINT), '-', CAST((ceil(p_size / 10.0) * 10) AS BIGINT))
    AS bucket FROM part""")
def _(t):
    return t.part.select("p_partkey", fx.age_bucket("p_size").alias("bucket"))


@query("age_code", f"SELECT p_partkey, {AGE_SQL.format(x='p_size')} AS code FROM part")
def _(t):
    return t.part.select("p_partkey", fx.age_code("p_size").alias("code"))


@query("sex_code", f"SELECT c_custkey, {SEX_SQL.format(x='substr(c_mktsegment, 1, 1)')} AS code FROM customer")
def _(t):
    return t.customer.select("c_custkey", fx.sex_code(F.substring("c_mktsegment", 1, 1)).alias("code"))


@query("decade_code", f"SELECT o_orderkey, {DECADE_SQL.format(x='year(o_orderdate)')} AS code FROM orders")
def _(t):
    return t.orders.select("o_orderkey", fx.decade_code(F.year("o_orderdate")).alias("code"))


@query("year_from_title", r"""
    SELECT doc_id, CAST(nullif(regexp_extract(text, '(\d{4})', 1), '') AS INTEGER) AS year FROM documents
    WHERE regexp_matches(text, '\d{4}')""")
def _(t):
    rows = t.documents.select("doc_id", fx.year_from_title("text").alias("year"))
    return rows.where(F.col("year").isNotNull())


@query("year_from_date", "SELECT o_orderkey, split_part(strftime(o_orderdate, '%d-%b-%Y'), '-', 3) AS year FROM orders")
def _(t):
    text = F.date_format("o_orderdate", "dd-MMM-yyyy")
    return t.orders.select("o_orderkey", fx.year_from_date(text).alias("year"))


@query("genre_multi_hot", f"SELECT p_partkey, array_to_string({FLAGS_SQL}, '') AS flags FROM part")
def _(t):
    flags = fx.genre_flags(F.split("p_name", " "), NAME_WORDS)
    return t.part.select("p_partkey", joined(flags, "").alias("flags"))


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS seg_{s.lower()}"
    for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def _(t):
    return fs.one_hot(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "seg").drop("c_mktsegment")


@query("one_hot_places", """
    SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS place, (SELECT count(DISTINCT o_custkey) FROM orders) AS width
    FROM orders""")
def _(t):
    return fs.one_hot_places(t.orders.select("o_orderkey", "o_custkey"), "o_custkey")[1]


@query("clean_title", r"""
    SELECT doc_id, md5(trim(regexp_replace(text, '[!,;:?"''、，；()]+', ' ', 'g'))) AS digest FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.md5(fx.clean_title("text")).alias("digest"))


@query("tokenize_names", r"""
    SELECT DISTINCT doc_id, lower(w) AS token FROM (
      SELECT doc_id, unnest(string_split_regex(regexp_replace(text,
        '[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{|}~，。？！、；：「」『』（）［］〔〕【】—…－～‧《》〈〉﹏＿]', '', 'g'), '\s+')) AS w
      FROM documents) WHERE length(w) > 1""")
def _(t):
    return t.documents.select("doc_id", F.explode(fx.name_tokens("text")).alias("token"))


STOPS = "(" + ", ".join(f"'{w}'" for w in fx.STOP_WORDS) + ")"


@query("bag_of_words", rf"""
    WITH words AS MATERIALIZED (SELECT doc_id, unnest(string_split_regex(lower(trim(text)), '\s+')) AS token FROM documents),
    kept AS MATERIALIZED (SELECT doc_id, token, count(*) AS n FROM words WHERE token <> '' AND token NOT IN {STOPS}
      AND NOT regexp_full_match(token, '[0-9]+') GROUP BY 1, 2)
    SELECT doc_id, token, n FROM kept WHERE token IN (SELECT token FROM kept GROUP BY 1 HAVING sum(n) > 1)""")
def _(t):
    return tx.bag_of_words(t.documents, "doc_id", "text")


@query("tf_idf", r"""
    WITH words AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token FROM documents),
    tf AS MATERIALIZED (SELECT doc_id, token, count(*) AS n FROM words GROUP BY 1, 2),
    idf AS (SELECT token, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY 1),
    raw AS MATERIALIZED (SELECT doc_id, token, n * idf AS w FROM tf JOIN idf USING (token)),
    norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY 1)
    SELECT doc_id, token, round(w / norm, 6) AS weight FROM raw JOIN norms USING (doc_id)""")
def _(t):
    rows = tx.tf_idf(t.documents, "doc_id", tx.word_tokens("text"))
    return rows.withColumn("weight", F.round("weight", 6))


@query("topic_lda")
def _(t):
    return tx.lda_topics(t.documents, "doc_id", "text")


@query("lda_bound", "SELECT CAST(range AS INTEGER) AS round, TRUE AS rising FROM range(2, 11) WHERE EXISTS (SELECT 1 FROM documents)")
def _(t):
    """Whether the bound of topic_lda rises with every round, up to rounding."""
    bag = tx.bag_of_words(t.documents, "doc_id", "text")
    _words, bounds = topics.lda(bag, "doc_id")
    rows = [(i, b >= a - 1e-9 * abs(a)) for i, (a, b) in enumerate(zip(bounds, bounds[1:]), 2)]
    return bag.sparkSession.createDataFrame(rows, "round INT, rising BOOLEAN")


@query("topic_lsi")
def _(t):
    return tx.lsi_topics(t.documents, "doc_id", "text")


@query("standardize", """
    SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
           / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS z FROM customer""")
def _(t):
    return fs.standardize(t.customer, "c_acctbal", "z").select("c_custkey", F.round("z", 6).alias("z"))


@query("min_max", """
    SELECT c_custkey, round((c_acctbal - (SELECT min(c_acctbal) FROM customer))
           / ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)), 6) AS z FROM customer""")
def _(t):
    return fs.min_max(t.customer, "c_acctbal", "z").select("c_custkey", F.round("z", 6).alias("z"))


VEC = """SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings"""
SPREAD = """SELECT {key}, unnest(generate_series(0, len(vec) - 1)) AS dim, unnest(vec) AS x FROM {src}"""


def item_vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


@query("l2_normalize_rows", with_views("", """
    SELECT id, dim, round(x / norm, 6) AS x FROM spread JOIN norms USING (id)""",
    v=VEC, spread=SPREAD.format(key="id", src="v"),
    norms="SELECT id, sqrt(sum(x * x)) AS norm FROM spread GROUP BY 1"))
def _(t):
    rows = vec.unit_vectors(item_vectors(t))
    return rows.select("id", F.posexplode("vec").alias("dim", "x")).withColumn("x", F.round("x", 6))


@query("pca")
def _(t):
    return vec.pca_scores(item_vectors(t), 0.9)


@query("chi2_select_k", with_views("", """
    SELECT dim AS feature, round(chi2, 6) AS chi2, row_number() OVER (ORDER BY round(chi2, 9) DESC, dim) AS rank FROM (
      SELECT tot.dim, sum(pow(o - share * s, 2) / (share * s)) AS chi2
      FROM tot JOIN obs ON obs.dim = tot.dim JOIN cls ON cls.label = obs.label GROUP BY 1)
    QUALIFY rank <= 2""",
    v=VEC, spread="SELECT id, label, unnest(generate_series(0, len(vec) - 1)) AS dim, unnest(vec) + 1 AS x FROM v",
    obs="SELECT label, dim, sum(x) AS o FROM spread GROUP BY 1, 2",
    tot="SELECT dim, sum(x) AS s FROM spread GROUP BY 1",
    cls="SELECT label, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM v) AS share FROM v GROUP BY 1"))
def _(t):
    rows = t.embeddings.select(
        F.col("vec_id").alias("id"), "label", F.posexplode("embedding").alias("feature", "x"))
    rows = rows.withColumn("x", F.col("x").cast("double") + 1)
    return fs.chi2_scores(rows, 2).withColumn("chi2", F.round("chi2", 6))


NUMERIC, CATEGORICAL = ["c_acctbal"], ["c_mktsegment", "c_nationkey"]
DICT = {
    "fields": """SELECT c_custkey, 'c_acctbal' AS field, 0 AS field_id, '' AS raw, c_acctbal AS value, CAST(c_acctbal AS VARCHAR) AS text FROM customer
        UNION ALL SELECT c_custkey, 'c_mktsegment', 1, c_mktsegment, 1.0, c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, 'c_nationkey', 2, CAST(c_nationkey AS VARCHAR), 1.0, CAST(c_nationkey AS VARCHAR) FROM customer""",
    "dict": """SELECT field, field_id, raw, row_number() OVER (ORDER BY field_id, raw) - 1 AS feat_id
        FROM (SELECT DISTINCT field, field_id, raw FROM fields)""",
    "xs": "SELECT f.*, d.feat_id FROM fields f JOIN dict d ON f.field_id = d.field_id AND f.raw = d.raw",
}


def _fields(t):
    return fs.long_fields(t.customer, "c_custkey", NUMERIC, CATEGORICAL)


@query("feature_dictionary", with_views("", "SELECT field, field_id, raw, feat_id FROM dict", **DICT))
def _(t):
    return fs.feature_dictionary(_fields(t))


@query("index_value_rows", with_views("", "SELECT c_custkey, field_id, feat_id, value FROM xs", **DICT))
def _(t):
    fields = _fields(t)
    return fs.index_value_rows(fields, fs.feature_dictionary(fields)).select(
        "c_custkey", "field_id", "feat_id", "value")


def _labelled_rows(t):
    fields = _fields(t)
    rows = fs.index_value_rows(fields, fs.feature_dictionary(fields))
    return rows.drop("value").withColumnRenamed("text", "value").withColumn("target", F.lit(0))


@query("write_libsvm", with_views("", """
    SELECT c_custkey, concat('0 ', string_agg(concat(feat_id, ':', text), ' ' ORDER BY feat_id)) AS line
    FROM xs GROUP BY 1""", **DICT))
def _(t):
    return files.libsvm_lines(_labelled_rows(t), ["c_custkey"], "target")


@query("write_libffm", with_views("", """
    SELECT c_custkey, concat('0 ', string_agg(concat(field_id, ':', feat_id, ':', text), ' ' ORDER BY field_id)) AS line
    FROM xs GROUP BY 1""", **DICT))
def _(t):
    return files.libffm_lines(_labelled_rows(t), ["c_custkey"], "target")


@query("multi_value_lookup", """
    WITH vocab AS (SELECT tag, row_number() OVER (ORDER BY tag) AS id
                   FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS tag FROM part)),
    tags AS (SELECT p_partkey, unnest(generate_series(0, 1)) AS pos, unnest(string_split(p_name, ' ')) AS tag FROM part)
    SELECT p_partkey, pos, coalesce(id, -1) AS code FROM tags LEFT JOIN vocab USING (tag)""")
def _(t):
    names = t.part.select("p_partkey", F.regexp_replace("p_name", " ", "|").alias("tags"))
    first = t.part.select(F.element_at(F.split("p_name", " "), 1).alias("tag"))
    vocab = label_codes(first, "tag", "id")
    return fs.lookup_ids(names, "p_partkey", F.split("tags", r"\|"), vocab)


POOLED = """SELECT user_id, dim, round(x / greatest(n, 1), 6) AS x FROM (
    SELECT user_id, dim, sum(coalesce(x, 0)) AS x, count(x) AS n FROM (
      SELECT m.user_id, d.dim, s.x FROM {members} m CROSS JOIN generate_series(0, 63) d(dim)
      LEFT JOIN spread s ON s.id = m.item_id AND s.dim = d.dim) GROUP BY 1, 2)"""


@query("mean_embedding", with_views("inter", POOLED.format(members="inter"),
    v=VEC, spread=SPREAD.format(key="id", src="v")))
def _(t):
    members = t.interactions.select(F.col("user_id").alias("key"), F.col("item_id").alias("id"))
    rows = vec.pooled(members, item_vectors(t))
    return rows.select(F.col("key").alias("user_id"), F.posexplode("vec").alias("dim", "x")).withColumn(
        "x", F.round("x", 6))


@query("pooled_user_vector", with_views("inter", POOLED.format(members="recent"),
    v=VEC, spread=SPREAD.format(key="id", src="v"), ordered=ORDERED,
    recent="SELECT user_id, item_id FROM ordered WHERE pos >= n - 20"))
def _(t):
    newest = ordered_items(t.interactions, size="n").where(F.col("pos") >= F.col("n") - 20)
    members = newest.select(F.col("user_id").alias("key"), F.col("item_id").alias("id"))
    rows = vec.pooled(members, item_vectors(t))
    return rows.select(F.col("key").alias("user_id"), F.posexplode("vec").alias("dim", "x")).withColumn(
        "x", F.round("x", 6))


@query("item_feature_vector", f"""
    SELECT p_partkey, array_to_string([{DECADE_SQL.format(x='1950 + p_size + 10')}] || {FLAGS_SQL}, ',') AS features FROM part""")
def _(t):
    year = F.lit(1950) + F.col("p_size") + 10
    row = fx.item_vector(year, F.split("p_name", " "), NAME_WORDS)
    return t.part.select("p_partkey", joined(row).alias("features"))


@query("user_feature_vector", f"""
    SELECT c_custkey, concat_ws(',', {SEX_SQL.format(x='substr(c_mktsegment, 1, 1)')},
           {AGE_SQL.format(x='c_nationkey * 3')}, c_nationkey) AS features FROM customer""")
def _(t):
    row = fx.user_vector(F.substring("c_mktsegment", 1, 1), F.col("c_nationkey") * 3, "c_nationkey")
    return t.customer.select("c_custkey", joined(row).alias("features"))


@query("slice_by_field", f"""
    SELECT p_partkey, unnest([0, 1]) AS field, unnest([array_to_string(({FLAGS_SQL})[1:8], ''),
           array_to_string(({FLAGS_SQL})[9:12], '')]) AS part FROM part""")
def _(t):
    flags = multi_hot(F.split("p_name", " "), NAME_WORDS)
    cut = t.part.select("p_partkey", F.posexplode(slice_by_lengths(flags, [8, 4])).alias("field", "_s"))
    return cut.select("p_partkey", "field", joined("_s", "").alias("part"))
