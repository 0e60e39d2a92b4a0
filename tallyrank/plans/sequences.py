"""Sampling and sequence construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrank.functions.arrays import flag_indices, joined, multi_hot, pad_to
from tallyrank.operators import sampling as sp
from tallyrank.operators import sequences as sq
from tallyrank.operators.relational import history_chunks
from tallyrank.operators.splits import frequency_vocab, label_codes, last_items
from tallyrank.plans.registry import REGISTRY, with_views
from tallyrank.session import hold

query = REGISTRY.query

ORDERED = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos,
    count(*) OVER (PARTITION BY user_id) AS n FROM inter"""


def _hist(column: str, length: int) -> str:
    return f"""list_reverse(list({column}) OVER (PARTITION BY user_id ORDER BY pos
        ROWS BETWEEN {length} PRECEDING AND 1 PRECEDING))"""


def _padded(expr: str, length: int, fill: str = "0") -> str:
    return f"array_to_string(({expr} || list_resize([{fill}], {length}, {fill}))[1:{length}], ',')"


@query("prefix_samples", with_views("inter", """
    SELECT user_id, pos, item_id, 1 AS label, pos AS hist_len, rating, CAST(part AS BIGINT) AS part,
           array_to_string(list_reverse(h[CAST(greatest(0, (last - part) * 20) AS INT) + 1 : CAST(least(pos, (last - part) * 20 + 20) AS INT)]), ',') AS hist,
           CASE WHEN pos = n - 1 THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, unnest(range(0, last + 1)) AS part FROM samples WHERE pos >= 1)""",
    ordered=ORDERED, samples="""SELECT *, (pos - 1) // 20 AS last, list(item_id) OVER (PARTITION BY user_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM ordered"""))
def _(t):
    rows = sq.whole_prefix_samples(t.interactions, 20)
    return rows.withColumn("hist", joined("hist"))


@query("pad_sequence", with_views("inter", f"""
    SELECT user_id, pos, {_padded('h', 20)} AS hist FROM samples WHERE pos >= 1""",
    ordered=ORDERED, samples=f"SELECT *, {_hist('item_id', 20)} AS h FROM ordered"))
def _(t):
    rows = sq.prefix_samples(t.interactions, 20)
    return rows.select("user_id", "pos", joined(pad_to("hist_item_id", 20)).alias("hist"))


@query("short_long_sessions", with_views("inter", f"""
    SELECT user_id, pos, item_id, least(pos, 5) AS short_len, greatest(pos - 5, 0) AS long_len,
           {_padded('h[1:5]', 5)} AS short_items, {_padded('h[6:55]', 50)} AS long_items,
           {_padded('c[1:5]', 5, "'0'")} AS short_cats, {_padded('c[6:55]', 50, "'0'")} AS long_cats
    FROM samples WHERE pos >= 1""",
    ordered="""SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) - 1 AS pos
               FROM inter JOIN part ON p_partkey = item_id""",
    samples=f"SELECT *, {_hist('item_id', 55)} AS h, {_hist('p_type', 55)} AS c FROM ordered"))
def _(t):
    rows = sq.prefix_samples(t.interactions.join(t.item_category, "item_id"), 55, ("item_id", "category"))
    rows = sq.session_lengths(sq.short_long(sq.short_long(rows, "item_id"), "category", fill="0", element="string"))
    return rows.select(
        "user_id", "pos", "item_id", "short_len", "long_len",
        joined("short_item_id").alias("short_items"), joined("long_item_id").alias("long_items"),
        joined("short_category").alias("short_cats"), joined("long_category").alias("long_cats"),
    )


@query("masked_history", with_views("inter", f"""
    SELECT user_id, k, {_padded('h', 20)} AS hist, CAST(len(h) AS DOUBLE) AS mask_sum FROM (
      SELECT user_id, k, coalesce(list(item_id ORDER BY pos) FILTER (pos < k AND pos >= k - 20), []) AS h
      FROM (SELECT *, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS k FROM ordered) GROUP BY 1, 2)""", ordered=ORDERED))
def _(t):
    rows = sq.masked_history(t.interactions, 20, 0.8)
    total = F.aggregate("mask", F.lit(0.0), lambda a, x: a + x)
    return rows.select("user_id", "k", joined("hist").alias("hist"), total.alias("mask_sum"))


@query("training_cutpoint", with_views("inter", """
    SELECT user_id, pos AS k, item_id FROM ordered
    WHERE n > 4 AND pos = 4 + CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % (n - 4)""",
    ordered=ORDERED))
def _(t):
    return sq.training_cutpoints(t.interactions)


# Draw number t of a positive hits catalogue position hash(user, item, t) mod catalogue size.
TRIES = """SELECT p.user_id, p.item_id, d.t, CAST('0x' || substr(md5(concat(p.user_id, '-', p.item_id, '-', d.t)), 1, 8)
    AS BIGINT) % (SELECT count(*) FROM part) AS pos FROM {src} p, generate_series(0, {last}) d(t)"""
DRAWS = """SELECT h.user_id, h.item_id, h.t, i.item_id AS neg FROM tries h JOIN idx i USING (pos)
    ANTI JOIN inter s ON s.user_id = h.user_id AND s.item_id = i.item_id"""
IDX = "SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part"
KEEP = """SELECT user_id, item_id, rank, neg FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, item_id ORDER BY t) AS rank FROM {src}) WHERE rank <= {n}"""
DISTINCT = "SELECT user_id, item_id, neg, min(t) AS t FROM draws GROUP BY 1, 2, 3"
LAST = """SELECT user_id, item_id FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC, item_id) AS r FROM inter) WHERE r = 1"""


@query("negatives_without_replacement", with_views(
    "train", KEEP.format(src="once", n=4), idx=IDX, tries=TRIES.format(src="train", last=47), draws=DRAWS, once=DISTINCT))
def _(t):
    return sp.sample_negatives(t.train, t.interactions, t.item_category, 4)


@query("negatives_test_99", with_views(
    "inter", KEEP.format(src="once", n=99), idx=IDX, held=LAST,
    tries=TRIES.format(src="held", last=427), draws=DRAWS, once=DISTINCT))
def _(t):
    return sp.sample_negatives(last_items(t.interactions), t.interactions, t.item_category, 99)


@query("negatives_rejection", with_views(
    "train", KEEP.format(src="draws", n=4), idx=IDX, tries=TRIES.format(src="train", last=47), draws=DRAWS))
def _(t):
    return sp.sample_negatives(t.train, t.interactions, t.item_category, 4, distinct=False)


@query("bpr_triples", with_views(
    "inter", f"SELECT user_id, item_id, neg FROM ({KEEP.format(src='draws', n=1)})", idx=IDX, held=LAST,
    pos="SELECT user_id, item_id FROM inter ANTI JOIN held USING (user_id, item_id)",
    tries=TRIES.format(src="pos", last=35), draws=DRAWS))
def _(t):
    return sp.bpr_triples(t.interactions, last_items(t.interactions), t.item_category)


@query("bpr_eval_triples", with_views("inter", """
    SELECT user_id, h.item_id, prev + 1 AS first_pos, pos - 1 AS last_pos, pos - prev - 1 AS n_items FROM (
      SELECT user_id, pos, coalesce(lag(pos) OVER (PARTITION BY user_id ORDER BY pos), -1) AS prev FROM marks)
    JOIN held h USING (user_id) WHERE pos > prev + 1""",
    idx=IDX, held=LAST,
    marks="""SELECT user_id, pos FROM inter JOIN idx USING (item_id)
             UNION ALL SELECT DISTINCT user_id, (SELECT count(*) FROM part) FROM inter"""))
def _(t):
    return sp.bpr_eval_runs(t.interactions, last_items(t.interactions), t.item_category)


SAMPLED = {
    "ordered": ORDERED, "idx": IDX, "pos": "SELECT user_id, item_id FROM ordered WHERE pos >= 1 AND pos < n - 1",
    "tries": TRIES.format(src="pos", last=43), "draws": DRAWS, "kept": KEEP.format(src="draws", n=3),
    "pointers": """
    SELECT user_id, pos, item_id, 1 AS label, pos AS hist_len, rating, CASE WHEN pos = n - 1 THEN 'test' ELSE 'train' END AS split,
           CAST(0 AS BIGINT) AS draw FROM ordered WHERE pos >= 1
    UNION ALL SELECT user_id, o.pos, k.neg, 0, o.pos, NULL, 'train', CAST(k.rank AS BIGINT) FROM ordered o JOIN kept k USING (user_id, item_id)
    WHERE o.pos >= 1""",
}


def _pointers(t):
    samples = hold(sq.sample_pointers(t.interactions))
    positives = samples.where("split = 'train'")
    return sq.with_negatives(samples, sp.sample_negatives(positives, t.interactions, t.item_category, 3, distinct=False))


@query("prefix_sample_pointers", with_views("inter", "SELECT * FROM pointers", **SAMPLED))
def _(t):
    """Samples with three negatives each, as pointers into the histories."""
    return _pointers(t)


@query("prefix_samples_labelled", with_views("inter", """
    SELECT p.*, CAST(part AS BIGINT) AS part, array_to_string(list_reverse(h[CAST(greatest(0, p.pos - 50, (last - part) * 20) AS INT) + 1 :
           CAST(least(p.pos, (last - part) * 20 + 20) AS INT)]), ',') AS hist
    FROM pointers p JOIN (SELECT *, unnest(range(0, last - greatest(pos - 50, 0) // 20 + 1)) AS part FROM samples WHERE pos >= 1) s USING (user_id, pos)""",
    **SAMPLED, samples="""SELECT user_id, pos, (pos - 1) // 20 AS last, list(item_id) OVER (PARTITION BY user_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM ordered"""))
def _(t):
    """The same samples with the newest 50 items read from history parts of 20."""
    rows = sq.read_histories(_pointers(t), history_chunks(t.interactions, ["item_id"], 20), 20, 50)
    return rows.withColumn("hist", joined("hist"))


@query("log_negatives", """
    SELECT conv_id, turn, unnest(generate_series(0, 3)) AS pos, unnest(others[1:4]) AS neg FROM (
      SELECT conv_id, turn, list_filter(list_distinct_ordered, lambda w: w <> list_distinct_ordered[1]) AS others FROM (
        SELECT conv_id, turn, list_filter(words, lambda w, i: list_position(words, w) = i) AS list_distinct_ordered FROM (
          SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '[ \\n\\t\\r]+'), lambda w: w <> '') AS words
          FROM conversations))) WHERE len(others) >= 4""")
def _(t):
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[ \n\t\r]+"), lambda w: w != ""))
    chance = F.transform(F.sequence(F.lit(1), F.size("words")), lambda k: 1.0 / k)
    log = (
        t.conversations.withColumn("words", words).where(F.size("words") > 0)
        .withColumn("title", F.element_at("words", 1))
        .withColumn("prediction", F.to_json(F.map_from_arrays(F.col("words"), chance)))
    )
    parsed = log.withColumn("shown", F.from_json("prediction", "map<string,double>"))
    kept = sp.log_negatives(parsed, "shown", "title", 4)
    return kept.select("conv_id", "turn", F.posexplode("negatives").alias("pos", "neg"))


@query("unigram_negatives", with_views("train", """
    SELECT d.user_id, d.item_id, d.t, v.item_id AS neg FROM draws d
    JOIN vocab v ON d.x >= v.hi - v.p AND d.x < v.hi""",
    counted="SELECT item_id, count(*) AS n FROM train GROUP BY 1",
    vocab="""SELECT item_id, pow(n, 0.75) AS p, sum(pow(n, 0.75)) OVER (ORDER BY n DESC, item_id) AS hi FROM counted""",
    draws="""SELECT user_id, item_id, t, CAST('0x' || substr(md5(concat(user_id, '-', item_id, '-', t)), 1, 13) AS BIGINT)
             / 4503599627370496.0 * (SELECT max(hi) FROM vocab) AS x FROM train, generate_series(0, 1) g(t)"""))
def _(t):
    return sp.unigram_negatives(t.train, frequency_vocab(t.train, "item_id"), 2)


@query("item_pairs", with_views("baskets", """
    SELECT x.item AS a, y.item AS b, count(*) AS n FROM baskets x JOIN baskets y
    ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2"""))
def _(t):
    return sq.item_pairs(t.baskets, "basket", "item")


@query("exclude_target_from_history", with_views("inter", """
    SELECT user_id, n - 1 AS num, np // 100 AS part, array_to_string((list(item ORDER BY np) ||
           list_resize([(SELECT count(*) FROM part)], 100, (SELECT count(*) FROM part)))[1:100], ',') AS items
    FROM (SELECT o.user_id, o.n, CASE WHEN o.pos = a.p THEN o.n - 1 WHEN o.pos = o.n - 1 THEN a.p ELSE o.pos END AS np,
                 CASE WHEN o.pos = a.p THEN (SELECT count(*) FROM part) ELSE o.item_id END AS item
          FROM ordered o JOIN aim a USING (user_id)) GROUP BY 1, 2, 3""",
    ordered=ORDERED, held=LAST,
    aim="SELECT user_id, pos AS p FROM ordered JOIN held USING (user_id, item_id)"))
def _(t):
    mask = t.part.agg(F.count(F.lit(1))).scalar()
    parts = sq.exclude_target(t.interactions, last_items(t.interactions), mask)
    return parts.select("user_id", "num", "part", joined("items").alias("items"))


@query("char_ids_unk_pad", """
    SELECT conv_id, turn, array_to_string((list_transform(string_split(substr(text, 1, 10), ''),
             lambda c: coalesce((map_ids[c]), 1)) || [0,0,0,0,0,0,0,0,0,0])[1:10], ',') AS ids
    FROM conversations, (SELECT map(list(ch), list(id)) AS map_ids FROM (
      SELECT ch, row_number() OVER (ORDER BY ch) + 1 AS id FROM (
        SELECT ch FROM (SELECT unnest(string_split(text, '')) AS ch FROM conversations) WHERE ch <> ''
        GROUP BY 1 HAVING count(*) > 200)))""")
def _(t):
    chars = t.conversations.select(F.explode(F.split("text", "")).alias("ch")).where(F.col("ch") != "")
    common = chars.groupBy("ch").count().where(F.col("count") > 200).select("ch")
    vocab = label_codes(common, "ch", "id").withColumn("id", F.col("id") + 1)
    rows = sp.char_ids(t.conversations, ["conv_id", "turn"], "text", vocab)
    return rows.select("conv_id", "turn", joined("ids").alias("ids"))


NAME_WORDS = ["large", "small", "old", "new", "hot", "cold", "red", "blue", "anvil", "ring", "plate", "bolt"]


@query("multi_hot_indices", f"""
    SELECT p_partkey, unnest(list_filter(list_transform({NAME_WORDS},
      lambda w, i: CASE WHEN list_contains(string_split(p_name, ' '), w) THEN i - 1 ELSE -1 END), lambda i: i >= 0)) AS idx
    FROM part""")
def _(t):
    flags = multi_hot(F.split("p_name", " "), NAME_WORDS)
    return t.part.select("p_partkey", F.explode(flag_indices(flags)).alias("idx"))
