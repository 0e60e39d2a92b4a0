from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyrank.operators import featureset as fs, learning as ln, rules, text as tx

BASKETS = ["1,2,5", "1,2,3,5", "2,5", "4,8,9", "8,9", "6,7,8,9", "1,2,5,7", "3,5,6", "4,6,7", "2,3,5,8"]


@pytest.fixture(scope="module")
def baskets(spark):
    rows = [(k, item) for k, line in enumerate(BASKETS) for item in line.split(",")]
    return spark.createDataFrame(rows, "basket LONG, item STRING")


def test_rules_on_ten_baskets(baskets):
    sets, found = rules.mine_rules(baskets, 0.2, 0.5)
    lists = [set(b.split(",")) for b in BASKETS]
    for r in sets.collect():
        assert r.freq == sum(set(r["items"]) <= b for b in lists)
    want = {frozenset(c) for n in range(1, 5) for c in combinations("123456789", n)
            if sum(set(c) <= b for b in lists) >= 2}
    assert {frozenset(r["items"]) for r in sets.collect()} == want
    for r in found.collect():
        whole = sum(set(r.antecedent) | set(r.consequent) <= b for b in lists)
        assert r.confidence == pytest.approx(whole / sum(set(r.antecedent) <= b for b in lists))


def test_three_baskets_by_hand(spark):
    rows = [(0, "eggs"), (0, "bacon"), (0, "soup"), (1, "eggs"), (1, "bacon"), (1, "apple"),
            (2, "soup"), (2, "bacon"), (2, "banana")]
    _sets, found = rules.mine_rules(spark.createDataFrame(rows, "basket LONG, item STRING"), 0.5, 0.6)
    got = {(r.antecedent[0], r.consequent[0]): r.confidence for r in found.collect() if len(r.antecedent) == 1}
    assert got["eggs", "bacon"] == 1.0 and got["bacon", "eggs"] == pytest.approx(2 / 3)
    members = {(r["item"], r.other) for r in rules.rule_comembers(found).collect()}
    assert ("eggs", "bacon") in members and ("bacon", "eggs") in members


def test_triples_and_support(baskets):
    lists = [set(b.split(",")) for b in BASKETS]
    frequent = [i for i in "123456789" if sum(i in b for b in lists) / 10 >= 0.3]
    want = set(combinations(sorted(frequent), 3))
    assert {(r.a, r.b, r.c) for r in rules.item_triples(baskets, 0.3).collect()} == want
    got = {(r.a, r.b, r.c): r.n for r in rules.triple_support(baskets, 0.3).collect()}
    assert got == {c: n for c in want if (n := sum(set(c) <= b for b in lists))}


def test_bag_of_words_drops_stops_numbers_and_single_tokens(spark):
    docs = spark.createDataFrame([(1, "One Flew Over the Nest 1975"), (2, "Flew home 1975"), (3, "alone")], "id LONG, t STRING")
    assert [tuple(r) for r in tx.bag_of_words(docs, "id", "t").orderBy("id").collect()] == [(1, "flew", 1), (2, "flew", 1)]


def test_tf_idf_rows_have_unit_length(tables):
    rows = tx.tf_idf(tables.documents, "doc_id", tx.word_tokens("text"))
    sizes = rows.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s"))
    assert sizes.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_tag_lookup_marks_unknown(spark):
    vocab = spark.createDataFrame([("harden", 0), ("james", 1), ("paul", 4)], "tag STRING, id LONG")
    rows = spark.createDataFrame([(1, "harden|james|curry"), (3, "|paul|towns")], "id LONG, tags STRING")
    got = fs.lookup_ids(rows, "id", F.split("tags", r"\|"), vocab).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0), (1, 1, 1), (1, 2, -1), (3, 0, 4), (3, 1, -1)]


def test_chi2_counts_a_missing_class(spark):
    rows = [(k, k % 2, f, float(x)) for k in range(6) for f, x in ((0, 3 if k % 2 else 0), (1, 1))]
    df = spark.createDataFrame([r for r in rows if r[3] > 0], "id LONG, label INT, feature INT, x DOUBLE")
    got = {r.feature: r.chi2 for r in fs.chi2_scores(df, 2).collect()}
    assert got[0] == pytest.approx(9.0) and got[1] == pytest.approx(0.0)


def test_one_hot_places_of_a_wide_field(spark):
    wide = spark.range(fs.MAX_ONE_HOT + 5).select((F.col("id") * 3).alias("x")).unionByName(spark.createDataFrame([(None,), (3,)], "x LONG"))
    values, rows = fs.one_hot_places(wide, "x")
    assert values.count() == fs.MAX_ONE_HOT + 5 and rows.count() == fs.MAX_ONE_HOT + 7
    assert rows.where("width <> 10005 OR (x IS NULL) <> (place IS NULL) OR place * 3 <> x").count() == 0
    assert fs.one_hot_places(wide.where("x < 0"), "x")[1].count() == 0


def test_one_hot_refuses_wide_fields(spark):
    with pytest.raises(ValueError):
        fs.one_hot(spark.range(fs.MAX_ONE_HOT + 1), "id", "x")


def test_cluster_draw_has_no_repeats(spark, tables):
    users = tables.customer.select(F.col("c_custkey").alias("user_id"), F.pmod("c_custkey", F.lit(7)).alias("cluster"))
    got = ln.cluster_draw(users, tables.interactions, 10)
    assert got.groupBy("user_id").agg(F.countDistinct("item_id").alias("d"), F.count("*").alias("n")).where("d <> n or n <> 10").count() == 0


def test_rules_have_consequents_of_any_size(spark):
    baskets = ["abc"] * 6 + ["ab"] * 2 + ["c"] * 2 + ["abd"]
    rows = [(i, item) for i, basket in enumerate(baskets) for item in basket]
    sets, found = rules.mine_rules(spark.createDataFrame(rows, "basket INT, item STRING"), 0.3, 0.6)
    support = {"".join(r["items"]): r.freq for r in sets.collect()}
    want = set()
    for whole, n in support.items():
        for split in range(1, 2 ** len(whole) - 1):
            left = "".join(c for k, c in enumerate(whole) if split >> k & 1)
            if n / support[left] >= 0.6:
                want.add((left, "".join(c for c in whole if c not in left), n / support[left], n / 11))
    got = {("".join(r.antecedent), "".join(r.consequent), r.confidence, r.support) for r in found.collect()}
    assert got == want and any(len(c) == 2 for _, c, _, _ in got)
