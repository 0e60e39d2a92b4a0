"""Frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.ranking import dense_index
from tallyrank.session import hold


def frequent_items(baskets: DataFrame, min_support: float) -> DataFrame:
    """(item, n) with n / baskets >= min_support over distinct (basket, item) rows.

    The supports of all items add up to the mean basket size, so at most mean basket
    size / min_support items pass: the only rows later steps combine.
    """
    total = baskets.agg(F.countDistinct("basket")).scalar()
    counts = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") / total >= min_support)


def item_triples(baskets: DataFrame, min_support: float = 0.4) -> DataFrame:
    """All three-item combinations (a, b, c) of the frequent items, in item order.

    Items are numbered and each is joined with the numbers behind it, so the combinations
    are made row by row in as many tasks as there are numbers.
    """
    items = hold(dense_index(frequent_items(baskets, min_support).select("item"), "item", "idx"))
    last = F.lit(items.count() - 1).cast("bigint")

    def behind(rows: DataFrame, name: str) -> DataFrame:
        ahead = rows.where(F.col("idx") < last).withColumn("idx", F.explode(F.sequence(F.col("idx") + 1, last)))
        return ahead.join(items.withColumnRenamed("item", name), "idx")

    pairs = behind(items.withColumnRenamed("item", "a"), "b")
    return behind(pairs, "c").select("a", "b", "c")


def triple_support(baskets: DataFrame, min_support: float = 0.4) -> DataFrame:
    """(a, b, c, n): baskets holding each combination of three frequent items, in item order.

    Baskets are cut to their frequent items, whose number is bounded, and joined with themselves
    by basket, so combinations are rows and are summed before they are shuffled.
    """
    kept = hold(baskets.join(frequent_items(baskets, min_support).select("item"), "item", "left_semi").select("basket", "item"))
    named = lambda name: kept.select("basket", F.col("item").alias(name))
    pairs = named("a").join(named("b"), "basket").where("a < b")
    return pairs.join(named("c"), "basket").where("b < c").groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))


def mine_rules(baskets: DataFrame, min_support: float, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """(frequent itemsets (items, freq), rules (antecedent, consequent, confidence, support)).

    Itemsets come from parallel FP-growth. Items below the support cannot be in a frequent set
    and are left out of the lists, so a list is no longer than the bounded number of frequent
    items; every basket stays. Every split of a frequent set into two non-empty sides is a
    rule if it holds often enough; the counts of both sides come from the itemsets, since each
    part of a frequent set is frequent.
    """
    passing = frequent_items(baskets, min_support).select("item", F.lit(True).alias("_ok"))
    marked = baskets.join(passing, "item", "left")
    lists = hold(marked.groupBy("basket").agg(F.collect_set(F.when(F.col("_ok"), F.col("item"))).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(lists)
    sets = hold(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    total = lists.count()
    size = F.size("items")
    splits = sets.where(size > 1).withColumn("_split", F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), size).cast("int") - 2)))
    side = lambda bit: F.filter("items", lambda _x, i: F.getbit(F.col("_split"), i) == bit)
    splits = splits.select(side(1).alias("antecedent"), side(0).alias("consequent"), "freq")
    known = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_n"))
    found = splits.join(known, "antecedent").withColumn("confidence", F.col("freq") / F.col("_n"))
    found = found.where(F.col("confidence") >= min_confidence)
    return sets, found.select("antecedent", "consequent", "confidence", (F.col("freq") / F.lit(max(total, 1))).alias("support"))


def rule_comembers(rules: DataFrame) -> DataFrame:
    """(item, other): items that occur together in some rule.

    A rule holds a handful of items, so its members are paired in place.
    """
    members = F.concat("antecedent", "consequent")
    item = rules.select(members.alias("m"), F.explode(members).alias("item"))
    return item.select("item", F.explode("m").alias("other")).where(
        F.col("item") != F.col("other")
    ).distinct()
