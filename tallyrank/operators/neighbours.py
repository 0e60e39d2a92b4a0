"""Neighbourhood recommenders: item and user similarities, predictions and top-N lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.fused import top_unseen
from tallyrank.operators.gram import HEAVY_GROUP, mirror, pair_sums, product_sums
from tallyrank.operators.ranking import top_k
from tallyrank.session import hold

TIE_DIGITS = 9  # scores are ranked after rounding here, then by id, so ties are stable
#: Votes of a user that one task adds up, votes of a partition, and lists that are sent to the users.
HEAVY_VOTES, PARTITION_VOTES, FEW_LISTS = 1 << 18, 1 << 20, 4096


def _weighted(inter: DataFrame, key: str, other: str, penalty: bool) -> DataFrame:
    """Rows with the factor x whose products sum to the normalised co-count.

    x = sqrt(weight of ``other``) / sqrt(count of ``key``). The counts are attached to
    the interactions, not to the far larger set of pairs.
    """
    sizes = inter.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows = inter.select(key, other).join(sizes, key)
    x = 1.0 / F.sqrt("_n")
    if penalty:
        active = inter.groupBy(other).agg((1.0 / F.log(1.0 + F.count(F.lit(1)))).alias("_w"))
        rows = rows.join(active, other)
        x = x * F.sqrt("_w")
    return rows.select(key, other, x.alias("x"))


def item_similarity(inter: DataFrame, active_user_penalty: bool = False, heavy: int = HEAVY_GROUP) -> DataFrame:
    """(a, b, w), a < b: users with both items over sqrt(n_a * n_b).

    With the penalty each user counts 1 / ln(1 + items of the user).
    """
    rows = _weighted(inter, "item_id", "user_id", active_user_penalty)
    pairs = pair_sums(rows, "user_id", "item_id", "x", heavy)
    return pairs.select("a", "b", F.col("value").alias("w"))


def user_similarity(inter: DataFrame, popular_item_penalty: bool = False, heavy: int = HEAVY_GROUP) -> DataFrame:
    """(a, b, w), a < b: common items over sqrt(items_a * items_b), same penalty per item."""
    rows = _weighted(inter, "user_id", "item_id", popular_item_penalty)
    pairs = pair_sums(rows, "item_id", "user_id", "x", heavy)
    return pairs.select("a", "b", F.col("value").alias("w"))


def neighbours(pairs: DataFrame, k: int, weight: str = "w") -> DataFrame:
    """The ``k`` strongest partners j of each i."""
    both = mirror(pairs.select("a", "b", weight))
    order = [F.desc(F.round(weight, TIE_DIGITS)), F.asc("j")]
    return top_k(both, ["i"], order, k, "_r").drop("_r")


def best_unseen(scores: DataFrame, seen: DataFrame | None, n: int) -> DataFrame:
    """Top ``n`` items per user by score, without items in ``seen``.

    The anti-join is on (user, item), the key the scores were just aggregated on.
    """
    if seen is not None:
        scores = scores.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    order = [F.desc(F.round("score", TIE_DIGITS)), F.asc("item_id")]
    return top_k(scores, ["user_id"], order, n)


def _best_votes(owners: DataFrame, lists: DataFrame, loads: DataFrame, n: int, own: bool) -> DataFrame:
    """Top ``n`` items per user by the sum of x * y over the lists that the user's rows name.

    ``owners`` is (user_id, key, x, seen), ``lists`` (key, ids, ys), ``loads`` (user_id, votes): how many votes a user gets.
    Items of rows that are ``seen``, and with ``own`` the keys themselves, are left out. Lists travel whole, once, to
    their user's partition, where votes are added up and ranked; a few lists go to partitioned owners instead. A user with
    over HEAVY_VOTES votes is dealt to copies by item, and a partition gets about PARTITION_VOTES votes.
    """
    spark, keys = owners.sparkSession, ["user_id"]
    most, total = loads.agg(F.max("votes"), F.sum("votes")).first()
    parts = max(spark.sparkContext.defaultParallelism, -(-int(total or 0) // PARTITION_VOTES))
    few, heavy = lists.count() <= FEW_LISTS, (most or 0) > HEAVY_VOTES
    if heavy:
        hot = loads.where(F.col("votes") > HEAVY_VOTES).select(
            F.col("user_id").alias("_u"), F.ceil(F.col("votes") / HEAVY_VOTES).cast("int").alias("_copies"))
        owners = owners.join(hot, F.col("user_id").eqNullSafe(F.col("_u")), "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
        owners = owners.drop("_u").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
        keys.append("_part")
    if few:
        owners = owners.repartition(parts, *keys)
    rows = owners.join(lists, "key", "left")
    seen = F.col("seen")
    if own:
        known = F.col("user_id").isNotNull()
        rows = rows.withColumns({
            "ids": F.when(known, F.concat(F.coalesce("ids", F.array().cast(rows.schema["ids"].dataType)), F.array("key"))).otherwise(F.col("ids")),
            "ys": F.when(known, F.concat(F.coalesce("ys", F.array().cast("array<double>")), F.array(F.lit(0.0)))).otherwise(F.col("ys"))})
        seen = seen | F.coalesce(known & (F.col("item_id") == F.col("key")), F.lit(False))
    if heavy:
        mine = F.filter(F.arrays_zip("ids", "ys"), lambda v: F.pmod(F.xxhash64(v["ids"]), F.col("_copies")) == F.col("_part"))
        rows = rows.withColumn("_mine", F.when(F.col("_copies") > 1, mine).otherwise(F.arrays_zip("ids", "ys")))
        rows = rows.withColumns({"ids": F.col("_mine.ids"), "ys": F.col("_mine.ys")})
    rows = rows.select(*keys, "key", "x", "seen", "ids", "ys")
    if not few:
        rows = rows.repartition(parts, *keys)
    votes = rows.select(*keys, "key", "x", "seen", F.explode(F.arrays_zip("ids", "ys")).alias("_v"))
    votes = votes.select(*keys, F.col("_v.ids").alias("item_id"), (F.col("x") * F.col("_v.ys")).alias("_vote"), "key", "seen")
    votes = votes.where(F.col("item_id").isNotNull() | ~F.col("seen"))  # no item is known to equal a null
    scores = votes.groupBy(*keys, "item_id").agg(F.sum("_vote").alias("score"), F.max(seen).alias("_seen")).where(~F.col("_seen"))
    order = [F.desc(F.round("score", TIE_DIGITS)), F.asc("item_id")]
    best = top_k(scores.drop("_seen"), keys, order, n)
    return top_k(best.drop("rank", "_part"), ["user_id"], order, n) if heavy else best


def item_cf_recommend(train: DataFrame, pairs: DataFrame, k: int = 20, n: int = 10) -> DataFrame:
    """Each seen item votes for its k nearest items with weight * rating; seen items go last,
    after the cut to k."""
    near = neighbours(pairs, k)
    lists = hold(near.groupBy(F.col("i").alias("key")).agg(F.collect_list(F.struct("j", F.col("w").cast("double").alias("w"))).alias("_l")).select(
        "key", F.col("_l.j").alias("ids"), F.col("_l.w").alias("ys")))
    owners = train.select("user_id", F.col("item_id").alias("key"), F.col("rating").alias("x"), F.lit(False).alias("seen")).where(F.col("key").isNotNull())
    loads = hold(train.groupBy("user_id").agg((F.count(F.lit(1)) * k).alias("votes")))
    return _best_votes(owners, lists, loads, n, own=True)


def user_cf_recommend(
    train: DataFrame, pairs: DataFrame, k: int = 20, n: int = 10, implicit: bool = False
) -> DataFrame:
    """The k nearest users vote for their items with weight * rating, or weight alone."""
    near = hold(neighbours(pairs, k))
    sizes = hold(train.groupBy(F.col("user_id").alias("key")).agg(F.count(F.lit(1)).alias("_n")))
    y = F.lit(1.0) if implicit else F.col("rating").cast("double")
    # a long history comes in parts
    theirs = train.select(F.col("user_id").alias("key"), "item_id", y.alias("y")).join(sizes, "key").withColumn(
        "_c", F.pmod(F.xxhash64("item_id"), F.ceil(F.col("_n") / HEAVY_GROUP)))
    lists = hold(theirs.groupBy("key", "_c").agg(F.collect_list(F.struct("item_id", "y")).alias("_l")).select(
        "key", F.col("_l.item_id").alias("ids"), F.col("_l.y").alias("ys")))
    owners = near.select(F.col("i").alias("user_id"), F.col("j").alias("key"), F.col("w").alias("x"), F.lit(False).alias("seen"))
    own = owners.select("user_id").distinct().select("user_id", F.col("user_id").alias("key"), F.lit(0.0).alias("x"), F.lit(True).alias("seen"))
    owners = owners.unionByName(own)
    loads = hold(owners.join(sizes, "key").groupBy("user_id").agg(F.sum("_n").alias("votes")))
    return _best_votes(owners, lists, loads, n, own=False)


def dense_cosine(inter: DataFrame, key: str = "item_id", other: str = "user_id", heavy: int = HEAVY_GROUP) -> DataFrame:
    """(a, b, w), a < b: cosine of the rating vectors of two keys."""
    norms = inter.groupBy(key).agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("_norm"))
    rows = inter.join(norms, key).select(key, other, (F.col("rating") / F.col("_norm")).alias("x"))
    return pair_sums(rows, other, key, "x", heavy).select("a", "b", F.col("value").alias("w"))


def with_diagonal(pairs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(i, j, w) in both directions plus w = 1 for every key with itself."""
    own = keys.select(F.col(key).alias("i"), F.col(key).alias("j"), F.lit(1.0).alias("w"))
    return mirror(pairs.select("a", "b", "w")).unionByName(own)


def predict_by_items(inter: DataFrame) -> DataFrame:
    """(user_id, item_id, pred) = sum_j r_uj s_ji / sum_j |s_ij|, similarity to itself 1."""
    sim = with_diagonal(dense_cosine(inter), inter.select("item_id").distinct(), "item_id")
    weight = sim.groupBy(F.col("i").alias("item_id")).agg(F.sum(F.abs("w")).alias("_total"))
    left = inter.select(F.col("item_id").alias("g"), F.col("user_id").alias("a"), F.col("rating").alias("x"))
    right = sim.select(F.col("j").alias("g"), F.col("i").alias("b"), F.col("w").alias("x"))
    sums = product_sums(left, right).select(
        F.col("a").alias("user_id"), F.col("b").alias("item_id"), "value"
    )
    return sums.join(weight, "item_id").select(
        "user_id", "item_id", (F.col("value") / F.col("_total")).alias("pred")
    )


def recommend_by_items(inter: DataFrame, n: int = 20) -> DataFrame:
    """(user_id, item_id, rank, score): the unseen items with the largest ``predict_by_items``, without the table of all
    predictions: each cell of users and items keeps n per user."""
    sim = with_diagonal(dense_cosine(inter), inter.select("item_id").distinct(), "item_id")
    weight = sim.groupBy(F.col("i").alias("t")).agg(F.sum(F.abs("w")).alias("_total"))
    weights = sim.select("j", F.col("i").alias("t"), "w").join(weight, "t").select("j", "t", (F.col("w") / F.col("_total")).alias("w"))
    return top_unseen(inter, hold(weights), n, value="rating")


def predict_by_users(inter: DataFrame) -> DataFrame:
    """(user_id, item_id, pred) = mean_u + sum_v s_uv (r_vi - mean_v) / sum_v |s_uv|.

    Means run over all items with 0 for unrated ones. Ratings are not negative, so with
    x = r / norm the user similarity is x x' and its products regroup: sum_v s_uv r_vi =
    sum_k x_uk (sum_v x_vk r_vi). The inner sum is an item by item table, so the users x
    users similarity, the largest object of the textbook form, is never built.
    """
    n_items = inter.agg(F.countDistinct("item_id")).scalar()
    users = inter.groupBy("user_id").agg(
        F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"),
        (F.sum("rating") / n_items).alias("mean"),
    )
    rows = inter.join(users, "user_id").withColumn("x", F.col("rating") / F.col("norm"))
    halves = rows.select("user_id", "item_id", (F.col("rating") / F.sqrt("norm")).alias("y"))
    off = pair_sums(halves, "user_id", "item_id", "y")
    own = halves.groupBy(F.col("item_id").alias("i")).agg(F.sum(F.col("y") * F.col("y")).alias("value"))
    table = mirror(off.select("a", "b", "value")).unionByName(
        own.select("i", F.col("i").alias("j"), "value")
    )
    per_item = rows.groupBy("item_id").agg(
        F.sum(F.col("x") * F.col("mean")).alias("h"), F.sum("x").alias("q")
    )
    base = (
        rows.join(per_item, "item_id")
        .groupBy("user_id")
        .agg(
            F.first("mean").alias("mean"),
            F.sum(F.col("x") * F.col("h")).alias("shift"),
            F.sum(F.col("x") * F.col("q")).alias("total"),
        )
    )
    left = rows.select(F.col("item_id").alias("g"), F.col("user_id").alias("a"), "x")
    right = table.select(F.col("i").alias("g"), F.col("j").alias("b"), F.col("value").alias("x"))
    sums = product_sums(left, right).select(
        F.col("a").alias("user_id"), F.col("b").alias("item_id"), "value"
    )
    pred = F.col("mean") + (F.col("value") - F.col("shift")) / F.col("total")
    return sums.join(base, "user_id").select("user_id", "item_id", pred.alias("pred"))


def topn_unseen(predictions: DataFrame, seen: DataFrame, n: int = 20) -> DataFrame:
    return best_unseen(predictions.withColumnRenamed("pred", "score"), seen, n)


def weighted_rating(inter: DataFrame, as_coded: bool = False) -> DataFrame:
    """(item_id, score): v/(v+m) * R + m/(v+m) * C with m and C averaged over items.

    ``as_coded`` keeps each item's distinct ratings only and weights the second term
    with C instead of m.
    """
    rows = inter.select("item_id", "rating")
    if as_coded:
        rows = rows.distinct()
    items = rows.groupBy("item_id").agg(
        F.avg("rating").alias("r"), F.count(F.lit(1)).cast("double").alias("v")
    )
    c = items.agg(F.avg("r")).scalar()
    m = items.agg(F.avg("v")).scalar()
    second = c if as_coded else m
    score = F.col("v") / (F.col("v") + m) * F.col("r") + second / (F.col("v") + m) * c
    return items.select("item_id", score.alias("score"))


def content_cosine(features: DataFrame, rate: float = 0.001) -> DataFrame:
    """(a, b, w), a < b: (x.y + rate) / (|x| |y|) over (item_id, feature, x) rows.

    Pairs sharing no feature all have rate / (|x| |y|) and are not listed.
    """
    norms = features.groupBy("item_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    pairs = pair_sums(features, "feature", "item_id", "x")
    left = norms.select(F.col("item_id").alias("a"), F.col("norm").alias("na"))
    right = norms.select(F.col("item_id").alias("b"), F.col("norm").alias("nb"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", ((F.col("value") + rate) / (F.col("na") * F.col("nb"))).alias("w")
    )


def content_scores(inter: DataFrame, features: DataFrame, rate: float = 0.001) -> DataFrame:
    """(user_id, item_id, score): mean content cosine of an item to the user's rated items.

    The mean over rated items c of (x.c + rate) / (|x| |c|) equals
    (x . sum c/|c| + rate * sum 1/|c|) / (n |x|): one profile vector per user replaces
    the users x items x rated-items triples. Items sharing no feature with anything the
    user rated all have the bare rate term and are not listed.
    """
    norms = features.groupBy("item_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    history = inter.select("user_id", "item_id").join(norms, "item_id")
    base = history.groupBy("user_id").agg(
        F.sum(1.0 / F.col("norm")).alias("inv"), F.count(F.lit(1)).alias("n")
    )
    unit = features.join(norms, "item_id").select(
        F.col("item_id").alias("g"), F.col("feature").alias("b"), (F.col("x") / F.col("norm")).alias("x")
    )
    mine = inter.select(F.col("item_id").alias("g"), F.col("user_id").alias("a"), F.lit(1.0).alias("x"))
    profile = product_sums(mine, unit)
    left = profile.select(F.col("b").alias("g"), "a", F.col("value").alias("x"))
    right = features.select(F.col("feature").alias("g"), F.col("item_id").alias("b"), "x")
    dots = product_sums(left, right).select(
        F.col("a").alias("user_id"), F.col("b").alias("item_id"), "value"
    )
    score = (F.col("value") + rate * F.col("inv")) / (F.col("n") * F.col("norm"))
    return (
        dots.join(inter.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
        .join(base, "user_id").join(norms, "item_id")
        .select("user_id", "item_id", score.alias("score"))
    )
