"""Sums over shared groups for pairs of members: the core of all similarity operators.

``pair_sums`` is the sparse product X'X of a (group x member) matrix. Two exact paths
are added up:

* light groups (at most ``heavy`` members): where few pairs repeat, each member travels with the list of
  the larger members of its group, and pairs are made where they are summed; where the same pairs come
  again and again, groups are self-joined and Spark sums the joined rows by pair before anything is shuffled;
* heavy groups are never self-joined. Their rows are dealt to cells (member block x
  member block x group chunk) and each cell multiplies two small dense matrices, so a
  pair leaves a cell once with its sum over all groups of the chunk, and one hot group
  is spread over every block pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.session import hold

HEAVY_GROUP = 512
BLOCK_MEMBERS = 2048
CHUNK_GROUPS = 256
#: Pairs that one task lists and sums.
TASK_PAIRS = 1 << 20


def _blocks(count: int, width: int) -> int:
    return max(1, -(-count // width))


def _cell_product(pdf: pd.DataFrame) -> pd.DataFrame:
    low, high = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
    rows, groups = pd.factorize(pdf["g"])
    sides = []
    for block in (low, high):
        mask = (pdf["blk"] == block).to_numpy()
        cols, members = pd.factorize(pdf["m"][mask])
        values = np.zeros((len(groups), len(members)))
        seen = np.zeros((len(groups), len(members)), dtype=np.float32)
        values[rows[mask], cols] = pdf["x"].to_numpy()[mask]
        seen[rows[mask], cols] = 1.0
        sides.append((np.asarray(members), values, seen))
    (am, av, an), (bm, bv, bn) = sides
    shared = an.T @ bn
    total = av.T @ bv
    i, j = np.nonzero(shared)
    left, right = am[i], bm[j]
    keep = left < right if low == high else left != right
    i, j, left, right = i[keep], j[keep], left[keep], right[keep]
    swap = left > right
    return pd.DataFrame(
        {
            "a": np.where(swap, right, left),
            "b": np.where(swap, left, right),
            "value": total[i, j],
            "n": shared[i, j].astype(np.int64),
        }
    )


def heavy_pairs(rows: DataFrame, members: int, groups: int, block: int, chunk: int) -> DataFrame:
    """Pair sums of (g, m, x) rows by blocked dense products."""
    blocks, chunks = _blocks(members, block), _blocks(groups, chunk)
    member_type = rows.schema["m"].dataType.simpleString()
    dealt = (
        rows.withColumn("blk", F.pmod(F.xxhash64("m"), F.lit(blocks)).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("g"), F.lit(chunks)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("lo", F.least("blk", "other"))
        .withColumn("hi", F.greatest("blk", "other"))
        .drop("other")
    )
    schema = f"a {member_type}, b {member_type}, value double, n bigint"
    return dealt.groupBy("lo", "hi", "chunk").applyInPandas(_cell_product, schema)


def _chunk_pairs(rows: DataFrame, width: int) -> DataFrame:
    """(a, b, value, n) of groups with ``_size`` members, joined by (group, chunk, chunk).

    A member stands on the left under (own, own and later chunks) and on the right under (own and
    earlier chunks, own), so a pair of members meets under one key, or under two orders of the same key
    where both are of one chunk.
    """
    chunks = F.ceil(F.col("_size") / width).cast("int")
    dealt = rows.withColumn("_last", chunks - 1).withColumn("_c", F.pmod(F.xxhash64("m"), chunks).cast("int"))
    left = dealt.select("g", F.col("_c").alias("_lo"), F.explode(F.sequence("_c", "_last")).alias("_hi"),
                        F.col("m").alias("ma"), F.col("x").alias("xa"))
    right = dealt.select("g", F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_lo"), F.col("_c").alias("_hi"),
                         F.col("m").alias("mb"), F.col("x").alias("xb"))
    met = left.join(right, ["g", "_lo", "_hi"]).where((F.col("_lo") < F.col("_hi")) | (F.col("ma") < F.col("mb")))
    return met.select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b"),
                      (F.col("xa") * F.col("xb")).alias("value"), F.lit(1).cast("bigint").alias("n"))


def pair_sums(
    entries: DataFrame,
    group: str,
    member: str,
    value: str | None = None,
    heavy: int = HEAVY_GROUP,
    block: int = BLOCK_MEMBERS,
    chunk: int = CHUNK_GROUPS,
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """(a, b, value, n) for every pair a < b of members sharing a group.

    ``value`` is the sum over shared groups of x_a * x_b (1 without ``value``) and ``n``
    the number of shared groups. (group, member) must be distinct. Group sizes are measured
    first. Groups of at most ``heavy`` members are joined by group; larger ones by pairs of
    member chunks of about ``heavy``, so no join key makes more than a fixed number of
    pairs; the blocked products take groups they serve better: a row of a group of s
    members makes s / 2 joined rows, or one row per member block.
    """
    x = F.col(value).cast("double") if value else F.lit(1.0)
    rows = hold(entries.select(F.col(group).alias("g"), F.col(member).alias("m"), x.alias("x")))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("_size"))
    n, small = F.col("_size").cast("double"), F.col("_size") <= heavy
    n_hot, light_pairs = sizes.agg(F.count_if(~small), F.sum(F.when(small, n * (n - 1) / 2))).first()
    light_pairs = light_pairs or 0.0
    members = rows.agg(F.approx_count_distinct("m")).first()[0] if n_hot or light_pairs else 0
    light, chunked = rows, None
    if n_hot:
        hot = hold(sizes.where(~small))
        limit = max(heavy, 2 * _blocks(members, block))
        light = rows.join(hot, "g", "left_anti")
        chunked = _chunk_pairs(rows.join(hot.where(F.col("_size") <= limit), "g"), max(heavy, 1))
        hot = hot.where(F.col("_size") > limit).select("g")
        n_hot = hot.count()
    other = chunked
    if n_hot:
        dense = heavy_pairs(rows.join(hot, "g", "left_semi"), members, n_hot, block, chunk)
        other = dense if other is None else other.unionByName(dense)
    if light_pairs > members * members / 4:  # pairs come again and again: they are summed before they travel
        pairs = _joined_pairs(light)
        pairs = pairs if other is None else pairs.unionByName(other)
        return pairs.groupBy("a", "b").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    return _tail_sums(rows, light, other, light_pairs, value is not None, task_pairs)


def _joined_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, value, n) of every pair of a group, by a join on the group."""
    left = rows.select("g", F.col("m").alias("a"), F.col("x").alias("xa"))
    right = rows.select("g", F.col("m").alias("b"), F.col("x").alias("xb"))
    met = left.join(right, "g").where(F.col("a") < F.col("b"))
    return met.select("a", "b", (F.col("xa") * F.col("xb")).alias("value"), F.lit(1).cast("bigint").alias("n"))


def _tail_sums(rows: DataFrame, light: DataFrame, other: DataFrame | None, pairs: float, valued: bool, task_pairs: int) -> DataFrame:
    """(a, b, value, n): the pairs of the groups of ``light`` and those of ``other``, summed.

    Each member travels once a group with the list of the larger members, and pairs are listed and summed where they
    arrive, in as many tasks that one has about ``task_pairs`` pairs. A member that would have more is dealt to copies by partner.
    """
    spark = rows.sparkSession
    if other is not None:
        other = other.where(F.col("a") < F.col("b"))
    known = light.where(F.col("g").isNotNull() & F.col("m").isNotNull())
    valued = valued or other is not None
    entry = F.struct("m", "x") if valued else F.struct("m")
    lists = known.groupBy("g").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    lists = lists.select(F.col("_l.m").alias("_ms"), *([F.col("_l.x").alias("_xs")] if valued else []))
    each = lists.select("*", F.posexplode("_ms").alias("_k", "a")).where(F.size("_ms") > F.col("_k") + 1)
    after = lambda c: F.slice(c, F.col("_k") + 2, F.size("_ms"))
    tails = each.select("a", after("_ms").alias("bs"), *([F.element_at("_xs", F.col("_k") + 1).alias("xa"), after("_xs").alias("xs")] if valued else []))
    tails = tails.withColumn("n", F.lit(1).cast("bigint"))
    if other is not None:
        tails = tails.unionByName(other.select("a", F.array("b").alias("bs"), F.lit(1.0).alias("xa"), F.array("value").alias("xs"), "n"))
    counts = rows.groupBy(F.col("m").alias("a")).agg(F.count(F.lit(1)).alias("_n"))
    per_row = max(1.0, pairs / max(1, rows.count()))
    hot = hold(counts.where(F.col("_n") * per_row > task_pairs).select("a", F.ceil(F.col("_n") * per_row / task_pairs).cast("int").alias("_copies")))
    parts, keys = max(spark.sparkContext.defaultParallelism, int(-(-pairs // task_pairs))), ["a"]
    if not hot.isEmpty():
        tails = tails.join(hot, "a", "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
        tails = tails.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
        keys.append("_copy")
    zipped = ["bs", "xs"] if valued else ["bs"]
    listed = tails.repartition(parts, *keys).withColumn("_p", F.explode(F.arrays_zip(*zipped))).withColumn("b", F.col("_p.bs"))
    listed = listed.where(F.col("a") < F.col("b"))
    if len(keys) > 1:
        listed = listed.where((F.col("_copies") == 1) | (F.pmod(F.xxhash64("b"), F.col("_copies")) == F.col("_copy")))
    summed = F.sum(F.col("xa") * F.col("_p.xs")) if valued else F.sum("n").cast("double")
    return listed.groupBy(*keys, "b").agg(summed.alias("value"), F.sum("n").alias("n")).select("a", "b", "value", "n")


def mirror(pairs: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Each unordered pair in both directions, in one pass over the rows."""
    others = [c for c in pairs.columns if c not in (left, right)]
    both = F.array(
        F.struct(F.col(left).alias("i"), F.col(right).alias("j")),
        F.struct(F.col(right).alias("i"), F.col(left).alias("j")),
    )
    return pairs.select(F.explode(both).alias("_p"), *others).select("_p.i", "_p.j", *others)


def _product_cell(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    empty = pd.DataFrame({"a": [], "b": [], "value": []})
    if left.empty or right.empty:
        return empty
    groups = pd.Index(pd.unique(left["g"]))
    right = right[right["h"].isin(groups)]
    if right.empty:
        return empty
    acol, am = pd.factorize(left["m"])
    bcol, bm = pd.factorize(right["w"])
    lhs = np.zeros((len(groups), len(am)))
    rhs = np.zeros((len(groups), len(bm)))
    lhs[groups.get_indexer(left["g"]), acol] = left["x"].to_numpy()
    rhs[groups.get_indexer(right["h"]), bcol] = right["y"].to_numpy()
    total = lhs.T @ rhs
    # A pair that shares a group is listed whatever its sum is, as a join would list it.
    lhs[:], rhs[:] = 0.0, 0.0
    lhs[groups.get_indexer(left["g"]), acol] = 1.0
    rhs[groups.get_indexer(right["h"]), bcol] = 1.0
    i, j = np.nonzero(lhs.T @ rhs)
    return pd.DataFrame({"a": np.asarray(am)[i], "b": np.asarray(bm)[j], "value": total[i, j]})


def product_sums(
    left: DataFrame,
    right: DataFrame,
    heavy: int = HEAVY_GROUP,
    block: int = BLOCK_MEMBERS,
    chunk: int = CHUNK_GROUPS,
) -> DataFrame:
    """Sparse product: (a, b, value) with value = sum over g of left(g,a).x * right(g,b).x.

    ``left`` is (g, a, x) and ``right`` (g, b, x), distinct on (g, member). Groups that
    are large on both sides go through blocked dense products, the others through a join
    aggregated in place.
    """
    left, right = hold(left), hold(right)
    lsize = left.groupBy("g").agg(F.count(F.lit(1)).alias("_l"))
    rsize = right.groupBy("g").agg(F.count(F.lit(1)).alias("_r"))
    joined_rows = F.col("_l").cast("double") * F.col("_r")
    hot = hold(lsize.join(rsize, "g").where(joined_rows > float(heavy) * heavy))
    n_hot = hot.count()
    lblocks = rblocks = 1
    if n_hot:
        lblocks = _blocks(left.agg(F.approx_count_distinct("a")).first()[0], block)
        rblocks = _blocks(right.agg(F.approx_count_distinct("b")).first()[0], block)
        dealt_rows = F.col("_l") * rblocks + F.col("_r") * lblocks
        hot = hot.where(joined_rows > 2 * dealt_rows).select("g")
        n_hot = hot.count()
    lrows, rrows = left, right
    if n_hot:
        lrows, rrows = left.join(hot, "g", "left_anti"), right.join(hot, "g", "left_anti")
    parts = (
        lrows.withColumnRenamed("x", "_x")
        .join(rrows, "g")
        .select("a", "b", (F.col("_x") * F.col("x")).alias("value"))
    )
    if n_hot:
        parts = parts.unionByName(_heavy_product(left, right, hot, lblocks, rblocks, _blocks(n_hot, chunk)))
    return parts.groupBy("a", "b").agg(F.sum("value").alias("value"))


def _heavy_product(left, right, hot, lblocks: int, rblocks: int, chunks: int) -> DataFrame:
    ltype = left.schema["a"].dataType.simpleString()
    rtype = right.schema["b"].dataType.simpleString()
    lrows = left.join(hot, "g", "left_semi").select("g", F.col("a").alias("m"), "x")
    rrows = right.join(hot, "g", "left_semi").select("g", F.col("b").alias("m"), "x")

    def chunk_of(column):
        return F.pmod(F.xxhash64(column), F.lit(chunks)).cast("int")

    # own column names on each side: both may come from one table
    rrows = rrows.select(F.col("g").alias("h"), F.col("m").alias("w"), F.col("x").alias("y"))
    lcells = (
        lrows.withColumn("lo", F.pmod(F.xxhash64("m"), F.lit(lblocks)).cast("int"))
        .withColumn("hi", F.explode(F.sequence(F.lit(0), F.lit(rblocks - 1))))
        .withColumn("chunk", chunk_of("g"))
    )
    rcells = (
        rrows.withColumn("hi", F.pmod(F.xxhash64("w"), F.lit(rblocks)).cast("int"))
        .withColumn("lo", F.explode(F.sequence(F.lit(0), F.lit(lblocks - 1))))
        .withColumn("chunk", chunk_of("h"))
    )
    cells = ["lo", "hi", "chunk"]
    return lcells.groupBy(*cells).cogroup(rcells.groupBy(*cells)).applyInPandas(
        _product_cell, f"a {ltype}, b {rtype}, value double"
    )
