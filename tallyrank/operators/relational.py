"""Attribute joins, counts and history tables over interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.ranking import dense_index, position, previous_value, top_k
from tallyrank.session import hold



def join_attributes(ratings: DataFrame, users: DataFrame, items: DataFrame, how: str = "left") -> DataFrame:
    """Ratings with user and item attributes; Spark broadcasts a side its size limit admits."""
    return ratings.join(users, "user_id", how).join(items, "item_id", how)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the declared order."""
    return top_k(df, keys, order, 1, "_first").drop("_first")


def binarize(column: str, threshold: float = 4) -> Column:
    return F.when(F.col(column) >= threshold, 1).otherwise(0)


def missing_count(columns: list[str], code=-1) -> Column:
    """How many of the columns hold the missing-value code."""
    total = F.lit(0)
    for name in columns:
        total = total + F.coalesce((F.col(name) == code).cast("int"), F.lit(0))
    return total


def item_popularity(inter: DataFrame) -> DataFrame:
    return inter.groupBy("item_id").agg(F.count(F.lit(1)).alias("popularity"))


def matrix_sparsity(inter: DataFrame) -> DataFrame:
    """1 - rows / (users * items), to three places."""
    stats = inter.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("item_id").alias("items"),
    )
    return stats.select(
        F.round(1 - F.col("n") / (F.col("users") * F.col("items")), 3).alias("sparsity")
    )


def ordered_items(inter: DataFrame, size: str | None = None) -> DataFrame:
    """Interactions with their 0-based time position ``pos`` in the user's history.

    Histories are cut by ranges of (user, time) of even size, so a user with one very busy
    day is spread over tasks like any other stretch of rows.
    """
    return position(inter, ["user_id"], [F.col("ts"), F.col("item_id")], None, "pos", size)


def history_chunks(inter: DataFrame, columns: list[str], chunk: int = 100) -> DataFrame:
    """Each user's ordered history as lists of at most ``chunk`` entries.

    A history is whole over its numbered parts, and no list outgrows a row.
    """
    numbered = ordered_items(inter).withColumn("part", F.floor(F.col("pos") / chunk))
    entry = F.struct("pos", *columns)
    lists = numbered.groupBy("user_id", "part").agg(F.array_sort(F.collect_list(entry)).alias("_h"))
    return lists.select("user_id", "part", *[F.col(f"_h.{c}").alias(c) for c in columns])


def catalogue_positions(inter: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalogue with 0-based ``pos``, interactions with the item's ``pos``)."""
    index = dense_index(items.select("item_id").distinct(), "item_id", "pos")
    return index, inter.select("user_id", "item_id").join(index, "item_id")


def unseen_runs(inter: DataFrame, items: DataFrame, slice_items: int = 4096) -> DataFrame:
    """Every user's unseen items as runs of catalogue positions.

    ``first_pos..last_pos`` are consecutive positions of the catalogue in item order that
    the user has not touched. A user with n items has at most n + 1 runs, so the
    complement of all histories takes rows in the order of the interactions, not of
    users x items. ``expand_runs`` lists the items.
    """
    index, seen = catalogue_positions(inter, items)
    total = index.agg(F.count(F.lit(1))).scalar()
    marks = seen.select("user_id", "pos").distinct()
    ends = marks.select("user_id").distinct().withColumn("pos", total)
    both = hold(marks.unionByName(ends))
    bucket = F.floor(F.col("pos") / slice_items)
    gaps = previous_value(both, ["user_id"], "pos", bucket, "_prev", -1)
    return gaps.where(F.col("pos") > F.col("_prev") + 1).select(
        "user_id",
        (F.col("_prev") + 1).alias("first_pos"),
        (F.col("pos") - 1).alias("last_pos"),
        (F.col("pos") - F.col("_prev") - 1).alias("n_items"),
    )


def expand_runs(runs: DataFrame, index: DataFrame) -> DataFrame:
    """(user_id, item_id) for every position in the runs."""
    listed = runs.select("user_id", F.explode(F.sequence("first_pos", "last_pos")).alias("pos"))
    return listed.join(index, "pos").select("user_id", "item_id")
