"""Train/test splits and id mappings that give the same answer on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_prefix, key_digest
from tallyrank.operators.ranking import dense_index, position, top_k
from tallyrank.operators.relational import ordered_items


def split_by_hash(df: DataFrame, keys: list[str], limit: str, name: str = "split") -> DataFrame:
    """'train' for rows whose key digest starts below ``limit`` (hex), else 'test'."""
    return df.withColumn(name, F.when(hash_prefix(*keys) < limit, "train").otherwise("test"))


def _mark_held_out(inter: DataFrame, held: DataFrame) -> DataFrame:
    marked = held.select("user_id", "item_id").withColumn("_held", F.lit(True))
    joined = inter.join(marked, ["user_id", "item_id"], "left")
    return joined.withColumn(
        "split", F.when(F.col("_held"), "test").otherwise("train")
    ).drop("_held")


def last_items(inter: DataFrame) -> DataFrame:
    """The most recent interaction of each user, ties by item."""
    return top_k(inter, ["user_id"], [F.desc("ts"), F.asc("item_id")], 1, "_r").drop("_r")


def random_items(inter: DataFrame) -> DataFrame:
    """One pseudo-random interaction of each user."""
    order = [key_digest("user_id", "item_id"), F.col("item_id")]
    return top_k(inter, ["user_id"], order, 1, "_r").drop("_r")


def split_leave_last(inter: DataFrame) -> DataFrame:
    """Marking joins on (user, item), so no user's history meets in one task."""
    return _mark_held_out(inter, last_items(inter))


def split_leave_one_random(inter: DataFrame) -> DataFrame:
    return _mark_held_out(inter, random_items(inter))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3) -> DataFrame:
    """Fold number 0..k-1, balanced inside each class.

    A class is numbered in slices of the digest, so two huge classes still spread.
    """
    hashed = df.withColumn("_h", key_digest(key))
    numbered = position(
        hashed, [label], [F.col("_h"), F.col(key)], F.substring("_h", 1, 3), "_pos"
    )
    return numbered.withColumn("fold", F.pmod("_pos", F.lit(k))).drop("_h", "_pos")


def split_history(inter: DataFrame, share: float = 0.8) -> DataFrame:
    """The first int(share * n) events of each user are history, the rest targets."""
    numbered = ordered_items(inter, size="n")
    cut = F.floor(F.col("n") * F.lit(share))
    return numbered.withColumn("part", F.when(F.col("pos") < cut, "history").otherwise("target"))


def split_positional(df: DataFrame, key: str, first: int = 4000) -> DataFrame:
    """The first rows in key order validate, the rest test."""
    numbered = position(df.withColumn("_all", F.lit(0)), ["_all"], [F.col(key)], None, "_pos")
    return numbered.withColumn(
        "split", F.when(F.col("_pos") < first, "valid").otherwise("test")
    ).drop("_all", "_pos")


def compact_ids(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """(value, 0..n-1) over the distinct values, without a global one-task window."""
    return dense_index(df.select(column).distinct(), column, name)


def label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """(value, sorted code + 1); 0 stays free for padding."""
    codes = dense_index(df.select(column).distinct(), column, name)
    return codes.withColumn(name, F.col(name) + 1)


def frequency_vocab(df: DataFrame, column: str, min_count: int = 1) -> DataFrame:
    """(value, n, idx): ids by descending count, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    everything = counts.withColumn("_all", F.lit(0))
    return position(everything, ["_all"], [F.desc("n"), F.asc(column)], None, "idx").drop("_all")
