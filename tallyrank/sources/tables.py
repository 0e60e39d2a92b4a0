"""The interaction views derived from the order, item and event tables.

One canonical schema, ``user_id, item_id, rating, ts``, feeds every operator.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_prefix
from tallyrank.session import hold, ship_package, tidy, written

TRAIN_LIMIT = "b3"  # first two hex digits below this: about 70% of the rows


def epoch_seconds(stamp) -> Column:
    """Seconds since 1970-01-01 of a timestamp without zone, whatever the session zone."""
    col = F.col(stamp) if isinstance(stamp, str) else stamp
    days = F.datediff(col, F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def star_rating(quantity) -> Column:
    """A 1 to 5 rating from a summed quantity."""
    return (F.lit(1) + F.pmod(quantity.cast("bigint"), F.lit(5))).cast("double")


class Tables:
    """Lazy readers over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their buyer."""
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        items = self.read("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        return orders.join(items, orders.o_orderkey == items.l_orderkey)

    @cached_property
    def interactions(self) -> DataFrame:
        """One row per (customer, part): rating from the summed quantity, first order time. Written once, so that the
        shuffled lines behind it can go before an operator shuffles its own."""
        grouped = self.lines.groupBy(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
        ).agg(F.sum("l_quantity").alias("_q"), F.min("o_orderdate").alias("_t"))
        rows = written(grouped.select(
            "user_id", "item_id", star_rating(F.col("_q")).alias("rating"),
            epoch_seconds("_t").alias("ts"),
        ), "interactions")
        del grouped
        self.__dict__.pop("lines", None)
        tidy(self.spark)
        return rows

    @cached_property
    def train(self) -> DataFrame:
        return self.interactions.where(hash_prefix("user_id", "item_id") < TRAIN_LIMIT)

    @cached_property
    def test(self) -> DataFrame:
        return self.interactions.where(hash_prefix("user_id", "item_id") >= TRAIN_LIMIT)

    @cached_property
    def brand_ratings(self) -> DataFrame:
        """One row per (customer, brand): the dense variant of the interactions."""
        parts = self.read("part").select("p_partkey", F.col("p_brand").alias("item_id"))
        grouped = (
            self.lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("o_custkey").alias("user_id"), "item_id")
            .agg(F.sum("l_quantity").alias("_q"))
        )
        return hold(grouped.select("user_id", "item_id", star_rating(F.col("_q")).alias("rating")))

    @cached_property
    def baskets(self) -> DataFrame:
        """Distinct (order, brand)."""
        parts = self.read("part").select("p_partkey", "p_brand")
        lines = self.read("lineitem").select("l_orderkey", "l_partkey")
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))
            .distinct()
        )

    @cached_property
    def item_category(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_type").alias("category")
        )
