"""Top-k and position in a group, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyrank.session import hold


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their 1-based rank.

    Spark limits each group to ``k`` rows on the map side, so a hot group ships at
    most ``k`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.where(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def sliced_by_range(df: DataFrame, columns: list[Column]) -> DataFrame:
    """``df`` range-partitioned by ``columns`` with the partition number as ``_slice``.

    Spark samples the data for the bounds, so the slices are even whatever the values look
    like and however large one group is. The frame is held, so every reader sees the same
    slices.
    """
    return hold(df.repartitionByRange(*columns).withColumn("_slice", F.spark_partition_id()))


def _sliced(df: DataFrame, keys: list[str], order: list[Column], bucket: Column | None) -> DataFrame:
    if bucket is not None:
        return df.withColumn("_slice", bucket)
    return sliced_by_range(df, [*[F.col(k) for k in keys], *order])


def position(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    bucket: Column | None = None,
    name: str = "pos",
    size: str | None = None,
) -> DataFrame:
    """0-based position of each row in its ordered group, optionally with the group size.

    Rows are numbered inside slices of the group and the slice's offset is added, so a
    group holding a third of all rows is spread over as many tasks as it has slices; only
    one small row per (group, slice) is ordered per group. ``bucket`` names the slices and
    must not decrease along ``order`` (for time order a coarser time unit, for a digest
    its first digits); without it the rows are range-partitioned.
    """
    sliced = _sliced(df, keys, order, bucket)
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    if size:
        offsets = offsets.withColumn(size, F.sum("_rows").over(whole))
    offsets = offsets.drop("_rows")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = sliced.withColumn("_inside", F.row_number().over(inside))
    out = numbered.join(offsets, [*keys, "_slice"])
    out = out.withColumn(name, F.col("_before") + F.col("_inside") - 1)
    return out.drop("_slice", "_inside", "_before")


def dense_index(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """0-based index over the distinct values of ``column``, in value order, without a
    one-task sort. ``df`` must hold distinct values."""
    everything = df.withColumn("_all", F.lit(0))
    return position(everything, ["_all"], [F.col(column)], None, name).drop("_all")


def previous_value(df: DataFrame, keys: list[str], column: str, bucket: Column | None, name: str, first) -> DataFrame:
    """The value of ``column`` in the row before, in ``column`` order inside each group.

    Works slice by slice as ``position`` does; a slice's first row takes the largest
    value of the earlier slices, and the group's first row takes ``first``.
    """
    sliced = _sliced(df, keys, [F.col(column)], bucket)
    tops = sliced.groupBy(*keys, "_slice").agg(F.max(column).alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = tops.withColumn("_edge", F.max("_top").over(before)).drop("_top")
    inside = Window.partitionBy(*keys, "_slice").orderBy(column)
    out = sliced.withColumn("_lag", F.lag(column).over(inside)).join(edges, [*keys, "_slice"])
    return out.withColumn(name, F.coalesce("_lag", "_edge", F.lit(first))).drop("_slice", "_lag", "_edge")


def running_total(df: DataFrame, keys: list[str], order: list[Column], bucket: Column | None, value: str, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order``, slice by slice as in ``position``."""
    sliced = _sliced(df, keys, order, bucket)
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = sliced.withColumn("_inside", F.sum(value).over(inside)).join(offsets, [*keys, "_slice"])
    return out.withColumn(name, F.col("_before") + F.col("_inside")).drop("_slice", "_inside", "_before")
