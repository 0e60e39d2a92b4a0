"""Feature tables: scaling, one-hot, dictionaries and sparse rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.operators.ranking import dense_index, position, top_k
from tallyrank.session import hold

MAX_ONE_HOT = 10000


def standardize(df: DataFrame, column: str, name: str) -> DataFrame:
    """(x - mean) / population deviation; a constant column gives 0."""
    mean = df.agg(F.avg(column)).scalar()
    spread = df.agg(F.stddev_pop(column)).scalar()
    scaled = F.when(spread > 0, (F.col(column) - mean) / spread).otherwise(0.0)
    return df.withColumn(name, scaled)


def min_max(df: DataFrame, column: str, name: str) -> DataFrame:
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    scaled = F.when(high > low, (F.col(column) - low) / (high - low)).otherwise(0.0)
    return df.withColumn(name, scaled)


def one_hot(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """One 0/1 column per value. Columns are made for at most MAX_ONE_HOT values; larger
    fields belong in ``one_hot_places``."""
    found = df.select(column).distinct().orderBy(column).limit(MAX_ONE_HOT + 1).collect()
    if len(found) > MAX_ONE_HOT:
        raise ValueError(f"{column} has more than {MAX_ONE_HOT} values; use one_hot_places")
    values = [row[0] for row in found if row[0] is not None]
    flags = [
        F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{str(v).lower()}") for v in values
    ]
    return df.select("*", *flags)


def one_hot_places(df: DataFrame, column: str, name: str = "place") -> tuple[DataFrame, DataFrame]:
    """((value, place) in value order, the rows with their place and the ``width``): one-hot rows of a field with any number of values.

    A row's vector has ``width`` places and a 1 at ``place``; a null value has no place, so its vector is all zeros.
    """
    values = hold(dense_index(df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct(), "value", name))
    named = df.join(values.withColumnRenamed("value", column), column, "left")
    return values, named.withColumn("width", F.coalesce(values.agg(F.count(F.lit(1))).scalar(), F.lit(0)))


def long_fields(df: DataFrame, key: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(key, field, field_id, raw, value): one row per field, in declared field order.

    ``raw`` is the categorical value (NULL for numeric fields), ``value`` the number
    (1.0 for categorical ones).
    """
    entries = []
    for number, name in enumerate([*numeric, *categorical]):
        is_number = name in numeric
        entries.append(F.struct(
            F.lit(name).alias("field"), F.lit(number).alias("field_id"),
            F.lit(None).cast("string").alias("raw") if is_number else F.col(name).cast("string").alias("raw"),
            F.col(name).cast("double").alias("value") if is_number else F.lit(1.0).alias("value"),
            F.col(name).cast("string").alias("text"),
        ))
    return df.select(key, F.explode(F.array(*entries)).alias("_f")).select(key, "_f.*")


def feature_dictionary(fields: DataFrame) -> DataFrame:
    """(field, field_id, raw, feat_id): one id per numeric field and per categorical value.

    Ids run through the fields in order, values in sorted order inside a field.
    """
    values = fields.select("field", "field_id", F.coalesce("raw", F.lit("")).alias("raw")).distinct()
    everything = values.withColumn("_all", F.lit(0))
    return position(everything, ["_all"], [F.col("field_id"), F.col("raw")], None, "feat_id").drop("_all")


def index_value_rows(fields: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(key..., field_id, feat_id, value, text): the sparse form of each row."""
    named = fields.withColumn("raw", F.coalesce("raw", F.lit("")))
    return named.join(dictionary.select("field_id", "raw", "feat_id"), ["field_id", "raw"])


def chi2_scores(rows: DataFrame, k: int) -> DataFrame:
    """(feature, chi2, rank) of the ``k`` best features over (id, label, feature, x >= 0) rows.

    Class sums of a feature are compared with the class shares of its total.
    """
    observed = rows.groupBy("feature", "label").agg(F.sum("x").alias("o"))
    classes = rows.select("id", "label").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    total = classes.agg(F.sum("c")).scalar()
    share = classes.select("label", (F.col("c") / total).alias("share"))
    sums = observed.groupBy("feature").agg(F.sum("o").alias("s"))
    terms = observed.join(share, "label").join(sums, "feature").withColumn("e", F.col("share") * F.col("s"))
    # a class without rows of the feature has o = 0 and adds its expectation
    scores = terms.groupBy("feature", "s").agg(
        F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e")).alias("part"),
        F.sum("e").alias("covered"),
    ).withColumn("chi2", F.col("part") + F.col("s") - F.col("covered"))
    everything = scores.withColumn("_all", F.lit(0))
    order = [F.desc(F.round("chi2", 9)), F.asc("feature")]
    return top_k(everything, ["_all"], order, k).select("feature", "chi2", "rank")


def lookup_ids(df: DataFrame, key: str, tags: Column, vocab: DataFrame, unknown: int = -1) -> DataFrame:
    """(key, pos, code) for each tag of a multi-value field; ``vocab`` is (tag, id)."""
    spread = df.select(key, F.posexplode(F.filter(tags, lambda x: x != "")).alias("pos", "tag"))
    codes = vocab.select("tag", F.col("id").alias("_code"))
    return spread.join(codes, "tag", "left").select(
        key, "pos", F.coalesce("_code", F.lit(unknown)).cast("bigint").alias("code")
    )
