"""Readers and writers for the text formats of interaction data.

Every reader takes a declared schema: nothing is inferred, so opening a large folder
costs no extra pass, and unused columns are pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATING_SCHEMA = "user_id BIGINT, item_id BIGINT, rating DOUBLE, ts BIGINT"
EVENT_SCHEMA = "user_id BIGINT, item_id BIGINT, ts BIGINT"
CATEGORY_SCHEMA = "item_id BIGINT, category BIGINT"
USER_PIPE_SCHEMA = "user_id BIGINT, age INT, gender STRING, occupation STRING, zip_code STRING"
USER_COLON_SCHEMA = "user_id BIGINT, gender STRING, age INT, occupation INT, zip_code STRING"
ITEM_SCHEMA = "item_id BIGINT, title STRING, genres STRING"
SEARCH_SCHEMA = "prefix STRING, query_prediction STRING, title STRING, tag STRING, label STRING"
PROFILE_SCHEMA = (
    "user_id BIGINT, pred_gender STRING, pred_age_level STRING, pred_education_degree INT, "
    "pred_career_type INT, predict_income DOUBLE, pred_stage STRING"
)


def read_ratings(spark: SparkSession, path: str, sep: str = "\t", header: bool = False) -> DataFrame:
    """Ratings separated by tab, '::' or ','. No line is dropped unless ``header`` is set."""
    return spark.read.schema(RATING_SCHEMA).csv(path, sep=sep, header=header)


def read_skip_header(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Any delimited file whose first line is a header."""
    return spark.read.schema(schema).csv(path, sep=sep, header=True)


def parse_delimited(lines: DataFrame, schema: str, header: str | None = None, sep: str = ",") -> DataFrame:
    """Columns from delimited text lines, without the lines that repeat the header."""
    kept = lines.where(F.col("value") != header) if header else lines
    return kept.select(F.from_csv("value", schema, {"sep": sep}).alias("_r")).select("_r.*")


def read_items(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """Latin-1 item file: title and the pipe-separated genres as an array."""
    raw = spark.read.schema(ITEM_SCHEMA).csv(path, sep=sep, encoding="ISO-8859-1")
    return raw.withColumn("genres", F.split("genres", r"\|"))


def read_users(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    schema = USER_PIPE_SCHEMA if sep == "|" else USER_COLON_SCHEMA
    return spark.read.schema(schema).csv(path, sep=sep)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """user,item,time lines; ``operators.sequences.ordered_items`` gives the time order."""
    return spark.read.schema(EVENT_SCHEMA).csv(path)


def read_item_category(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATEGORY_SCHEMA).csv(path)


def parse_predictions(df: DataFrame, column: str) -> DataFrame:
    """The JSON object in ``column`` as a map of title to probability."""
    return df.withColumn(column, F.from_json(column, "map<string,double>"))


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    """Search log lines with all five fields and a label other than 0."""
    raw = spark.read.schema(SEARCH_SCHEMA).csv(path, sep="\t", quote="")
    kept = raw.where(F.col("label").isNotNull() & (F.col("label") != "0"))
    return parse_predictions(kept, "query_prediction").withColumn("label", F.col("label").cast("int"))


def edge_weights(clicks: DataFrame, src: str, dst: str) -> DataFrame:
    """Edge list with the number of duplicates as weight."""
    return clicks.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(
        F.count(F.lit(1)).alias("w")
    )


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    clicks = spark.read.schema("src STRING, dst STRING").csv(path)
    return edge_weights(clicks, "src", "dst")


def parse_context(lines: DataFrame, column: str = "value") -> DataFrame:
    """(key, features) from white-space separated numeric lines."""
    fields = F.split(F.trim(column), r"\s+")
    return lines.where(F.trim(column) != "").select(
        F.element_at(fields, 1).alias("key"),
        F.transform(F.slice(fields, 2, F.size(fields) - 1), lambda x: x.cast("double")).alias("features"),
    )


def read_context_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_context(spark.read.text(path))


def number_text(col) -> Column:
    """Whole numbers without a fraction, others in Spark's shortest form."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def libsvm_lines(rows: DataFrame, key: list[str], label: str) -> DataFrame:
    """One ``label feat:value ...`` string per row from (key, label, feat_id, value) rows."""
    entry = F.struct("feat_id", F.concat_ws(":", "feat_id", "value").alias("t"))
    return rows.groupBy(*key, label).agg(
        F.array_sort(F.collect_list(entry)).alias("_e")
    ).select(*key, F.concat_ws(" ", F.col(label).cast("string"), F.col("_e.t")).alias("line"))


def libffm_lines(rows: DataFrame, key: list[str], label: str) -> DataFrame:
    """One ``label field:feat:value ...`` string per row."""
    entry = F.struct("field_id", "feat_id", F.concat_ws(":", "field_id", "feat_id", "value").alias("t"))
    return rows.groupBy(*key, label).agg(
        F.array_sort(F.collect_list(entry)).alias("_e")
    ).select(*key, F.concat_ws(" ", F.col(label).cast("string"), F.col("_e.t")).alias("line"))


def write_lines(lines: DataFrame, path: str, column: str = "line") -> None:
    lines.select(column).write.mode("overwrite").text(path)


def write_csv_noheader(df: DataFrame, path: str, drop: tuple[str, ...] = ("id",)) -> None:
    df.drop(*drop).write.mode("overwrite").option("header", False).csv(path)


def submission_rows(df: DataFrame, key: str, prediction: str) -> DataFrame:
    """(id, target) with the target printed to five places."""
    return df.select(F.col(key).alias("id"), F.format_string("%.5f", F.col(prediction)).alias("target"))


def write_submission(df: DataFrame, path: str, key: str, prediction: str) -> None:
    submission_rows(df, key, prediction).write.mode("overwrite").option("header", True).csv(path)


def export_embeddings(df: DataFrame, path: str, key: str, vector: str) -> None:
    """(id, vector) as parquet; the vector stays an array<float> column."""
    df.select(key, F.col(vector).cast(T.ArrayType(T.FloatType())).alias(vector)).write.mode(
        "overwrite"
    ).parquet(path)


def write_profiles(docs: DataFrame, path: str, partition: str) -> None:
    docs.write.mode("overwrite").partitionBy(partition).parquet(path)
