"""Profile documents: building, searching and upserts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_EDGE = r"[^\p{L}\p{N}_]"


def build_profiles(users: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, user_info): the fields nested in one struct, numbers 0 and texts '' when missing."""
    numbers = {n: 0 for n, kind in users.dtypes if n in fields and kind != "string"}
    texts = {n: "" for n, kind in users.dtypes if n in fields and kind == "string"}
    filled = users.na.fill(numbers).na.fill(texts)
    return filled.select(key, F.struct(*fields).alias("user_info"))


def match_term(docs: DataFrame, field: str, term: str) -> DataFrame:
    """Documents whose text field holds the term as a word, whatever its case."""
    words = F.split(F.lower(field), WORD_EDGE + "+")
    return docs.where(F.array_contains(words, term.lower()))


def match_range(docs: DataFrame, field: str, above, below) -> DataFrame:
    """Documents with above < field < below."""
    return docs.where((F.col(field) > above) & (F.col(field) < below))


def match_phrase(docs: DataFrame, field: str, phrase: str, name: str = "highlight") -> DataFrame:
    """Documents holding the phrase, with every occurrence marked in ``name``."""
    body = (WORD_EDGE + "+").join(re.escape(w) for w in phrase.split())
    # the edges are looked at and not taken, so the separator between two phrases serves both
    pattern = rf"(?i)(?<![\p{{L}}\p{{N}}_])({body})(?![\p{{L}}\p{{N}}_])"
    found = docs.where(F.col(field).rlike(pattern))
    return found.withColumn(name, F.regexp_replace(field, pattern, "<em>$1</em>"))


def terms_buckets(docs: DataFrame, field: str, size: int = 10) -> DataFrame:
    """(term, n): the ``size`` most frequent values, the default bucket count of a terms report."""
    counts = docs.groupBy(F.col(field).alias("term")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("term")).limit(size)


def latest_versions(changes: DataFrame, key: str, version: list[str], payload: list[str]) -> DataFrame:
    """The newest change of each key; max over a struct combines on the map side, so a key
    with very many changes leaves each task as one row."""
    newest = changes.groupBy(key).agg(F.max(F.struct(*version, *payload)).alias("_c"))
    return newest.select(key, *[F.col(f"_c.{c}").alias(c) for c in [*version, *payload]])


def upsert(base: DataFrame, changes: DataFrame, key: str, version: list[str], payload: list[str], op: str = "op") -> DataFrame:
    """Profiles after the changes: newest version per key, keys whose newest op is 'delete' gone."""
    both = base.select(key, *version, op, *payload).unionByName(changes.select(key, *version, op, *payload))
    latest = latest_versions(both, key, version, [op, *payload])
    return latest.where(F.col(op) != "delete").drop(op)
