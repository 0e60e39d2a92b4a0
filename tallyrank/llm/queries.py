"""The registered queries of the operators, and SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrank.llm import conversation, jaccard, linededup, maxent, packing, phrases, pieces, pii, quality, repetition, secrets, topk, toxicity
from tallyrank.llm.common import crc_remainder
from tallyrank.session import ship_package


#: Rows of an Arrow batch, so that a batch of long texts stays within a Python worker's memory.
BATCH_ROWS = 2000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives its text (its mark characters as spaces)."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode_documents(pieces.encode_documents(_table(spark, folder, "documents"), path), path)
    same = F.col("decoded").eqNullSafe(F.translate("text", pieces.MARK, " "))
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_ids"), "ids", same.alias("round_trip"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The rank file holds the vocabulary of byte_bpe_50k.json but its added tokens, so with them the ids are the same."""
    path, added = public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN, added=added)


def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(_table(spark, folder, "embeddings"))
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5, copies=True)


def op4_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition_report(_table(spark, folder, "documents"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"),
    )


def _marked(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id", (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op6_maxent(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score_documents(_table(spark, folder, "documents"))


def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_documents(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return _marked(quality.score_quality(docs, quality.train_quality(docs, _table(spark, folder, "labels"))), 0.5)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return _marked(toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, _table(spark, folder, "labels"))), toxicity.THRESHOLD)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = pii.find_personal_data(docs, pii.train_spans(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, folder, "documents"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations")
    return conversation.repair_conversations(conversation.damaged(rows), rows)


def op13_linededup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.dedup_lines(_table(spark, folder, "documents"), linededup.LEAST)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pieces, op2_packing, op3_topk, op4_repetition, op5_secrets, op6_maxent, op7_jaccard, op8_quality, op9_toxicity, op10_pii, op11_phrases,
        op12_repair, op13_linededup)
}

SQL: dict[str, str] = {
    "op7_jaccard": r"""
        WITH RECURSIVE w AS MATERIALIZED (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
        ), s AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3 THEN
                   list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i : i + 2], ' '))
                   WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
        ), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
        ), p AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle)
            WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), e AS MATERIALIZED (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * shared >= 90 * (x.n + y.n - shared)
        ), r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) c USING (doc_id)""",
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), q AS (SELECT * FROM v WHERE vec_id % 50 = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.vector, v.vector), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM q JOIN v ON q.vec_id <> v.vec_id
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op13_linededup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), k AS MATERIALIZED (
            SELECT r, doc_id, lines, list_transform(lines, lambda x: translate(trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys FROM d
        ), c AS (
            SELECT key FROM (SELECT r, unnest(list_distinct(keys)) AS key FROM k) WHERE key <> '' GROUP BY key HAVING count(*) >= 10
        ), u AS (SELECT r, doc_id, unnest(lines) AS line, unnest(keys) AS key, unnest(range(len(lines))) AS pos FROM k
        )
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM u LEFT JOIN c ON c.key = u.key GROUP BY r, doc_id""",
    "op11_phrases": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), p AS MATERIALIZED (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
            FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
        ), g AS MATERIALIZED (
            SELECT lang, m, phrase, count(*) AS a FROM (
                SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
                FROM p, range(1, 5) AS r(m) WHERE len(w) >= m) GROUP BY 1, 2, 3
        ), n AS (SELECT lang, sum(a) AS n FROM g WHERE m = 1 GROUP BY 1
        ), c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE m > 1 AND a >= 30
        ), s AS (
            SELECT c.lang, c.phrase, c.m, c.a, k, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
            FROM c, range(1, 4) AS q(k)
            JOIN g x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(c.w[1 : k], ' ')
            JOIN g y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(c.w[k + 1 : c.m], ' ')
            WHERE k < c.m
        ), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), i AS (
            SELECT lang, unnest(list_transform(range(1, m - j + 2), lambda i: array_to_string(w[i : i + j - 1], ' '))) AS phrase, a
            FROM c, range(2, 4) AS o(j) WHERE j < m
        ), u AS (SELECT lang, phrase, max(a) AS f FROM i GROUP BY 1, 2
        ), f AS (SELECT b.* FROM b LEFT JOIN u USING (lang, phrase) WHERE u.f IS NULL OR 100 * u.f < 80 * b.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, score
        FROM f JOIN n USING (lang) QUALIFY rank <= 2000""",
}
