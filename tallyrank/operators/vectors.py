"""Vector tables: pooling, scaling and nearest neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.functions.arrays import norm
from tallyrank.operators.neighbours import TIE_DIGITS, best_unseen
from tallyrank.operators.ranking import top_k
from tallyrank.session import hold

BLOCK_ROWS = 8192
#: Queries of a cell, numbers in its base vectors, and queries that even a small table is cut into.
CELL_QUERIES, CELL_VALUES, LEAST_QUERIES = 1 << 15, 1 << 22, 1 << 10
#: Queries and base vectors scored at a time in a cell: a tile and its copies take 3 x TILE_QUERIES x TILE_ROWS x 8 bytes.
TILE_QUERIES, TILE_ROWS = 256, 8192
#: Numbers of a vector table that is sent to partitioned members, and members of a key and of a partition.
FEW_VALUES, POOL_ROWS = 1 << 19, 1 << 18


def dimension(vectors: DataFrame, column: str) -> int:
    row = vectors.select(F.size(column)).first()
    return int(row[0]) if row else 0


def pooled(members: DataFrame, vectors: DataFrame, how: str = "mean", extra: list[Column] | None = None) -> DataFrame:
    """(key, vec): mean or sum of the member vectors of (key, id) rows, zeros for keys without any.

    The vector is summed as one column per dimension. Where the vector table is small, members are partitioned
    by key first, so sums are made in place and no vector is shuffled; a key with over POOL_ROWS members is dealt to parts
    by id. Otherwise a key leaves each map task as one row. Hot keys need no care.
    """
    dims, keys = dimension(vectors, "vec"), ["key"]
    members = members.select("key", "id")
    if vectors.count() * max(dims, 1) <= FEW_VALUES:
        vectors = hold(vectors)
        vectors.count()  # once held, its size is known to the planner
        sizes = hold(members.groupBy("key").agg(F.count(F.lit(1)).alias("_n")))
        most, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
        if (most or 0) > POOL_ROWS:
            hot = sizes.where(F.col("_n") > POOL_ROWS).select(F.col("key").alias("_k"), F.ceil(F.col("_n") / POOL_ROWS).cast("int").alias("_parts"))
            members = members.join(hot, F.col("key").eqNullSafe(F.col("_k")), "left").select(
                "key", "id", F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1))).alias("_part"))
            keys.append("_part")
        members = members.repartition(max(members.sparkSession.sparkContext.defaultParallelism, -(-int(total or 0) // POOL_ROWS)), *keys)
    joined = members.join(vectors, "id", "left")
    names = [f"_s{d}" for d in range(dims)]
    sums = [F.sum(F.col("vec")[d].cast("double")).alias(name) for d, name in enumerate(names)]
    totals = joined.groupBy(*keys).agg(F.count("vec").alias("n"), *sums)
    if len(keys) > 1:
        totals = totals.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
    scale = F.greatest(F.col("n"), F.lit(1)) if how == "mean" else F.lit(1.0)
    vec = F.array(*[F.coalesce(F.col(name), F.lit(0.0)) / scale for name in names])
    return totals.select("key", "n", vec.alias("vec"))


def unit_vectors(vectors: DataFrame, column: str = "vec", floor: float = 0.0) -> DataFrame:
    """Rows of length one; zero rows keep zeros (or are divided by ``floor``)."""
    size = norm(column)
    divisor = F.when(size == 0, F.lit(floor) if floor else F.lit(1.0)).otherwise(size)
    return vectors.withColumn(column, F.transform(column, lambda x: x.cast("double") / divisor))


def _best_of_tile(q: np.ndarray, b: np.ndarray, ids: np.ndarray, take: np.ndarray, metric: str, banned: tuple | None = None):
    """(row, column, score) of each query's ``take`` best, sorted; ``banned`` has the rows and columns of pairs left out.
    The base comes in tiles; from the second on, only scores that reach the query's k-th best so far are looked at."""
    most = max(1, int(take.max(initial=0)))
    kept = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    least = np.full(len(q), -np.inf)
    for at in range(0, len(b), TILE_ROWS):
        part = b[at : at + TILE_ROWS]
        scores = q @ part.T
        if metric == "l2":
            scores = -((q * q).sum(1)[:, None] + (part * part).sum(1)[None, :] - 2.0 * scores)
        out = None
        if banned is not None:
            here = (banned[1] >= at) & (banned[1] < at + len(part))
            out = np.zeros(scores.shape, bool)
            out[banned[0][here], banned[1][here] - at] = True
        if at == 0 and len(part) > most:
            floor = scores if out is None else np.where(out, -np.inf, scores)
            least = np.partition(floor, len(part) - most, axis=1)[:, len(part) - most]
        # what rounds to the k-th best score may be a little under it
        found = ~(scores < (least - 2.0 * 10.0 ** -TIE_DIGITS)[:, None])
        rows, cols = np.nonzero(found if out is None else found & ~out)
        score = scores[rows, cols]
        rows, cols, score = np.append(kept[0], rows), np.append(kept[1], cols + at), np.append(kept[2], score)
        ranked = np.append(kept[3], np.round(score[len(kept[3]):], TIE_DIGITS))
        order = np.lexsort((ids[cols], -ranked, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        order, rows, place = order[place < most], rows[place < most], place[place < most]
        kept = rows, cols[order], score[order], ranked[order]
        full = place == most - 1
        least[rows[full]] = kept[3][full]
    rows, cols, score, _ = kept
    inside = np.arange(len(rows)) - np.searchsorted(rows, rows) < take[rows]
    return rows[inside], cols[inside], score[inside]


def _search_cell(metric: str):
    def search(key, queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or base.empty:
            return pd.DataFrame({"query": queries["query"][:0], "id": base["id"][:0], "score": []})
        b = np.stack(base["vec"].to_numpy()).astype(np.float64)
        ids = base["id"].to_numpy()
        found = []
        for at in range(0, len(queries), TILE_QUERIES):
            tile = queries.iloc[at : at + TILE_QUERIES]
            q = np.stack(tile["qvec"].to_numpy()).astype(np.float64)
            banned = _banned(tile["seen"], base["id"]) if "seen" in tile else None
            found.append((at, *_best_of_tile(q, b, ids, np.minimum(tile["k"].to_numpy(), len(ids)), metric, banned)))
        rows = np.concatenate([at + r for at, r, _, _ in found])
        cols, score = (np.concatenate([f[part] for f in found]) for part in (2, 3))
        return pd.DataFrame({
            "query": queries["query"].to_numpy()[rows], "id": ids[cols],
            "score": np.maximum(-score, 0.0) if metric == "l2" else score,
        })

    return search


def _banned(seen: pd.Series, ids: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows and base places of the pairs (query, id) where the query's list names the id."""
    rows = np.repeat(np.arange(len(seen)), [0 if x is None else len(x) for x in seen])
    named = pd.DataFrame({"row": rows, "id": [x for one in seen if one is not None for x in one]})
    met = named.merge(pd.DataFrame({"id": ids.to_numpy(), "place": np.arange(len(ids))}), on="id")
    return met["row"].to_numpy(np.int64), met["place"].to_numpy(np.int64)


def _scan(queries: DataFrame, base: DataFrame, metric: str, block: int | None) -> DataFrame:
    """(query, id, score): each query's ``k`` best base vectors of every base block, without those it has ``seen``.

    Both sides are dealt to hash blocks and each (query block, base block) cell is a run of
    matrix products, so no pair of vectors ever becomes a row unless it is among the best. A block of queries meets as many
    base vectors as a task can hold, so few blocks hand on ``k`` rows a query, and each table is copied few times.
    """
    # own column names on each side: both may come from one table
    queries = hold(queries.select("query", F.col("vec").alias("qvec"), "k", *[c for c in queries.columns if c == "seen"]))
    base = hold(base.select(F.col("id"), F.col("vec")))
    n_queries, n_base = queries.count(), base.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    qblocks = -(-n_queries // (block or CELL_QUERIES))
    bblocks = max(1, -(-n_base // (block or max(1, CELL_VALUES // max(1, dimension(base, "vec"))))))
    qblocks = max(1, qblocks if block else max(qblocks, min(-(-cores // bblocks), -(-n_queries // LEAST_QUERIES))))
    qcells = queries.withColumn("qb", F.pmod(F.xxhash64("query"), F.lit(qblocks)).cast("int")).withColumn(
        "bb", F.explode(F.sequence(F.lit(0), F.lit(bblocks - 1))))
    bcells = base.withColumn("bb", F.pmod(F.xxhash64("id"), F.lit(bblocks)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
    qtype = queries.schema["query"].dataType.simpleString()
    btype = base.schema["id"].dataType.simpleString()
    return qcells.groupBy("qb", "bb").cogroup(bcells.groupBy("qb", "bb")).applyInPandas(
        _search_cell(metric), f"query {qtype}, id {btype}, score double")


def nearest(queries: DataFrame, base: DataFrame, k: int, metric: str = "ip", block: int | None = None) -> DataFrame:
    """(query, id, score, rank): exact ``k`` best base vectors of every query.

    ``queries`` is (query, vec), ``base`` (id, vec); ``metric`` is 'ip' (larger is better)
    or 'l2' (squared distance, smaller is better). The best of the blocks are merged by a
    map-side limited top-k. ``block`` sets the rows of a block on both sides.
    """
    found = _scan(queries.select("query", "vec").withColumn("k", F.lit(k)), base, metric, block)
    rounded = F.round("score", TIE_DIGITS)
    order = [rounded if metric == "l2" else F.desc(rounded), F.asc("id")]
    return top_k(found, ["query"], order, k)


def best_unseen_by_vectors(users: DataFrame, items: DataFrame, seen: DataFrame, n: int, block: int | None = None) -> DataFrame:
    """(user_id, item_id, score, rank): the ``n`` best inner products among unseen items.

    A user's seen items that have a vector go with the user to the cells, so a block hands on ``n`` unseen items a user.
    """
    known = seen.select("user_id", F.col("item_id").alias("id")).where(F.col("user_id").isNotNull())
    known = known.join(items.select("id").distinct(), "id", "left_semi").groupBy("user_id").agg(F.collect_set("id").alias("seen"))
    queries = users.join(known, "user_id", "left").select(F.col("user_id").alias("query"), "vec", F.lit(n).alias("k"), "seen")
    found = _scan(queries, items, "ip", block).select(
        F.col("query").alias("user_id"), F.col("id").alias("item_id"), "score")
    return best_unseen(found, None, n)


def _plane_codes(tables: int, bits: int, dims: int, seed: int):
    planes = np.random.default_rng(seed).normal(size=(tables, bits, dims))
    weights = 1 << np.arange(bits, dtype=np.int64)

    @F.pandas_udf("array<bigint>")
    def codes(vectors: pd.Series) -> pd.Series:
        m = np.stack(vectors.to_numpy()).astype(np.float64)
        signs = np.einsum("nd,tbd->ntb", m, planes) > 0
        return pd.Series(list((signs * weights).sum(axis=2).astype(np.int64)))

    return codes


def nearest_approx(vectors: DataFrame, k: int, tables: int = 10, leaf: int = 128, seed: int = 11, block: int = BLOCK_ROWS) -> DataFrame:
    """(query, id, score, rank): approximate ``k`` nearest by angle from ``tables`` random splits.

    Each split cuts the space by random planes into cells of about ``leaf`` vectors; cells
    are searched exactly and the best over all splits are kept. A crowded cell is dealt to
    sub-blocks and searched block by block, so its pairs never become rows.
    """
    units = hold(unit_vectors(vectors).select("id", "vec"))
    bits = max(0, (units.count() // leaf).bit_length() - 1)
    coded = units.withColumn("codes", _plane_codes(tables, bits, dimension(units, "vec"), seed)("vec"))
    placed = hold(coded.select("id", "vec", F.posexplode("codes").alias("table", "code")))
    sizes = placed.groupBy("table", "code").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("subs"))
    rows = hold(placed.join(sizes, ["table", "code"]).withColumn(
        "home", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))))
    left = rows.select("table", "code", F.col("home").alias("qb"), F.col("other").alias("bb"),
                       F.col("id").alias("query"), F.col("vec").alias("qvec"), F.lit(k).alias("k"))
    right = rows.select(F.col("table").alias("t"), F.col("code").alias("c"), F.col("other").alias("ob"),
                        F.col("home").alias("hb"), "id", "vec")
    kind = units.schema["id"].dataType.simpleString()
    mine, theirs = left.groupBy("table", "code", "qb", "bb"), right.groupBy("t", "c", "ob", "hb")
    found = mine.cogroup(theirs).applyInPandas(
        _search_cell("ip"), f"query {kind}, id {kind}, score double")
    best = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    return top_k(best, ["query"], [F.desc(F.round("score", TIE_DIGITS)), F.asc("id")], k)


def merge_interests(found: DataFrame, n: int, skip_item=0) -> DataFrame:
    """(user_id, item_id, score, rank) from (user_id, interest, item_id, score) lists: the best
    score of an item over the user's interests counts, item ``skip_item`` is padding."""
    best = found.where(F.col("item_id") != skip_item).repartition("user_id").groupBy("user_id", "item_id").agg(
        F.max("score").alias("score"))
    return top_k(best, ["user_id"], [F.desc(F.round("score", TIE_DIGITS)), F.asc("item_id")], n)


def diversity_rerank(candidates: DataFrame, coef: float, n: int) -> DataFrame:
    """(user_id, item_id, rank) from (user_id, item_id, category, score) rows.

    Greedy picks of max(score - coef * items of the category already picked) are the
    ``n`` largest of score - coef * (place in the category - 1) for coef >= 0, since a
    category is used up in score order. Only the first ``n`` of a category can be picked.
    """
    inside = top_k(
        candidates, ["user_id", "category"], [F.desc(F.round("score", TIE_DIGITS)), F.asc("item_id")], n, "_c")
    adjusted = inside.withColumn("adjusted", F.col("score") - F.lit(coef) * (F.col("_c") - 1))
    order = [F.desc(F.round("adjusted", TIE_DIGITS)), F.asc("item_id")]
    return top_k(adjusted, ["user_id"], order, n).select("user_id", "item_id", "category", "adjusted", "rank")


def pca_scores(vectors: DataFrame, share: float = 0.9, k: int | None = None) -> DataFrame:
    """(id, component, x): centred projections on the fewest components that explain
    ``share`` of the variance, or on ``k``."""
    rows = hold(vectors.select("id", array_to_vector(F.transform("vec", lambda x: x.cast("double"))).alias("raw")))
    centred = hold(StandardScaler(
        withMean=True, withStd=False, inputCol="raw", outputCol="features").fit(rows).transform(rows))
    if k is None:
        full = PCA(k=dimension(vectors, "vec"), inputCol="features", outputCol="p").fit(centred)
        explained = np.cumsum(full.explainedVariance.toArray())
        k = int(np.searchsorted(explained, share) + 1)
    model = PCA(k=k, inputCol="features", outputCol="p").fit(centred)
    return model.transform(centred).select(
        "id", F.posexplode(vector_to_array("p")).alias("component", "x"))


def fm_scores(rows: DataFrame, weights: DataFrame, factors: DataFrame, bias: float) -> DataFrame:
    """(id, score): w0 + sum w x + 0.5 * sum_f ((sum v x)^2 - sum (v x)^2) over sparse
    (id, feat_id, value) rows, ``weights`` (feat_id, w) and ``factors`` (feat_id, vec)."""
    dims = dimension(factors, "vec")
    joined = rows.join(weights, "feat_id", "left").join(factors, "feat_id", "left")
    x = F.col("value")
    sums = [F.sum(x * F.col("vec")[d].cast("double")).alias(f"_s{d}") for d in range(dims)]
    squares = [F.sum(x * x * F.pow(F.col("vec")[d].cast("double"), F.lit(2.0))).alias(f"_q{d}") for d in range(dims)]
    totals = joined.groupBy("id").agg(F.sum(F.coalesce("w", F.lit(0.0)) * x).alias("_linear"), *sums, *squares)
    pairwise = F.lit(0.0)
    for d in range(dims):
        s, q = F.coalesce(F.col(f"_s{d}"), F.lit(0.0)), F.coalesce(F.col(f"_q{d}"), F.lit(0.0))
        pairwise = pairwise + (s * s - q)
    return totals.select("id", (F.lit(bias) + F.col("_linear") + 0.5 * pairwise).alias("score"))


def pooled_history_scores(samples: DataFrame, members: DataFrame, vectors: DataFrame, bias: DataFrame, alpha: float = 0.0) -> DataFrame:
    """(key, id, score): sigmoid(n^-alpha * (sum of the key's other member vectors) . vec_id + bias_id).

    The target's own vector is subtracted from the pooled sum when it is a member, so a
    key's history is pooled once for all its targets.
    """
    dims = dimension(vectors, "vec")
    sums = pooled(members, vectors, "sum").withColumnRenamed("vec", "total")
    own = members.select("key", "id").withColumn("_member", F.lit(1))
    # narrow rows first: the vectors come last
    rows = samples.join(own, ["key", "id"], "left").join(bias, "id", "left").join(sums, "key").join(vectors, "id")
    inside = F.coalesce("_member", F.lit(0))
    count = F.greatest(F.col("n") - inside, F.lit(1)).cast("double")
    product = F.lit(0.0)
    for d in range(dims):
        q = F.col("vec")[d].cast("double")
        product = product + (F.col("total")[d] - inside * q) * q
    z = F.pow(count, F.lit(-alpha)) * product + F.coalesce("bias", F.lit(0.0))
    return rows.select("key", "id", (1.0 / (1.0 + F.exp(-z))).alias("score"))
