"""Matrix factorisations with the factors as tables.

A factor table is (id, f0 .. f{k-1}). Each step joins the observed entries with one
factor table and sums k columns per key, which Spark combines on the map side, so a hot
user or item costs one row per task. Only k x k matrices come to the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.functions.hashing import hash_unit
from tallyrank.session import cut_lineage, discard, hold, tidy, written

#: Entries of a gradient cell, about, and of one step in it.
CELL_ENTRIES, STEP_ENTRIES = 1 << 20, 1 << 18


def names(k: int) -> list[str]:
    return [f"f{d}" for d in range(k)]


def start_factors(ids: DataFrame, k: int, scale: float = 1.0, tag: str = "u") -> DataFrame:
    """Pseudo-random start values in [0, scale) that do not depend on partitioning."""
    return ids.select("id", *[
        (hash_unit(F.lit(tag), "id", F.lit(str(d))) * scale).alias(f"f{d}") for d in range(k)])


def as_vectors(factors: DataFrame, k: int) -> DataFrame:
    return factors.select("id", F.array(*names(k)).alias("vec"))


def _gram_part(columns: list[str]):
    def part(frames):
        total = np.zeros((len(columns), len(columns)))
        for pdf in frames:
            block = pdf[columns].to_numpy(dtype=float)
            total += block.T @ block
        yield pd.DataFrame({"place": np.arange(total.size), "x": total.ravel()})

    return part


def _gram(factors: DataFrame, k: int) -> np.ndarray:
    """F'F: every partition adds up its own k x k matrix, the sums of those come back."""
    parts = factors.select(*names(k)).mapInPandas(_gram_part(names(k)), "place long, x double")
    out = np.zeros(k * k)
    for place, x in parts.groupBy("place").agg(F.sum("x")).collect():
        out[place] = x
    return out.reshape(k, k)


def _times(matrix: np.ndarray, k: int) -> list[Column]:
    """The row vector (f0 .. f{k-1}) times a small matrix."""
    return [
        F.expr(" + ".join(f"f{i} * {float(matrix[i, j])!r}D" for i in range(k))).alias(f"f{j}")
        for j in range(matrix.shape[1])
    ]


def _padded(columns: list[Column], k: int) -> list[Column]:
    """``columns`` and zeros up to f{k-1}, for a matrix of a lower rank."""
    return [*columns, *(F.lit(0.0).alias(f"f{d}") for d in range(len(columns), k))]


def _weighted_sums(entries: DataFrame, factors: DataFrame, own: str, other: str, k: int) -> DataFrame:
    """(id, f...): sum of x * factor of ``other`` over the entries of each ``own``."""
    joined = entries.join(factors.withColumnRenamed("id", other), other)
    return joined.groupBy(F.col(own).alias("id")).agg(
        *[F.expr(f"sum(x * {f})").alias(f) for f in names(k)])


def als_zero_imputed(entries: DataFrame, k: int = 3, rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """(row factors, column factors) of alternating least squares with missing entries as 0.

    With zeros the normal matrix of every column is the same, so a half step is one
    weighted sum per key times one k x k inverse: V = (U'U)^-1 U' R.
    """
    entries = hold(entries.select("row", "col", "x"))
    left = start_factors(entries.select(F.col("row").alias("id")).distinct(), k)
    right = None

    def half(other: DataFrame, own: str, theirs: str) -> DataFrame:
        sums = _weighted_sums(entries, other, own, theirs, k)
        return cut_lineage(sums.select("id", *_times(np.linalg.pinv(_gram(other, k)), k)))

    for _ in range(rounds):
        right = half(left, "col", "row")
        left = half(right, "row", "col")
    tidy(entries.sparkSession)
    return left, right


def nmf(entries: DataFrame, k: int = 2, rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """Non-negative factors of the zero-filled matrix by multiplicative updates."""
    entries = hold(entries.select("row", "col", "x"))
    left = hold(start_factors(entries.select(F.col("row").alias("id")).distinct(), k))
    right = hold(start_factors(entries.select(F.col("col").alias("id")).distinct(), k, tag="v"))

    def update(own: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
        gram = _gram(other, k)
        pull = _weighted_sums(entries, other, key, other_key, k).select(
            "id", *[F.col(f).alias(f"n{f}") for f in names(k)])
        push = own.select("id", *names(k), *[c.alias(f"d{d}") for d, c in enumerate(_times(gram, k))])
        ratio = [
            (F.col(f"f{d}") * F.col(f"nf{d}") / (F.col(f"d{d}") + 1e-9)).alias(f"f{d}") for d in range(k)]
        return cut_lineage(push.join(pull, "id").select("id", *ratio))

    for _ in range(rounds):
        right = update(right, left, "col", "row")
        left = update(left, right, "row", "col")
    return left, right


def _orthonormal(factors: DataFrame, k: int) -> DataFrame:
    """Columns made orthonormal with the inverse root of their k x k Gram matrix."""
    values, vectors = np.linalg.eigh(_gram(factors, k))
    values = np.maximum(values, 1e-12 * max(values.max(), 1e-300))
    return factors.select("id", *_times(vectors @ np.diag(values ** -0.5), k))


def subspace_svd(entries: DataFrame, k: int, tol: float = 1e-7, extra: int = 10) -> tuple[DataFrame, DataFrame, list[float]]:
    """(left, right, singular values): the leading ``k`` of the sparse matrix (row, col, x).

    Block power iteration on ``k + extra`` columns: two weighted sums per round over the
    observed entries, with an orthonormalisation through a small matrix; neither side's
    vectors visit the driver. Rounds go on until none of the leading ``k`` residuals
    |A'Av - s^2 v|, read off two small Gram matrices, exceeds ``tol`` times the largest s^2.
    """
    entries = hold(entries.select("row", "col", "x"))
    sides = [entries.select(F.col(side).alias("id")).distinct() for side in ("col", "row")]
    width = max(1, min(k + extra, *(ids.count() for ids in sides)))
    right = start_factors(sides[0], width).select("id", *[(F.col(f) - 0.5).alias(f) for f in names(width)])
    right = cut_lineage(_orthonormal(hold(right), width))
    while True:
        image = hold(_weighted_sums(entries, right, "row", "col", width))
        values, vectors = np.linalg.eigh(_gram(image, width))
        order = np.argsort(-values)
        values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
        ahead = cut_lineage(_weighted_sums(entries, image, "col", "row", width))
        # |A'Av|^2 - s^4 is the squared residual of a Ritz vector v
        residual = np.diag(vectors.T @ _gram(ahead, width) @ vectors) - values ** 2
        if np.sqrt(np.maximum(residual[:k], 0.0)).max(initial=0.0) <= max(tol, 3e-8) * max(values[0], 1e-300):
            break
        image.unpersist()
        right = cut_lineage(_orthonormal(ahead, width))
    singular = np.sqrt(values)
    scale = np.array([1.0 / s if s > 1e-9 * singular[0] else 0.0 for s in singular])
    left = image.select("id", *_padded(_times((vectors @ np.diag(scale))[:, :k], width), k))
    right = right.select("id", *_padded(_times(vectors[:, :k], width), k))
    return left, right, [float(s) for s in singular[:k]] + [0.0] * (k - width)


def _damped(step: float, n: Column) -> Column:
    """step / (1 + step * n): a plain gradient step for few rows, bounded for very many."""
    return F.lit(step) / (1.0 + F.lit(step) * n)


def _dot(k: int) -> Column:
    return F.expr(" + ".join(f"f{d} * g{d}" for d in range(k)))


def _gradient_cell(k: int, center: float):
    """The sums that the entries of a cell give to its rows and columns: n, e and e times the other side's factors."""

    def cell(key: tuple, entries: pa.Table, vectors: pa.Table) -> pa.Table:
        sides, at = {}, {}
        for side, other in (("row", "col"), ("col", "row")):
            own = vectors.filter(pc.is_valid(vectors[side]))
            # an unknown value is NaN here, and sums skip it
            sides[side] = (own[side], np.column_stack([own[c].to_numpy() for c in (*names(k), "bias")]) if own.num_rows else np.zeros((0, k + 1)))
            at[side] = pd.Index(own[side].to_pandas()).get_indexer(entries[side].to_pandas())
        x, (row, col) = entries["x"].to_numpy(), (at["row"], at["col"])
        totals = {side: np.zeros((len(v), k + 3)) for side, (_, v) in sides.items()}
        for a in range(0, len(x), STEP_ENTRIES):
            r, c = row[a : a + STEP_ENTRIES], col[a : a + STEP_ENTRIES]
            u, v = sides["row"][1][r], sides["col"][1][c]
            e = x[a : a + STEP_ENTRIES] - (center + u[:, k] + v[:, k] + np.einsum("nd,nd->n", u[:, :k], v[:, :k]))
            known = ~np.isnan(e)
            e = np.where(known, e, 0.0)
            for side, place, theirs in (("row", r, v), ("col", c, u)):
                size = len(sides[side][1])
                columns = [np.ones(len(e)), known, e, *(np.where(known, e * theirs[:, d], 0.0) for d in range(k))]
                totals[side] += np.column_stack([np.bincount(place, w, size) for w in columns])
        out = []
        for side, other in (("row", "col"), ("col", "row")):
            sums = totals[side]
            met = np.flatnonzero(sums[:, 0])
            none = pa.nulls(len(met), entries.schema.field(other).type)
            # a key whose values are all unknown has no sum
            blank = sums[met, 1] == 0
            values = [pa.array(sums[met, d], mask=blank) for d in range(2, k + 3)]
            ids = {side: sides[side][0].combine_chunks().take(pa.array(met)), other: none}
            out.append(pa.table([ids["row"], ids["col"], pa.array(sums[met, 0].astype(np.int64)), *values],
                                names=["row", "col", "_n", "_e", *(f"_g{d}" for d in range(k))]))
        return pa.concat_tables(out)

    return cell


def mf_gradient(
    entries: DataFrame, k: int = 10, rounds: int = 10, step: float = 0.01, reg: float = 0.02,
    biased: bool = False, mean: float | None = None, cell_entries: int = CELL_ENTRIES,
) -> tuple[DataFrame, DataFrame, float]:
    """(row factors, column factors, mean): squared loss on observed entries.

    Each round takes the whole gradient of both sides. Entries lie in b x b cells (row block x column block), b from the
    square root of their number; a cell gets the vectors of its two blocks and gives back one sum for each, so per round
    each vector travels b times out and back, and no entry carries vectors. With ``biased`` the
    tables carry a ``bias`` column and predictions add the mean and both biases.
    """
    entries = hold(entries.select("row", "col", F.col("x").cast("double").alias("x")))
    center = 0.0
    if biased:
        center = mean if mean is not None else float(entries.agg(F.avg("x")).first()[0])
    met = entries.where(F.col("row").isNotNull() & F.col("col").isNotNull())
    cores = entries.sparkSession.sparkContext.defaultParallelism
    b = max(1, min(math.ceil(math.sqrt(cores)), entries.count() // 1000), math.ceil(math.sqrt(entries.count() / cell_entries)))
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(b)).cast("int")
    cells = hold(met.withColumns({"rb": block_of("row"), "cb": block_of("col")}))
    scale = float(np.sqrt(k)) / 10.0
    kinds = {side: entries.schema[side].dataType for side in ("row", "col")}

    def start(side: str, tag: str) -> DataFrame:
        values = start_factors(met.select(F.col(side).alias("id")).distinct(), k, scale, tag)
        ids = [(F.col("id") if c == side else F.lit(None).cast(kinds[c])).alias(c) for c in ("row", "col")]
        return values.select(*ids, *names(k), F.lit(0.0).alias("bias"))

    state = cut_lineage(start("row", "u").unionByName(start("col", "v")))
    fields = ", ".join([*(f"{c} {kinds[c].simpleString()}" for c in ("row", "col")), "_n bigint", "_e double", *(f"_g{d} double" for d in range(k))])
    every = F.explode(F.sequence(F.lit(0), F.lit(b - 1)))

    def moved_once(state: DataFrame) -> DataFrame:
        mine = F.col("row").isNotNull()
        dealt = state.withColumn("_other", every).withColumns({
            "xb": F.when(mine, block_of("row")).otherwise(F.col("_other")), "yb": F.when(mine, F.col("_other")).otherwise(block_of("col"))})
        parts = cells.groupBy("rb", "cb").cogroup(dealt.groupBy("xb", "yb")).applyInArrow(_gradient_cell(k, center), fields)
        sums = parts.groupBy(F.col("row").alias("_row"), F.col("col").alias("_col")).agg(
            *[F.sum(c).alias(c) for c in ("_n", "_e", *(f"_g{d}" for d in range(k)))])
        moved = state.join(sums, F.col("row").eqNullSafe(F.col("_row")) & F.col("col").eqNullSafe(F.col("_col")))
        rate = _damped(step, F.col("_n"))
        new = [
            (F.col(f"f{d}") + rate * (F.col(f"_g{d}") - reg * F.col("_n") * F.col(f"f{d}"))).alias(f"f{d}")
            for d in range(k)]
        bias = F.col("bias") + rate * (F.col("_e") - reg * F.col("_n") * F.col("bias"))
        return cut_lineage(moved.select("row", "col", *new, (bias if biased else F.col("bias")).alias("bias")))

    for _ in range(rounds):
        state = moved_once(state)
    tidy(entries.sparkSession)
    left, right = (state.where(F.col(side).isNotNull()).select(F.col(side).alias("id"), *names(k), "bias") for side in ("row", "col"))
    return left, right, center


def predict_entries(entries: DataFrame, left: DataFrame, right: DataFrame, k: int, mean: float = 0.0,
                    low: float | None = None, high: float | None = None) -> DataFrame:
    """(row, col, x, pred) for given entries, clamped when limits are given."""
    def bias(df):
        return F.col("bias") if "bias" in df.columns else F.lit(0.0)

    l = left.select(F.col("id").alias("row"), *names(k), bias(left).alias("bl"))
    r = right.select(F.col("id").alias("col"), *[F.col(f"f{d}").alias(f"g{d}") for d in range(k)],
                     bias(right).alias("br"))
    pred = F.lit(mean) + F.col("bl") + F.col("br") + _dot(k)
    if low is not None:
        pred = F.least(F.greatest(pred, F.lit(low)), F.lit(high))
    return entries.join(l, "row").join(r, "col").select("row", "col", "x", pred.alias("pred"))


def scoring_vectors(left: DataFrame, right: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(user_id, vec) and (id, vec) whose inner product is bias-aware: the item bias is one
    more dimension and the user terms, equal for all items of a user, stay out."""
    users = left.select(F.col("id").alias("user_id"), F.array(*names(k), F.lit(1.0)).alias("vec"))
    bias = F.col("bias") if "bias" in right.columns else F.lit(0.0)
    return users, right.select("id", F.array(*names(k), bias).alias("vec"))


def _pairwise_cell(k: int):
    """The sums that the triples of a cell give to its users and items: how many, and the gradients."""

    def cell(key: tuple, triples: pa.Table, vectors: pa.Table) -> pa.Table:
        ids, values, totals = {}, {}, {}
        for side in ("user", "item"):
            own = vectors.filter(pc.is_valid(vectors[side]))
            ids[side] = own[side].combine_chunks() if own.num_rows else pa.nulls(0, own.schema.field(side).type)
            values[side] = np.column_stack([own[c].to_numpy() for c in names(k)]) if own.num_rows else np.zeros((0, k))
            totals[side] = np.zeros((own.num_rows, k + 1))
        found = {side: pd.Index(ids[side].to_pandas()) for side in ids}
        at = [found[side].get_indexer(triples[c].to_pandas()) for c, side in (("user_id", "user"), ("item_id", "item"), ("neg", "item"))]
        for a in range(0, triples.num_rows, STEP_ENTRIES):
            user, item, neg = (x[a : a + STEP_ENTRIES] for x in at)
            u, gap = values["user"][user], values["item"][item] - values["item"][neg]
            e = 1.0 / (1.0 + np.exp(np.einsum("nd,nd->n", u, gap)))
            for side, place, moves in (("user", user, gap), ("item", item, u), ("item", neg, -u)):
                size = len(values[side])
                columns = [np.ones(len(e)), *(e * moves[:, d] for d in range(k))]
                totals[side] += np.column_stack([np.bincount(place, w, size) for w in columns])
        out = []
        for side, other in (("user", "item"), ("item", "user")):
            met = np.flatnonzero(totals[side][:, 0])
            columns = {side: ids[side].take(pa.array(met)), other: pa.nulls(len(met), vectors.schema.field(other).type)}
            sums = [pa.array(totals[side][met, d]) for d in range(k + 1)]
            out.append(pa.table([columns["user"], columns["item"], sums[0].cast(pa.int64()), *sums[1:]],
                                names=["user", "item", "_n", *(f"_g{d}" for d in range(k))]))
        return pa.concat_tables(out)

    return cell


def bpr_factors(
    triples: DataFrame, k: int = 10, rounds: int = 5, step: float = 0.05, reg: float = 1e-4, cell_entries: int = CELL_ENTRIES,
) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) maximising ln sigmoid(u.(i - j)) over (user_id, item_id, neg).

    Each round takes the whole gradient. Triples lie in cells, which are blocks of users, or parts of a block where few users have most of
    them; a cell gets the vectors of its users and items and gives back one sum for each, so no triple carries vectors.
    An item's vector goes to all cells, or where that is less to those that have the item.
    """
    triples = written(triples.select("user_id", "item_id", "neg").dropna(), "pairwise-triples")
    tidy(triples.sparkSession)  # what drew them is not read again
    kinds = {"user": triples.schema["user_id"].dataType, "item": triples.schema["item_id"].dataType}
    cores, n = triples.sparkSession.sparkContext.defaultParallelism, triples.count()
    b = max(1, min(cores, n // 1000), math.ceil(n / cell_entries))
    # users with more triples than half a cell are dealt to cells by item
    load = triples.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = hold(load.where(F.col("_n") > max(cell_entries // 2, 1)).select("user_id"))
    block, spread = (F.pmod(F.xxhash64(*c), F.lit(b)).cast("int") for c in (["user_id"], ["user_id", "item_id", "neg"]))
    cells = triples.withColumn("cell", block)
    if not hot.isEmpty():
        cells = triples.join(hot.withColumn("_hot", F.lit(True)), "user_id", "left").withColumn(
            "cell", F.when(F.col("_hot"), spread).otherwise(block)).drop("_hot")
    places = cells.select("cell", F.explode(F.array(
        F.struct(F.col("user_id").alias("user"), F.lit(None).cast(kinds["item"]).alias("item")),
        F.struct(F.lit(None).cast(kinds["user"]).alias("user"), F.col("item_id").alias("item")),
        F.struct(F.lit(None).cast(kinds["user"]).alias("user"), F.col("neg").alias("item")))).alias("_p")).select("cell", "_p.*")
    users = start_factors(triples.select(F.col("user_id").alias("id")).distinct(), k, 0.1)
    items = start_factors(triples.select(F.col("item_id").alias("id")).union(triples.select("neg")).distinct(), k, 0.1, "v")
    state = cut_lineage(users.select(F.col("id").alias("user"), F.lit(None).cast(kinds["item"]).alias("item"), *names(k)).unionByName(
        items.select(F.lit(None).cast(kinds["user"]).alias("user"), F.col("id").alias("item"), *names(k))))
    everywhere = hot.isEmpty() and state.where("item IS NOT NULL").count() * b <= 2 * n
    places = None if everywhere else hold(places.distinct())
    every = F.explode(F.when(F.col("user").isNotNull(), F.array(F.pmod(F.xxhash64("user"), F.lit(b)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.lit(b - 1))))
    fields = ", ".join([*(f"{c} {kinds[c].simpleString()}" for c in ("user", "item")), "_n bigint", *(f"_g{d} double" for d in range(k))])

    def same(left: str, right: str) -> Column:
        return F.col(f"{left}user").eqNullSafe(F.col(f"{right}user")) & F.col(f"{left}item").eqNullSafe(F.col(f"{right}item"))

    def moved_once(state: DataFrame) -> DataFrame:
        if everywhere:
            dealt = state.withColumn("at", every)
        else:
            to = places.select(F.col("cell").alias("at"), F.col("user").alias("_user"), F.col("item").alias("_item"))
            dealt = state.join(to, same("", "_")).drop("_user", "_item")
        parts = cells.groupBy("cell").cogroup(dealt.groupBy("at")).applyInArrow(_pairwise_cell(k), fields)
        sums = parts.groupBy(F.col("user").alias("_user"), F.col("item").alias("_item")).agg(
            *[F.sum(c).alias(c) for c in ("_n", *(f"_g{d}" for d in range(k)))])
        rate = _damped(step, F.col("_n"))
        new = [(F.col(f"f{d}") + rate * (F.col(f"_g{d}") - reg * F.col(f"f{d}"))).alias(f"f{d}") for d in range(k)]
        return cut_lineage(state.join(sums, same("", "_")).select("user", "item", *new))

    for _ in range(rounds):
        state = moved_once(state)
    tidy(triples.sparkSession)
    discard(triples)
    left, right = (state.where(F.col(side).isNotNull()).select(F.col(side).alias("id"), *names(k)) for side in ("user", "item"))
    return left, right


def als_mllib(ratings: DataFrame, rank: int = 8, rounds: int = 5, n: int = 10, seed: int = 3) -> DataFrame:
    """(user_id, item_id, rank, score) of the library's regularised ALS on observed ratings."""
    model = ALS(userCol="user_id", itemCol="item_id", ratingCol="rating", rank=rank, maxIter=rounds,
                seed=seed, coldStartStrategy="drop").fit(ratings)
    found = model.recommendForAllUsers(n).select(
        "user_id", F.posexplode("recommendations").alias("pos", "r"))
    return found.select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("r.item_id").cast("bigint").alias("item_id"),
        (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("r.rating").cast("double").alias("score"))
