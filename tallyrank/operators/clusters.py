"""k-means for a whole sweep of k in the same passes, and its quality figures.

Rows are sorted and packed into blocks once, so that the rows of a tile, a thousand after each other, lie close.
A round leaves out, for every tile and k still moving, the centres that no row of the tile's box can be nearest to,
multiplies the tile with the others and adds up counts, sums and squared lengths per (k, cluster); the driver holds
centres only, whose number is a parameter. Quality follows from the same sums, without distances between rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.session import hold, written

TILE = 1024  # rows whose box is held against the centres at once
TASK_ROWS, LEAST_ROWS = 1 << 19, 1 << 13  # rows of a task at most, and from which another is worth its cost
SUMS = "k INT, cluster INT, n DOUBLE, q DOUBLE, within DOUBLE, s BINARY"


class Sweep(NamedTuple):
    """Per k the centres, whether they settled, and the squared distances summed before each move."""

    blocks: DataFrame
    centres: dict[int, np.ndarray]
    settled: dict[int, bool]
    within: dict[int, list[float]]


def _pack(rows: DataFrame) -> DataFrame:
    """Blocks of rows in the order of their vectors, over as many tasks as the rows ask for."""
    def pack(frames):
        for frame in frames:
            x = np.array(frame["x"].tolist(), np.float64).reshape(len(frame), -1)
            yield pd.DataFrame({"n": [len(x)], "x": [x.tobytes()]})

    n, most = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(most, -(-n // LEAST_ROWS)), -(-n // TASK_ROWS))
    # equal vectors are told apart by their ids, so that many of them do not meet in one task
    vectors = rows.select(vector_to_array("features").alias("x"), F.xxhash64("id").alias("_h")).withColumn("_x", F.reverse("x"))
    placed = vectors.repartitionByRange(tasks, "_x", "_h").sortWithinPartitions("_x", "_h")
    return placed.select("x").mapInPandas(pack, "n INT, x BINARY")


def _blocks(frames):
    for frame in frames:
        for n, x in zip(frame["n"], frame["x"]):
            if n:
                yield np.frombuffer(x, np.float64).reshape(n, -1)


class _Centres:
    """The centres of several k, one after another; ``k`` tells whose each is and ``own`` its number there."""

    def __init__(self, at: np.ndarray, k: np.ndarray, own: np.ndarray):
        self.at, self.k, self.own, self.square = at, k, own, (at * at).sum(1)
        self.starts = np.flatnonzero(np.diff(k, prepend=-1))
        self.most_square = self.square.max(initial=0)

    @classmethod
    def of(cls, centres: list[np.ndarray]) -> _Centres:
        sizes = [len(c) for c in centres]
        return cls(np.concatenate(centres), np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes]))

    def near(self, rows: np.ndarray) -> _Centres:
        """Those of each k that may be nearest to one of the rows, in order: their least distance to the box around the
        rows does not pass, by more than rounding can, the least of the largest distances."""
        low, high = rows.min(0), rows.max(0)
        below, above = low - self.at, self.at - high
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
        most = np.minimum.reduceat((np.minimum(below, above) - (high - low)) ** 2 @ np.ones(rows.shape[1]), self.starts)
        size = (np.maximum(np.abs(low), np.abs(high)) ** 2).sum() + self.most_square
        keep = ~(least > most[self.group()] + 1e-9 * size)  # also where a number is none
        return _Centres(self.at[keep], self.k[keep], self.own[keep])

    def group(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.k))))


def _nearest(x: np.ndarray, centres: list[np.ndarray]):
    """(rows of a tile, their squared lengths, a list with, per k, the number of the nearest centre of each row, ties to the
    first, and the squared distance), tile by tile."""
    here = _Centres.of(centres).near(x)
    for a in range(0, len(x), TILE):
        tile = x[a : a + TILE]
        square, each, near = (tile * tile).sum(1), np.arange(len(tile)), here.near(tile)
        away = -2 * (tile @ near.at.T)
        away += near.square
        found = []
        for start, end in zip(near.starts, np.append(near.starts[1:], len(near.k))):
            at = away[:, start:end].argmin(1) if end - start > 1 else np.zeros(len(tile), np.int64)
            found.append((near.own[start + at], np.maximum(away[each, start + at] + square, 0)))
        yield tile, square, found


def cluster_sums(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, list]:
    """Per k the rows (cluster, n, q, within, s): count, squared lengths, squared distances and vector sum."""
    def partial(frames):
        held = {}
        for x in _blocks(frames):
            for tile, square, found in _nearest(x, list(centres.values())):
                row = np.column_stack([np.ones(len(tile)), square, square, tile])
                for (k, at), (label, row[:, 2]) in zip(centres.items(), found):
                    sums = held.setdefault(k, np.zeros((len(at), row.shape[1])))
                    order = np.argsort(label, kind="stable")
                    first = np.flatnonzero(np.diff(label[order], prepend=-1))
                    if len(first) == 1:
                        sums[label[0]] += row.sum(0)
                    else:
                        sums[label[order[first]]] += np.add.reduceat(row[order], first, axis=0)
        yield pd.DataFrame([(k, c, *row[:3], row[3:].tobytes()) for k, sums in held.items()
                            for c, row in enumerate(sums) if row[0]], columns=["k", "cluster", "n", "q", "within", "s"])

    def total(frames):
        held = {}
        for frame in frames:
            for k, c, n, q, within, s in frame.itertuples(index=False):
                row = np.concatenate([[n, q, within], np.frombuffer(s, np.float64)])
                held[k, c] = held.get((k, c), 0.0) + row
        yield pd.DataFrame([(*at, *row[:3], row[3:].tobytes()) for at, row in held.items()],
                           columns=["k", "cluster", "n", "q", "within", "s"])

    out: dict[int, list] = {k: [] for k in centres}
    sums = blocks.mapInPandas(partial, SUMS).repartition("k", "cluster").mapInPandas(total, SUMS)
    for r in sums.collect():
        out[r.k].append((r.cluster, r.n, r.q, r.within, np.frombuffer(r.s, np.float64)))
    return {k: sorted(rows, key=lambda r: r[0]) for k, rows in out.items()}


def _start(rows: DataFrame, most: int, sample: int, seed: int) -> np.ndarray:
    """Up to ``most`` starting centres: each drawn from a sample of the rows by its squared distance to those before."""
    drawn = rows.select(vector_to_array("features").alias("x")).orderBy(F.xxhash64("x", F.lit(seed))).limit(sample).collect()
    x = np.array([r.x for r in drawn], np.float64)
    if not len(x):
        return x
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    apart = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < most and apart.sum() > 0:
        chosen.append(int(rng.choice(len(x), p=apart / apart.sum())))
        apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def kmeans_sweep(rows: DataFrame, ks: tuple[int, ...], tolerance: float = 1e-4, rounds: int = 300, seed: int = 0,
                 sample: int = 16_384) -> Sweep:
    """Centres for each k from (id, features) rows; rows without features are left out.

    The starting centres come from ``sample`` rows with the least hashes, those of a smaller k being the first of
    those of a larger one; where there are fewer distinct rows than k, all are centres. Centres move until their squared
    moves sum to ``tolerance`` times the mean variance of a column, or for ``rounds`` rounds, and ``settled`` tells
    which. A cluster that loses all rows keeps its centre. Without rows there are no centres.
    """
    ready = rows.where("features IS NOT NULL")
    start = _start(ready, max(ks), sample, seed)
    blocks = hold(written(_pack(ready), "cluster-blocks"))
    centres = {k: start[:k].copy() for k in ks}
    settled = dict.fromkeys(ks, not len(start))
    within: dict[int, list[float]] = {k: [] for k in ks}
    for _ in range(rounds):
        moving = {k: centres[k] for k in ks if not settled[k]}
        if not moving:
            break
        for k, sums in cluster_sums(blocks, moving).items():
            n, whole = sum(r[1] for r in sums), sum(r[4] for r in sums)
            variance = (sum(r[2] for r in sums) / n - ((whole / n) ** 2).sum()) / len(whole)
            within[k].append(sum(r[3] for r in sums))
            after = centres[k].copy()
            for c, count, _q, _w, s in sums:
                after[c] = s / count
            settled[k] = bool(((after - centres[k]) ** 2).sum() <= tolerance * max(variance, 0))
            centres[k] = after
    return Sweep(blocks, centres, settled, within)


def _silhouettes(blocks: DataFrame, centres: dict[int, np.ndarray], sums: dict[int, list]) -> dict[int, float]:
    """Per k the mean over rows of (b - a) / max(a, b): a is the mean squared distance to the other rows of the
    cluster, b that to the rows of the nearest other cluster; rows alone in a cluster count 0."""
    def measure(frames):
        total = {}
        for x in _blocks(frames):
            for tile, square, nearest in _nearest(x, list(centres.values())):
                for (k, at), (label, _) in zip(centres.items(), nearest):
                    if len(sums[k]) < 2:
                        continue
                    place = np.full(len(at), -1)
                    place[[r[0] for r in sums[k]]] = np.arange(len(sums[k]))
                    own, each = place[label], np.arange(len(tile))
                    n, q, middle = parts[k]
                    apart = square[:, None] + q / n - 2 * (tile @ middle.T)
                    size = n[own]
                    a = np.maximum(apart[each, own], 0) * size / np.maximum(size - 1, 1)
                    apart[each, own] = np.inf
                    b = np.maximum(apart.min(1), 0)
                    found = np.where((size > 1) & (np.maximum(a, b) > 0), (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
                    total[k] = total.get(k, 0.0) + found.sum()
        yield pd.DataFrame(list(total.items()), columns=["k", "s"])

    parts = {}
    for k, rows in sums.items():
        n, q = (np.array([r[j] for r in rows]) for j in (1, 2))
        parts[k] = n, q, np.array([r[4] for r in rows]) / n[:, None]
    found = blocks.mapInPandas(measure, "k INT, s DOUBLE").groupBy("k").agg(F.sum("s").alias("s"))
    return {r.k: r.s / sum(row[1] for row in sums[r.k]) for r in found.collect()}


def kmeans_quality(rows: DataFrame, ks: tuple[int, ...], **how) -> DataFrame:
    """(k, clusters, silhouette, ch) for every k of the sweep, and the number of clusters that hold rows. Silhouette is
    NULL with fewer than two clusters; the Calinski-Harabasz figure also where each row is a cluster of its own."""
    sweep = kmeans_sweep(rows, ks, **how)
    sums = cluster_sums(sweep.blocks, sweep.centres)
    shape = _silhouettes(sweep.blocks, sweep.centres, sums)
    sweep.blocks.unpersist()
    out = []
    for k in ks:
        found, ch = len(sums[k]), None
        n = sum(r[1] for r in sums[k])
        if 1 < found < n:
            middle = sum((r[4] ** 2).sum() / r[1] for r in sums[k])
            inside = sum(r[2] for r in sums[k]) - middle
            between = middle - (sum(r[4] for r in sums[k]) ** 2).sum() / n
            ch = float((between / (found - 1)) / (inside / (n - found))) if inside > 1e-9 * max(middle, 1e-300) else None
        out.append((k, found, float(shape[k]) if k in shape else None, ch))
    return rows.sparkSession.createDataFrame(out, "k INT, clusters INT, silhouette DOUBLE, ch DOUBLE")
