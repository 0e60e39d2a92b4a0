"""Boosted trees on binned histograms, grown best leaf first.

Rows are binned once and packed into blocks (one table row holds the codes, labels and margins of
some thousand examples). A pass over the blocks sums gradients, curvatures and counts per (leaf,
feature, bin) in every task, adds them up by feature and hands one best split per leaf and task to
the driver, which holds trees of bounded size and nothing else. Once no large leaf is asked for, the rows of
each leaf that has become small are sent to one task, which grows all below it; so a tree takes one pass for each
level of large leaves and one for all small ones. All settings of a grid and all folds grow in the same
passes. A tree is added to the margins once, in the first pass of the next; every ``STEP`` trees the blocks are
written, so a lost executor never replays earlier trees, and the table written before goes.

A table of ``WHOLE`` such leaves at most is sent once to one task for each model, which grows all of its trees.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field, replace
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.session import discard, forget, hold, written

BINS = 64
STEP = 10
CELLS = 1 << 22  # (leaf, feature, bin) sums a task holds in one pass

HERE = 1 << 24  # bytes of a leaf's rows up to which one task grows all below it
WHOLE = 2  # times that: a table up to which one task grows all trees of a model
WAIT = 3  # passes over large leaves after which small ones wait no longer
BLOCK_ROWS = 1 << 13  # rows from which another task is worth its cost
TASK_ROWS = 1 << 20  # rows of one task at most

BLOCK = "n INT, y BINARY, fold BINARY, key BINARY, codes BINARY, margin BINARY"
SPLIT = "gain DOUBLE, feature INT, cut INT, g DOUBLE, h DOUBLE, n DOUBLE, tg DOUBLE, th DOUBLE, tn DOUBLE"
PART = "model INT, slot INT, codes BINARY, g BINARY, h BINARY"
NODE = f"model INT, slot INT, node INT, depth INT, kid INT, {SPLIT}"
TREE = "model INT, number INT, feature BINARY, cut BINARY, kids BINARY, value BINARY, leaf BINARY, held BIGINT"


class Split(NamedTuple):
    """Codes up to ``cut`` go left; sums of the left part and of the whole leaf. ``gain`` is -inf where no cut fits."""

    gain: float
    feature: int
    cut: int
    g: float
    h: float
    n: float
    tg: float
    th: float
    tn: float


@dataclass(frozen=True)
class Setting:
    """How one model grows. ``depth`` 0 sets no limit; rows are drawn anew every ``fresh`` trees;
    rows of ``fold`` stay out of training (-1: none do)."""

    trees: int = 100
    leaves: int = 64
    depth: int = 0
    rate: float = 0.01
    rows: float = 0.8
    fresh: int = 5
    columns: float = 0.9
    ridge: float = 0.0
    least_rows: int = 20
    least_weight: float = 1e-3
    least_gain: float = 0.0
    fold: int = -1
    seed: int = 9


@dataclass
class Tree:
    """Nodes by number, the root first; ``feature`` is -1 at a leaf. Codes up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    kids: np.ndarray
    value: np.ndarray
    leaf: np.ndarray

    def places(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        moving = np.arange(len(codes) if self.feature[0] >= 0 else 0)
        flat, width, kids = codes.ravel(), codes.shape[1], self.kids.ravel()
        while len(moving):
            here = at[moving]
            right = flat.take(moving * width + self.feature.take(here)) > self.cut.take(here)
            at[moving] = here = kids.take(2 * here + right)
            moving = moving[self.feature.take(here) >= 0]
        return at


@dataclass
class Boosted:
    """The trees of one setting, with the bins and the log odds they start from."""

    cuts: list[np.ndarray]
    base: float
    setting: Setting
    trees: list[Tree] = field(default_factory=list)


@dataclass
class _Node:
    depth: int
    sums: tuple[float, float, float]
    split: Split | None = None
    known: bool = False
    kids: tuple[int, int] | None = None


class _Growing:
    """A tree in the making. Leaves are split in the order of their gain; as a leaf's gain is known only
    after a pass, each pass measures the children of every leaf that the gains known so far would split.
    Gains yet unknown can only push such a leaf out, so the last order is that of one split at a time."""

    def __init__(self, setting: Setting, rows: float, depth: int = 0):
        self.setting = setting
        self.nodes = [_Node(depth, (0.0, 0.0, rows))]

    def order(self) -> list[int]:
        """The nodes split, best first, by the gains known."""
        heap, out = [], []

        def offer(at):
            node = self.nodes[at]
            if node.known and node.split is not None:
                heapq.heappush(heap, (-node.split.gain, at))

        offer(0)
        while heap and len(out) < self.setting.leaves - 1:
            at = heapq.heappop(heap)[1]
            out.append(at)
            for kid in self.nodes[at].kids or ():
                offer(kid)
        return out

    def wanted(self) -> list[int]:
        """Gives children to the nodes to be split and lists those whose gain is not known."""
        if not self.nodes[0].known:
            return [0]
        out = []
        for at in self.order():
            node = self.nodes[at]
            if node.kids is None:
                left = (node.split.g, node.split.h, node.split.n)
                right = tuple(a - b for a, b in zip(node.sums, left))
                node.kids = (len(self.nodes), len(self.nodes) + 1)
                for sums in (left, right):
                    deep = self.setting.depth and node.depth + 1 >= self.setting.depth
                    closed = bool(deep) or sums[2] < 2 * self.setting.least_rows
                    self.nodes.append(_Node(node.depth + 1, sums, known=closed))
            out.extend(kid for kid in node.kids if not self.nodes[kid].known)
        return out

    def tell(self, at: int, found: Split | None) -> None:
        node = self.nodes[at]
        node.known = True
        if found is not None:
            node.sums = (found.tg, found.th, found.tn)
            if found.gain > self.setting.least_gain:
                node.split = found

    def graft(self, at: int, rows: list) -> None:
        """Takes over the nodes a task has grown below ``at``."""
        start = len(self.nodes) - 1
        for r in sorted(rows, key=lambda r: r.node):
            if r.node:
                self.nodes.append(_Node(r.depth, (r.tg, r.th, r.tn)))
            self.tell(start + r.node if r.node else at, Split(*r[5:]))
            if r.kid >= 0:
                self.nodes[start + r.node if r.node else at].kids = (start + r.kid, start + r.kid + 1)

    def tree(self, inner: list[int] | None = None) -> Tree:
        """The tree whose inner nodes are ``inner`` (all that have children, if not given)."""
        inner = [k for k, node in enumerate(self.nodes) if node.kids] if inner is None else inner
        size, rate, ridge = len(self.nodes), self.setting.rate, self.setting.ridge
        feature, cut, kids = np.full(size, -1, np.int32), np.zeros(size, np.int16), np.zeros((size, 2), np.int32)
        for at in inner:
            node = self.nodes[at]
            feature[at], cut[at], kids[at] = node.split.feature, node.split.cut, node.kids
        value = np.array([-rate * n.sums[0] / (n.sums[1] + ridge) if n.sums[1] + ridge > 0 else 0.0 for n in self.nodes])
        reached = {0} | {kid for at in inner for kid in self.nodes[at].kids}
        leaf = np.full(size, -1, np.int32)
        ends = sorted(reached - set(inner))
        leaf[ends] = np.arange(len(ends))
        return Tree(feature, cut, kids, value, leaf)


def _draws(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each 64-bit key, the same in every run and partition."""
    z = keys ^ np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def bin_cuts(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the upper ends of its bins but the last, at the quantiles of its values; what is not a number has the
    last bin to itself."""
    cells = rows.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
    probs = F.array(*[F.lit((k + 1) / (bins - 1)) for k in range(bins - 1)])
    number = F.when(~F.isnan("x"), F.col("x"))
    found = cells.groupBy("feature").agg(
        F.percentile_approx(number, probs, F.lit(10_000)).alias("at"), F.max(number).alias("top"), F.max(F.isnan("x")).alias("odd"))
    by_feature = {r.feature: np.array(sorted({x for x in r["at"] or [] if r.odd or x < r.top})) for r in found.collect()}
    width = max(by_feature, default=-1) + 1
    return [by_feature.get(k, np.zeros(0)) for k in range(width)]


def _codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers; a value that is not a number counts as the largest."""
    out = np.zeros((len(x), len(cuts)), np.uint8)
    for k, edges in enumerate(cuts):
        out[:, k] = np.searchsorted(edges, np.where(np.isnan(x[:, k]), np.inf, x[:, k]), side="left")
    return out


def _unpack(row, width: int, models: int):
    codes = np.frombuffer(row.codes, np.uint8).reshape(row.n, width)
    margin = np.frombuffer(row.margin, np.float64).reshape(models, row.n)
    return codes, np.frombuffer(row.y, np.float64), np.frombuffer(row.fold, np.uint8), \
        np.frombuffer(row.key, np.uint64), margin


def _pack_blocks(rows: DataFrame, cuts: list[np.ndarray], bases: list[float]) -> DataFrame:
    def pack(frames):
        for frame in frames:
            n = len(frame)
            codes = _codes(np.array(frame["x"].tolist(), np.float64).reshape(n, -1), cuts)
            margin = np.repeat(np.array(bases), n)
            yield pd.DataFrame({
                "n": [n], "y": [frame["label"].to_numpy(np.float64).tobytes()],
                "fold": [frame["fold"].to_numpy(np.uint8).tobytes()],
                "key": [frame["key"].to_numpy(np.int64).tobytes()], "codes": [codes.tobytes()], "margin": [margin.tobytes()]})

    return rows.select("label", "fold", "key", vector_to_array("features").alias("x")).mapInPandas(pack, BLOCK)


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """The rows over as many tasks as their number asks for, however many the table came in: every pass is one stage
    of them."""
    most = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(most, -(-n // BLOCK_ROWS)), -(-n // TASK_ROWS)))


def _moved(blocks: DataFrame, width: int, fresh: list[list[Tree]]) -> DataFrame:
    """The blocks with ``fresh`` trees added to the margins."""
    def move(frames):
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                codes, _, _, _, margin = _unpack(row, width, len(fresh))
                out.append(_with_trees(codes, margin, fresh).tobytes())
            yield frame.assign(margin=out)

    return blocks.mapInPandas(move, BLOCK)


def _with_trees(codes: np.ndarray, margin: np.ndarray, fresh: list[list[Tree]]) -> np.ndarray:
    margin = margin.copy()
    for m, trees in enumerate(fresh):
        for tree in trees:
            margin[m] += tree.value[tree.places(codes)]
    return margin


def _best_cuts(cells: np.ndarray, setting: Setting) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf the best cut of one feature, from (leaf, bin, 3) sums, and a row of its gain and the sums left of it and of the
    leaf; ties go to the smaller cut."""
    left, whole = cells.cumsum(1)[:, :-1], cells.sum(1)[:, None]
    right = whole - left

    def score(part):
        return part[..., 0] ** 2 / np.maximum(part[..., 1] + setting.ridge, 1e-12)

    gain = np.round(score(left) + score(right) - score(whole), 9)
    fits = (np.minimum(left[..., 2], right[..., 2]) >= max(setting.least_rows, 1)) & \
        (np.minimum(left[..., 1], right[..., 1]) >= setting.least_weight)
    gain = np.where(fits, gain, -np.inf)
    cuts = gain.argmax(1)
    each = np.arange(len(cells))
    return cuts, np.column_stack([gain[each, cuts], left[each, cuts], whole[:, 0]])


def _best(cells: np.ndarray, setting: Setting) -> list[Split]:
    cuts, found = _best_cuts(cells, setting)
    return [Split(r[0], -1, cut, *r[1:]) for cut, r in zip(cuts.tolist(), found.tolist())]


def _histograms(slot: np.ndarray, size: int, codes: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(leaf, feature, bin, 3) sums of rows whose leaf is ``slot``."""
    wide = codes.shape[1]
    out, start = np.empty((size, wide, BINS, 3)), slot * BINS
    for k in range(wide):
        cell = start + codes[:, k]
        for j, weight in enumerate((g, h, None)):
            out[:, k, :, j] = np.bincount(cell, weight, size * BINS).reshape(size, BINS)
    return out


class _Pass(NamedTuple):
    """What a task needs to place rows: trees being grown and features drawn."""

    settings: list[Setting]
    width: int
    growing: list[Tree]
    columns: list[np.ndarray]
    number: int
    bins: np.ndarray

    def rows(self, frames, slots: list[np.ndarray]):
        """(model, leaf slot, codes of the drawn features, gradients, curvatures) of the rows drawn, block by block."""
        for frame in frames:
            for row in frame.itertuples(index=False):
                codes, y, fold, key, margin = _unpack(row, self.width, len(self.settings))
                for m, setting in enumerate(self.settings):
                    if not (slots[m] >= 0).any():
                        continue
                    slot = slots[m][self.growing[m].places(codes)]
                    use = slot >= 0
                    if setting.fold >= 0:
                        use &= fold != setting.fold
                    if setting.rows < 1:
                        use &= _draws(key, setting.seed + 1 + self.number // setting.fresh) < setting.rows
                    chance = 1 / (1 + np.exp(-margin[m, use]))
                    yield m, slot[use], codes[use][:, self.columns[m]], chance - y[use], chance * (1 - chance)


def _best_splits(blocks: DataFrame, step: _Pass, slots: list[np.ndarray]) -> DataFrame:
    """One row per (model, slot) and task of the second stage: the split of largest gain among the task's features,
    ties to the smaller feature and cut."""
    def partial(frames):
        held = {}
        for m, slot, codes, g, h in step.rows(frames, slots):
            held[m] = held.get(m, 0.0) + _histograms(slot, int(slots[m].max()) + 1, codes, g, h)
        out = [(m, int(f), np.ascontiguousarray(cells[:, k]).tobytes())
               for m, cells in held.items() for k, f in enumerate(step.columns[m])]
        yield pd.DataFrame(out, columns=["model", "feature", "cells"])

    def best(frames):
        held, top = {}, {}
        for frame in frames:
            for model, feature, cells in zip(frame["model"], frame["feature"], frame["cells"]):
                at = (int(feature), int(model))
                held[at] = held.get(at, 0.0) + np.frombuffer(cells, np.float64)
        for (feature, model), cells in sorted(held.items()):
            for slot, split in enumerate(_best(cells.reshape(-1, BINS, 3), step.settings[model])):
                if (model, slot) not in top or split.gain > top[model, slot].gain:
                    top[model, slot] = split._replace(feature=feature)
        yield pd.DataFrame([(*at, *split) for at, split in top.items()], columns=["model", "slot", *Split._fields])

    sums = blocks.mapInPandas(partial, "model INT, feature INT, cells BINARY")
    return sums.repartition("model", "feature").mapInPandas(best, f"model INT, slot INT, {SPLIT}")


def _grow_below(tree: _Growing, columns: np.ndarray, bins: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
    """Grows ``tree`` over rows that are all here; ``codes`` has a line for each of ``columns``, and ``bins`` their numbers of bins."""
    place = {int(feature): k for k, feature in enumerate(columns)}
    at, parted = np.zeros(len(g), np.int64), set()
    many = max(1, CELLS // (len(columns) * BINS))
    while wanted := tree.wanted():
        size = len(tree.nodes)
        line, cut, kid = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for k, node in enumerate(tree.nodes):
            if node.kids and k not in parted:
                parted.add(k)
                line[k], cut[k], kid[k] = place[node.split.feature], node.split.cut, node.kids[0]
        moving = np.flatnonzero(line.take(at) >= 0)
        if len(moving):
            nodes = at[moving]
            at[moving] = kid.take(nodes) + (codes.ravel().take(line.take(nodes) * len(g) + moving) > cut.take(nodes))
        for part in (wanted[a : a + many] for a in range(0, len(wanted), many)):
            slot = np.full(size, -1)
            slot[part] = np.arange(len(part))
            slots = slot.take(at)
            mine, best = np.flatnonzero(slots >= 0), None
            slots, gs, hs = slots.take(mine), g.take(mine), h.take(mine)
            for k, feature in enumerate(columns):
                cell = slots * bins[k] + codes[k].take(mine)
                cells = np.stack([np.bincount(cell, w, len(part) * bins[k]) for w in (gs, hs, None)], 1)
                cuts, found = _best_cuts(cells.reshape(len(part), bins[k], 3), tree.setting)
                if best is None:
                    best, features, ends = found, np.full(len(part), feature), cuts
                else:
                    better = found[:, 0] > best[:, 0]
                    best[better], features[better], ends[better] = found[better], feature, cuts[better]
            for node, feature, end, row in zip(part, features.tolist(), ends.tolist(), best.tolist()):
                tree.tell(node, Split(row[0], feature, end, *row[1:]))


def _grown(blocks: DataFrame, step: _Pass, slots: list[np.ndarray], depths: dict[tuple[int, int], int]) -> DataFrame:
    """(model, slot, node, ...): the nodes below small leaves, each leaf's rows in one task of ``HERE`` bytes."""
    def send(frames):
        for m, slot, codes, g, h in step.rows(frames, slots):
            order = np.argsort(slot, kind="stable")
            ends = np.flatnonzero(np.diff(slot[order])) + 1
            parts = [p for p in np.split(order, ends) if len(p)]
            yield pd.DataFrame([(m, int(slot[p[0]]), codes[p].tobytes(), g[p].tobytes(), h[p].tobytes()) for p in parts],
                               columns=["model", "slot", "codes", "g", "h"])

    def grow(at, frame):
        model, slot = (int(k) for k in at)
        setting, columns = step.settings[model], step.columns[model]
        codes = np.frombuffer(b"".join(frame["codes"]), np.uint8).reshape(-1, len(columns))
        g, h = (np.frombuffer(b"".join(frame[c]), np.float64) for c in ("g", "h"))
        tree = _Growing(setting, len(g), depths[model, slot])
        _grow_below(tree, columns, step.bins[columns], np.ascontiguousarray(codes.T), g, h)
        out = []
        for k, node in enumerate(tree.nodes):
            split = node.split or Split(-np.inf, -1, 0, 0.0, 0.0, 0.0, *node.sums)
            out.append((model, slot, k, node.depth, node.kids[0] if node.kids else -1, *split))
        return pd.DataFrame(out, columns=["model", "slot", "node", "depth", "kid", *Split._fields])

    # the rows are few and the work on them is not, so tasks are not merged by size
    tasks = min(len(depths), blocks.sparkSession.sparkContext.defaultParallelism)
    sent = blocks.mapInPandas(send, PART).repartition(tasks, "model", "slot")
    return sent.groupBy("model", "slot").applyInPandas(grow, NODE)


def _slots(asked: list[tuple[int, int]], growing: list[_Growing]) -> list[np.ndarray]:
    """Per model the number of each node among those asked for, -1 for others."""
    out = [np.full(len(g.nodes), -1) for g in growing]
    for m, at in asked:
        out[m][at] = out[m].max() + 1
    return out


def _drawn_columns(setting: Setting, width: int, number: int) -> np.ndarray:
    shuffled = np.random.default_rng((setting.seed, number)).permutation(width)
    return np.sort(shuffled[:max(1, int(np.ceil(setting.columns * width)))])


def _grown_whole(blocks: DataFrame, settings: list[Setting], bases: list[float], bins: np.ndarray, keep: bool) -> DataFrame:
    """(model, number, ...): the trees of every model (none unless ``keep``), each model's in one task that has all rows, and under the
    number -1 how many rows of its held-out fold the model predicts right."""
    models, width = len(settings), len(bins)

    def grow(frames):
        held = {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                codes = np.frombuffer(row.codes, np.uint8).reshape(row.n, width)
                parts = np.frombuffer(row.y, np.float64), np.frombuffer(row.fold, np.uint8), np.frombuffer(row.key, np.uint64), codes
                held.setdefault(row.model, []).append(parts)
        for model in sorted(held):
            y, fold, key, codes = (np.concatenate(part) for part in zip(*held.pop(model)))
            order = np.argsort(key, kind="stable")  # whatever the partitions were
            yield from _all_trees(model, settings[model], bases[model], bins, y[order], fold[order], key[order], codes[order], keep)

    each = blocks.select("n", "y", "fold", "key", "codes", F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model"))
    return each.repartitionByRange(models, "model").mapInPandas(grow, TREE)


def _all_trees(model: int, setting: Setting, base: float, bins: np.ndarray, y: np.ndarray, fold: np.ndarray, key: np.ndarray,
               codes: np.ndarray, keep: bool):
    """Frames of the trees of one model, some at a time, and of its right predictions."""
    margin, inside = np.full(len(y), base), fold != setting.fold if setting.fold >= 0 else np.ones(len(y), bool)
    lines, out = np.ascontiguousarray(codes.T), []
    for number in range(setting.trees):
        if number % setting.fresh == 0 or number == 0:
            drawn = inside & (_draws(key, setting.seed + 1 + number // setting.fresh) < setting.rows) if setting.rows < 1 else inside
            mine = np.flatnonzero(drawn)
        columns = _drawn_columns(setting, len(bins), number)
        chance = 1 / (1 + np.exp(-margin[mine]))
        growing = _Growing(setting, len(mine))
        if len(mine):
            _grow_below(growing, columns, bins[columns], lines[np.ix_(columns, mine)], chance - y[mine], chance * (1 - chance))
        else:
            growing.tell(0, None)
        tree = growing.tree(growing.order())
        margin += tree.value[tree.places(codes)]
        if keep:
            out.append((model, number, *(x.tobytes() for x in (tree.feature, tree.cut, tree.kids, tree.value, tree.leaf)), 0))
        if len(out) == STEP:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in TREE.split(", ")])
            out = []
    held = ~inside
    out.append((model, -1, *[b""] * 5, int(((margin >= 0) == (y > 0.5))[held].sum())))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in TREE.split(", ")])


def _held_right(blocks: DataFrame, width: int, settings: list[Setting]) -> dict[int, float]:
    """Per model how many rows of its held-out fold its margins predict right."""
    def count(frames):
        right = np.zeros(len(settings), np.int64)
        for frame in frames:
            for row in frame.itertuples(index=False):
                _, y, fold, _, margin = _unpack(row, width, len(settings))
                for m, setting in enumerate(settings):
                    if setting.fold >= 0:
                        right[m] += ((margin[m] >= 0) == (y > 0.5))[fold == setting.fold].sum()
        yield pd.DataFrame({"model": np.arange(len(settings)), "held": right})

    parts = blocks.mapInPandas(count, "model INT, held BIGINT").groupBy("model").agg(F.sum("held").alias("held"))
    return {r.model: r.held for r in parts.collect()}


def fit(rows: DataFrame, settings: list[Setting], folds: int = 3) -> list[Boosted]:
    """A model for each setting from (id, label, features) rows, all grown in the same passes.

    Labels are 0 or 1, features vectors of one length; rows without a label or features are left out, and a
    table without rows gives models without trees that predict one half. Rows count as often as they occur.
    The draws of rows and folds follow from the id, so partitions and retries change nothing but the order of
    floating-point sums. A task holds ``CELLS`` sums, or those of one leaf where features need more.
    """
    return _fitted(rows, settings, folds)[0]


def _fitted(rows: DataFrame, settings: list[Setting], folds: int, keep: bool = True) -> tuple[list[Boosted], dict[int, float]]:
    """The models, without their trees unless ``keep``, and per model how many rows of its held-out fold it predicts right."""
    rows = hold(rows.where("label IS NOT NULL AND features IS NOT NULL").select(
        "label", "features", F.xxhash64("id").alias("key"),
        F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold")))
    counts = {r.fold: (r.n, r.s) for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("s")).collect()}
    cuts = bin_cuts(rows)
    out = []
    for setting in settings:
        n, s = (sum(c[k] for f, c in counts.items() if f != setting.fold) for k in (0, 1))
        mean = min(max(s / n, 1e-6), 1 - 1e-6) if n else 0.5
        out.append(Boosted(cuts, float(np.log(mean / (1 - mean))), setting))
    if not cuts:
        return out, {}
    width, models, total = len(cuts), len(settings), sum(n for n, _ in counts.values())
    bins = np.array([max(2, len(edges) + 1) for edges in cuts])
    spread = dealt(rows, total)
    table = written(_pack_blocks(spread, cuts, [b.base for b in out]), "boosting-blocks")
    rows.unpersist()
    most = HERE // (width + 24)
    if total <= WHOLE * most:
        right = {}
        for r in _grown_whole(table, settings, [b.base for b in out], bins, keep).collect():
            if r.number < 0:
                right[r.model] = r.held
            else:
                kinds = (np.int32, np.int16, np.int32, np.float64, np.int32)
                feature, cut, kids, value, leaf = (np.frombuffer(x, kind) for x, kind in zip((r.feature, r.cut, r.kids, r.value, r.leaf), kinds))
                out[r.model].trees.append(Tree(feature, cut, kids.reshape(-1, 2), value, leaf))
        discard(table)
        return out, right
    blocks, before = hold(table), []
    for number in range(max(s.trees for s in settings)):
        growing = [_Growing(s, sum(n for f, (n, _) in counts.items() if f != s.fold)) for s in settings]
        live = [number < s.trees for s in settings]
        columns = [_drawn_columns(s, width, number) for s in settings]
        waited = 0
        while True:
            asked = [(m, at) for m in range(models) if live[m] for at in growing[m].wanted()]
            if not asked:
                break
            step = _Pass(settings, width, [g.tree() for g in growing], columns, number, bins)
            small = [(m, at) for m, at in asked if growing[m].nodes[at].sums[2] <= most]
            large = [(m, at) for m, at in asked if growing[m].nodes[at].sums[2] > most]
            large = large[:max(1, CELLS // (width * BINS))]
            waited += 1
            # a gain yet unknown can only push a leaf out, so small ones may wait, but not for long chains of large ones
            if small and (not large or waited >= WAIT):
                waited = 0
                slots = _slots(small, growing)
                depths = {(m, int(slots[m][at])): growing[m].nodes[at].depth for m, at in small}
                found = {}
                for r in _grown(blocks, step, slots, depths).collect():
                    found.setdefault((r.model, r.slot), []).append(r)
                for m, at in small:
                    key = (m, int(slots[m][at]))
                    if key in found:
                        growing[m].graft(at, found[key])
                    else:
                        growing[m].tell(at, None)
            if large:
                slots = _slots(large, growing)
                best = {}
                for r in _best_splits(blocks, step, slots).collect():
                    key, split = (r.model, r.slot), Split(*r[2:])
                    if key not in best or (-split.gain, split.feature) < (-best[key].gain, best[key].feature):
                        best[key] = split
                for m, at in large:
                    growing[m].tell(at, best.get((m, int(slots[m][at]))))
            while before:  # the pass has read, and so kept, all blocks of this tree
                before.pop().unpersist()
        fresh: list[list[Tree]] = [[] for _ in settings]
        for m in range(models):
            if live[m]:
                tree = growing[m].tree(growing[m].order())
                fresh[m].append(tree)
                if keep:
                    out[m].trees.append(tree)
        before.append(blocks)
        blocks = _moved(blocks, width, fresh)
        if (number + 1) % STEP == 0:
            old, table = table, written(blocks, "boosting-blocks")
            blocks = table
            while before:
                before.pop().unpersist()
            discard(old)
            forget(rows.sparkSession)
        blocks = hold(blocks)
    right = _held_right(blocks, width, settings)
    for held in (*before, blocks):
        held.unpersist()
    discard(table)
    return out, right


def scores(model: Boosted, rows: DataFrame) -> DataFrame:
    """(id, label, pred): the probability of label 1 of (id, label, features) rows."""
    def score(frames):
        for frame in frames:
            codes = _codes(np.array(frame["x"].tolist(), np.float64).reshape(len(frame), -1), model.cuts)
            margin = _with_trees(codes, np.full((1, len(frame)), model.base), [model.trees])[0]
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "pred": 1 / (1 + np.exp(-margin))})

    return _spread(rows, score, "pred DOUBLE")


def leaves(model: Boosted, rows: DataFrame) -> DataFrame:
    """(id, label, leaves): per tree the number of the leaf the row falls into."""
    def find(frames):
        for frame in frames:
            codes = _codes(np.array(frame["x"].tolist(), np.float64).reshape(len(frame), -1), model.cuts)
            ends = [tree.leaf[tree.places(codes)] for tree in model.trees]
            found = np.stack(ends, 1) if ends else np.zeros((len(frame), 0), np.int64)
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "leaves": list(found)})

    return _spread(rows, find, "leaves ARRAY<INT>")


def _spread(rows: DataFrame, fn, column: str) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    ready = rows.where("features IS NOT NULL").select("id", "label", vector_to_array("features").alias("x"))
    return ready.mapInPandas(fn, f"id {kind}, label DOUBLE, {column}")


def progress(models: list[Boosted], rows: DataFrame, folds: int = 3) -> DataFrame:
    """(model, tree, held, loss, right, n): summed logistic loss, rows predicted right and rows after each tree (0: before
    the first), apart for rows the model was trained on and those of its held-out fold; from one pass over the rows."""
    def measure(frames):
        total = {}
        for frame in frames:
            y, fold = frame["label"].to_numpy(np.float64), frame["fold"].to_numpy()
            codes = _codes(np.array(frame["x"].tolist(), np.float64).reshape(len(frame), -1), models[0].cuts)
            for m, model in enumerate(models):
                margin, held = np.full(len(y), model.base), fold == model.setting.fold
                for number in range(len(model.trees) + 1):
                    if number:
                        tree = model.trees[number - 1]
                        margin = margin + tree.value[tree.places(codes)]
                    loss, right = np.logaddexp(0, margin) - y * margin, (margin >= 0) == (y > 0.5)
                    for side in (False, True):
                        at = (m, number, side)
                        now = np.array([loss[held == side].sum(), right[held == side].sum(), (held == side).sum()])
                        total[at] = total.get(at, 0.0) + now
        yield pd.DataFrame([(*at, *v) for at, v in total.items()], columns=["model", "tree", "held", "loss", "right", "n"])

    ready = rows.where("label IS NOT NULL AND features IS NOT NULL").select(
        "label", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold"),
        vector_to_array("features").alias("x"))
    parts = ready.mapInPandas(measure, "model INT, tree INT, held BOOLEAN, loss DOUBLE, right DOUBLE, n DOUBLE")
    return parts.groupBy("model", "tree", "held").agg(*[F.sum(c).alias(c) for c in ("loss", "right", "n")])


def search(rows: DataFrame, base: Setting, rates: tuple[float, ...], folds: int = 3) -> float:
    """The learning rate whose models predict most held-out rows right, ties to the smaller rate. All rates and
    folds grow in the same passes."""
    grid = [replace(base, rate=rate, fold=fold) for rate in rates for fold in range(folds)]
    right = dict.fromkeys(rates, 0)
    for model, n in _fitted(rows, grid, folds, keep=False)[1].items():
        right[grid[model].rate] += n
    return min(rates, key=lambda rate: (-right[rate], rate))
