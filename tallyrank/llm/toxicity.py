"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import by_bytes, crc_remainder, texts_of, word_bytes

#: n-grams of a word and its two ends are hashed to so many features.
FEATURES = 1 << 18
GRAMS = (3, 4, 5, 6)
#: Features the classifier uses at most: those whose counts differ most between the classes, ...
USED = 4_000
#: ... by this many standard errors at least.
CLEAR = 4.0
#: Labelled rows the classifier is fitted on at most: those with the smallest hash of their id.
SAMPLE_ROWS = 16_384
ROUNDS, RATE, DECAY = 200, 0.05, 1e-3
CACHE_WORDS = 1_000_000
THRESHOLD = 0.7
#: A worker's words and their shares, of the model it used last.
_kept: dict[str, dict[bytes, float]] = {}


def kept_words(model: str) -> dict[bytes, float]:
    """What this worker knows of a model's words from the tasks before."""
    if model not in _kept:
        _kept.clear()
        _kept[model] = {}
    return _kept[model]


def word_features(word: bytes) -> set[int]:
    """Hashed character n-grams of a word in lower case, < and > standing for its ends."""
    letters = f"<{word.decode('utf-8', 'replace').lower()}>".encode("utf-32-le")  # four bytes a character
    size = len(letters) // 4
    return {zlib.crc32(letters[4 * i : 4 * (i + n)]) % FEATURES for n in GRAMS for i in range(max(1, size - n + 1))}


@dataclass
class ToxicModel:
    """``weight`` of a feature is its log-count ratio times the fitted weight."""

    weight: dict[int, float]
    bias: float
    words: dict[bytes, float] = field(default_factory=dict, repr=False)

    def score(self, texts: list[str]) -> np.ndarray:
        """A feature's value is the number of distinct words that have it, so a text's margin is the sum
        over its distinct words, and a word's share is worked out once."""
        sets = [set(word_bytes(t)) for t in texts]
        missing = set().union(*sets) - self.words.keys()
        if len(self.words) + len(missing) > CACHE_WORDS:
            self.words.clear()
            missing = set().union(*sets)
        get = self.weight.get
        for w in missing:
            self.words[w] = sum(filter(None, map(get, word_features(w))))
        margin = np.array([sum(map(self.words.__getitem__, sorted(s))) for s in sets], np.float64) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """doc_id, text, y of the sample. Its ids and labels are broadcast, so no text is shuffled; the bound
    on its rows is the bound on what is sent."""
    own = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("y"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (crc_remainder(F.col("doc_id"), 3) != 1))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).join(F.broadcast(sample), "doc_id")


def log_count_ratios(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The log-count ratio of each feature over rows of text and y, and how clear it is.

    Every partition adds up its rows; what is shuffled and what reaches the driver is bounded by the
    number of features.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros((2, FEATURES), np.int64), [0, 0]
        features: dict[bytes, np.ndarray] = {}
        for part in by_bytes(batches):
            for t, y in zip(texts_of(part), part.column("y").to_pylist(), strict=True):
                found = []
                for w in set(word_bytes(t)):
                    f = features.get(w)
                    if f is None:
                        if len(features) > CACHE_WORDS // 8:
                            features.clear()
                        f = features[w] = np.fromiter(word_features(w), np.int32)
                    found.append(f)
                n[y] += 1
                if found:
                    here = np.zeros(FEATURES, bool)
                    here[np.concatenate(found)] = True
                    seen[y] += here
        some = np.flatnonzero(seen.any(0))
        columns = [np.append(some, -1), np.append(seen[0][some], n[0]), np.append(seen[1][some], n[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["feature", "clean", "toxic"])

    counted = labelled.select("text", "y").mapInArrow(count, "feature bigint, clean bigint, toxic bigint")
    found = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    seen, n = np.zeros((2, FEATURES)), np.zeros(2)
    for side, name in enumerate(("clean", "toxic")):
        seen[side, found.feature[found.feature >= 0]] = found[name][found.feature >= 0]
        n[side] = found[name][found.feature < 0].sum()
    p, q = (seen[1] + 1) / (n[1] + 2), (seen[0] + 1) / (n[0] + 2)
    both = (seen.sum(0) + 1) / (n.sum() + 2)
    error = np.sqrt(both * (1 - both) * (1 / (n[0] + 2) + 1 / (n[1] + 2)))
    return np.log(p / q), np.abs(p - q) / error


def train_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, used: int = USED, clear: float = CLEAR,
) -> ToxicModel:
    """Learns from rows whose crc32 of the id, modulo 3, is not 1.

    At most ``sample_rows`` of them, taken by a hash of the id. The weights are those of a logistic
    regression on the features scaled by their log-count ratios; only the used features of the
    sample reach the driver, of rows that share an id and label those of one. Null labels are left out; without
    both classes, as in empty tables, every text gets the same score.
    """
    labelled = _sampled(docs, labels, doc_id, text, label, sample_rows)
    ratio, clearness = log_count_ratios(labelled)
    order = np.argsort(-clearness, kind="stable")[:used]
    chosen = np.sort(order[clearness[order] >= clear])
    place = {int(f): k for k, f in enumerate(chosen)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, list[int]] = {}
        for part in by_bytes(batches):
            found = []
            for t in texts_of(part):
                ids: list[int] = []
                for w in set(word_bytes(t)):
                    f = cache.get(w)
                    if f is None:
                        if len(cache) > CACHE_WORDS // 8:
                            cache.clear()
                        f = cache[w] = [place[x] for x in word_features(w) if x in place]
                    ids += f
                found.append(np.unique(np.array(ids, np.int32), return_counts=True))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").cast(pa.string()), part.column("y"), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                pa.array([b.astype(np.int32).tobytes() for _, b in found], pa.binary())], ["doc_id", "y", "ids", "counts"])

    rows = labelled.mapInArrow(features, "doc_id string, y int, ids binary, counts binary")
    found = rows.groupBy("doc_id", "y").agg(F.min(F.struct("ids", "counts")).alias("f")).select("doc_id", "y", "f.*").collect()
    found.sort(key=lambda r: (r.doc_id, r.y, r.ids))
    y = np.array([r.y for r in found], np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2 or len(chosen) == 0:
        return ToxicModel({}, bias)
    ids = [np.frombuffer(r.ids, np.int32) for r in found]
    row = np.repeat(np.arange(len(found)), [len(i) for i in ids])
    ids, counts = np.concatenate(ids), np.concatenate([np.frombuffer(r.counts, np.int32) for r in found])
    r = ratio[chosen]
    value = counts * r[ids]
    del found, counts
    weight, first, second = np.zeros((3, len(chosen) + 1))
    weight[-1] = bias
    for step in range(1, ROUNDS + 1):
        margin = np.bincount(row, value * weight[ids], len(y)) + weight[-1]
        d = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(ids, value * d[row], len(chosen)) + DECAY / len(chosen) * weight[:-1], d.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weight -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return ToxicModel({int(f): float(w) for f, w in zip(chosen, weight[:-1] * r, strict=True)}, float(weight[-1]))


def score_toxicity(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, a null one as empty. Rows pass one by one, so null
    ids and repeated rows get scores like any; other columns are not read."""
    kind, name = docs.schema[doc_id].dataType.simpleString(), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.words = kept_words(name)
        for part in by_bytes(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(texts_of(part)))], ["doc_id", "score"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
