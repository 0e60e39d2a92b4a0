"""Quality classifier: attention over the passages of a document (multiple-instance learning)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import by_bytes, crc_remainder, numbered, offsets, per_run, texts_of, word_bytes

#: Words of a passage.
PASSAGE_WORDS = 64
#: Labelled rows the model is fitted on at most: those with the smallest hash of their id. ...
SAMPLE_ROWS = 6000
#: ... and the passages a row may have to be used in fitting; scoring has no such bound.
SAMPLE_PASSAGES = 512
ROUNDS, RATE, DECAY = 300, 0.03, 1e-4
ENCODED, GATED = 16, 8

_CLASSES = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "beyond": range(128, 256),
            "stop": b".?", "loud": b"!", "comma": b",;:", "mark": b"#*$%&|<>", "slash": b"/\\=_~^+@", "bracket": b"()[]{}\"'`"}
CODES = np.zeros(256, np.uint8)
for _code, _bytes in enumerate(_CLASSES.values(), 1):
    CODES[list(_bytes)] = _code
N_FEATURES = len(_CLASSES) + 11


def passage_features(texts: list[str], size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage of ``size`` words, and where each text's passages start and end.

    A text without words has one passage of zeros. A feature is a share or mean, so it does not
    depend on a passage's length; what repeats is seen within the whole text.
    """
    lists = [word_bytes(t) for t in texts]
    counts = np.array([len(x) for x in lists], np.int64)
    passages = np.maximum(1, -(-counts // size))
    bounds = offsets(passages)
    found = np.zeros((int(bounds[-1]), N_FEATURES), np.float32)
    words = list(chain.from_iterable(lists))
    if not words:
        return found, bounds
    text_of = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(words)) - np.repeat(offsets(counts)[:-1], counts)
    passage = bounds[text_of] + place // size
    runs = offsets(np.bincount(passage, minlength=len(found)))
    n = np.maximum(1, np.diff(runs))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = CODES[np.frombuffer(b"".join(words), np.uint8)]
    edges = offsets(lengths)
    per_word = np.stack([per_run(codes == c, edges) for c in range(1, len(_CLASSES) + 1)], 1)
    letters = np.zeros((len(found), len(_CLASSES)))
    for c in range(len(_CLASSES)):
        letters[:, c] = per_run(per_word[:, c], runs)
    bytes_in = np.maximum(1, per_run(lengths, runs))
    ids, distinct = numbered(lists)
    _, first = np.unique(passage * len(distinct) + ids, return_index=True)
    fresh_word = np.zeros(len(words), bool)
    fresh_word[first] = True
    # A word's shingle is new if the same three words did not stand earlier in the text.
    after = np.minimum(np.arange(len(words))[:, None] + [0, 1, 2], len(words) - 1)
    mixed = (ids[after] * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64).view(np.int64)).sum(1) + text_of * 0x27D4EB2F165667C5
    _, first = np.unique(mixed, return_index=True)
    seen = np.ones(len(words), bool)
    seen[first] = False
    same = np.zeros(len(words), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (text_of[1:] == text_of[:-1])
    upper, lower, letters_all = per_word[:, 1], per_word[:, 0], per_word[:, [0, 1, 3]].sum(1)
    shares = [
        per_run(fresh_word, runs) / n, per_run(seen, runs) / n, per_run(same, runs) / n, per_run(lengths, runs) / n / 8,
        per_run(np.minimum(lengths, 40) ** 2, runs) / n / 100, per_run(lengths <= 2, runs) / n, per_run(lengths > 14, runs) / n,
        per_run((upper >= 2) & (lower == 0), runs) / n, per_run(letters_all == 0, runs) / n,
        per_run(per_word[:, [5, 7, 8]].sum(1) > 0, runs) / n, np.minimum(n, size) / size,
    ]
    found[:, : len(_CLASSES)] = letters / bytes_in[:, None]
    found[:, len(_CLASSES) :] = np.stack(shares, 1)
    found[np.diff(runs) == 0] = 0
    return found, bounds


@dataclass
class AttentionModel:
    """Encoder, gated attention and output weights; ``weights`` maps names to arrays."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh((x - self.mean) / self.scale @ w["encode"] + w["shift"])
        t, s = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * s) @ w["attend"]
        starts, sizes = bounds[:-1], np.diff(bounds)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        logit = z @ w["out"] + w["bias"]
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def score(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.forward(x, bounds)["p"].astype(np.float64) if len(bounds) > 1 else np.zeros(0)


def fit(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> AttentionModel:
    """Adam on the cross-entropy of document labels; the gradient flows through the attention."""
    rng = np.random.default_rng(8)
    # A feature that hardly varies in the sample stays small when it does elsewhere.
    mean, scale = (x.mean(0), x.std(0) + 0.02) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    share = (y.sum() + 1) / (len(y) + 2)
    weights = {
        "encode": rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, ENCODED)), "shift": np.zeros(ENCODED),
        "tanh": rng.normal(0, 0.3, (ENCODED, GATED)), "gate": rng.normal(0, 0.3, (ENCODED, GATED)),
        "attend": rng.normal(0, 0.3, GATED), "out": np.zeros(ENCODED), "bias": np.array(np.log(share / (1 - share))),
    }
    model = AttentionModel(mean, scale, weights)
    if len(set(y.tolist())) < 2:
        return model
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    sizes, standard = np.diff(bounds), (x - mean) / scale
    for step in range(1, rounds + 1):
        f = model.forward(x, bounds)
        h, t, s, a = f["h"], f["t"], f["s"], f["a"]
        d_logit = (f["p"] - y) / len(y)
        d_z = np.repeat(d_logit, sizes)[:, None] * weights["out"]
        d_a = (h * d_z).sum(1)
        d_e = a * (d_a - np.repeat(np.add.reduceat(a * d_a, bounds[:-1]), sizes))
        d_gated = d_e[:, None] * weights["attend"]
        d_t, d_s = d_gated * s * (1 - t * t), d_gated * t * s * (1 - s)
        d_h = (a[:, None] * d_z + d_t @ weights["tanh"].T + d_s @ weights["gate"].T) * (1 - h * h)
        gradient = {
            "encode": standard.T @ d_h, "shift": d_h.sum(0), "tanh": h.T @ d_t, "gate": h.T @ d_s,
            "attend": (t * s).T @ d_e, "out": f["z"].T @ d_logit, "bias": d_logit.sum(),
        }
        for k, g in gradient.items():
            g = g + DECAY * weights[k] * (k not in ("shift", "bias"))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def spaced(n: int, most: int) -> np.ndarray:
    """At most ``most`` places of ``n``, evenly spaced."""
    return np.arange(n) if n <= most else np.arange(most) * n // most


def train_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, sample_passages: int = SAMPLE_PASSAGES,
) -> AttentionModel:
    """Fits on at most ``sample_rows`` labelled documents whose crc32 of the id, modulo 3, is not 1.

    The sample is taken by a hash of the id, so its size bounds what is broadcast, and the features of
    at most ``sample_passages`` passages of each, evenly spaced in longer texts, what reaches the driver. Rows that
    share an id give one example for each label, that of the least features. Null labels are left out; without
    labels of both classes, as in empty tables, every text gets the same score.
    """
    own, mark = labels["doc_id"], labels[label]
    chosen = (
        labels.select(own.alias("doc_id"), mark.cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (crc_remainder(F.col("doc_id"), 3) != 1))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)
    )
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches):
            x, bounds = passage_features(texts_of(part))
            flat = [x[a + spaced(z - a, sample_passages)].tobytes() for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.string()), part.column("y"), pa.array(flat, pa.binary())], ["doc_id", "y", "x"])

    found = rows.mapInArrow(run, "doc_id string, y int, x binary").groupBy("doc_id", "y").agg(F.min("x").alias("x")).collect()
    found.sort(key=lambda r: (r.doc_id, r.y, r.x))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in found]
    x = np.concatenate(bags) if bags else np.zeros((0, N_FEATURES), np.float32)
    return fit(x.astype(np.float64), offsets(np.array([len(b) for b in bags], np.int64)), np.array([r.y for r in found], np.float64))


def score_quality(docs: DataFrame, model: AttentionModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, a null one as empty. Rows pass one by one, so null
    ids and repeated rows get scores like any; other columns are not read."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(*passage_features(texts_of(part))))], ["doc_id", "score"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def keep_quality(docs: DataFrame, model: AttentionModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows with a score of ``least`` or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, text):
            yield part.filter(pa.array(model.score(*passage_features(texts_of(part, text))) >= least))

    return docs.mapInArrow(run, docs.schema)
