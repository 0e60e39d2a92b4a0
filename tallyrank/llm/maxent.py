"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import by_bytes, crc_remainder, groups_for, lower_word_bytes, numbered, offsets, per_run, texts_of
from tallyrank.session import cut_lineage

#: Classes of words: the end, the most frequent words by themselves, and the others by their last letters.
OWN_CLASS, CLASSES = 24, 64
#: Rows of weights that features are hashed to; with CLASSES this fixes the size of the model.
ROWS = 1 << 14
FEATURES = 4
#: Passes of distributed updates; each takes an equal share of the training documents.
ROUNDS = 2
BATCH, RATE = 4096, 0.3
#: Documents whose words are looked up together.
CHUNK_DOCS = 2048
END = b""


def _scatter(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - ROWS.bit_length() + 1)


@dataclass
class Tokens:
    """Tokens of texts laid end to end, as numbers of distinct words."""

    words: list[bytes]
    ids: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Tokens:
        lists = [lower_word_bytes(t) for t in texts]
        for words in lists:
            words.append(END)
        ids, words = numbered(lists)
        return cls(words, ids, offsets(np.array([len(x) for x in lists], np.int64)))

    def classes(self, own: dict[bytes, int]) -> np.ndarray:
        """Class of each token: 0 the end, then the words in ``own``, then by the last three bytes."""
        rest = OWN_CLASS + 1
        found = [own.get(w) or (rest + zlib.crc32(w[-3:]) % (CLASSES - rest) if w else 0) for w in self.words]
        return np.array(found, np.int64)[self.ids]

    def features(self, classes: np.ndarray) -> np.ndarray:
        """Row of each token's features: the word before, the classes of the two before, and skipping one,
        the word two before and the classes of the second and third before."""
        names = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))[self.ids]
        place = np.arange(len(self.ids)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        kind = (classes + 1).astype(np.uint64)

        def back(values: np.ndarray, n: int) -> np.ndarray:
            out = np.zeros(len(values), np.uint64)
            out[n:] = values[:-n] if n < len(values) else out[n:]
            out[place < n] = 0
            return out

        one, two, three = (back(kind, n) for n in (1, 2, 3))
        shifted = np.uint64(1 << 20)
        rows = [_scatter(back(names, 1), 1), _scatter(one * shifted + two, 2), _scatter(back(names, 2), 3), _scatter(two * shifted + three, 4)]
        return np.stack(rows, 1).astype(np.int64)


def _sum_runs(x: np.ndarray, first: np.ndarray, times: np.ndarray, short: int = 8) -> np.ndarray:
    """Sums of runs of rows: short runs together, place by place, long ones each by itself."""
    out = x[first]
    few = np.flatnonzero(times <= short)
    for k in range(1, short):
        few = few[times[few] > k]
        out[few] += x[first[few] + k]
    for run in np.flatnonzero(times > short):
        np.sum(x[first[run] : first[run] + times[run]], axis=0, out=out[run])
    return out


class _Workspace:
    """Buffers for one batch, so that no step allocates."""

    def __init__(self) -> None:
        self.logits, self.spare = (np.empty((BATCH, CLASSES), np.float32) for _ in range(2))
        self.sorted = np.empty((BATCH * FEATURES, CLASSES), np.float32)
        self.ones = np.ones(CLASSES, np.float32)

    def raise_logits(self, weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Summed weights of the features, in [-60, 60], where float32 exponentials stay finite."""
        out, spare = self.logits[: len(features)], self.spare[: len(features)]
        np.take(weights, features[:, 0], axis=0, out=out, mode="clip")
        out += bias
        for k in range(1, FEATURES):
            np.take(weights, features[:, k], axis=0, out=spare, mode="clip")
            out += spare
        return np.clip(out, -60, 60, out=out)


def learn(weights: np.ndarray, bias: np.ndarray, steps: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Minibatch gradient updates with a rate that falls with a row's own squared gradients. Returns the
    weights, how often each row was seen, the bias and the tokens seen."""
    weights, bias = weights.copy(), bias.copy()
    power, bias_power, seen, total = np.full(len(weights), 1e-2, np.float32), 1e-2, np.zeros(len(weights), np.int64), 0
    space = _Workspace()
    for features, classes in steps:
        for at in range(0, len(classes), BATCH):
            f, y = features[at : at + BATCH], classes[at : at + BATCH]
            n = len(y)
            d = space.raise_logits(weights, bias, f)
            np.exp(d, out=d)
            d *= (1 / (d @ space.ones))[:, None]
            d[np.arange(n), y] -= 1
            flat = f.T.reshape(-1).astype(np.uint16)  # rows have 14 bits, and 16-bit keys are sorted by radix
            order = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.diff(flat[order], prepend=np.uint16(ROWS)))
            rows, times = flat[order[first]], np.diff(np.append(first, len(flat)))
            g = _sum_runs(np.take(d, order % n, axis=0, out=space.sorted[: len(flat)], mode="clip"), first, times)
            power[rows] += np.einsum("ij,ij->i", g, g) / CLASSES
            g *= (RATE / np.sqrt(power[rows]))[:, None]
            weights[rows] -= g
            seen[rows] += times
            g = d.sum(0)
            bias_power += float((g * g).mean())
            bias -= RATE * g / np.float32(np.sqrt(bias_power))
            total += n
    return weights, seen, bias, total


@dataclass
class MaxentModel:
    """P(token | history) = P(class | features) x P(token | class).

    The first factor is the log-linear model over hashed features. The second has the token itself as
    its only feature, whose best weights are the smoothed log counts, so it needs no training. Sizes are
    fixed by ROWS, CLASSES and OWN_CLASS. ``tokens`` and ``kinds`` are N and V of the training tokens, by class.
    """

    weights: np.ndarray
    bias: np.ndarray
    own: dict[bytes, int]
    tokens: np.ndarray
    kinds: np.ndarray

    def class_scores(self, features: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 P(class | features) of each token."""
        out, space = np.zeros(len(classes)), _Workspace()
        for at in range(0, len(classes), BATCH):
            y = classes[at : at + BATCH]
            logits = space.raise_logits(self.weights, self.bias, features[at : at + BATCH])
            chosen = logits[np.arange(len(y)), y]
            np.exp(logits, out=logits)
            out[at : at + BATCH] = (chosen - np.log(logits @ space.ones)) / np.log(10)
        return out

    def score(self, texts: list[str], counts: dict[bytes, int]) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each text; ``counts`` has the training count of
        every word in them that has one."""
        t = Tokens.of(texts)
        classes = t.classes(self.own)
        c = np.array([counts.get(w, 0) for w in t.words], np.float64)[t.ids] if len(t.words) else np.zeros(0)
        n, v = float(self.tokens.sum()), float(self.kinds.sum())
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        within = np.log10((c + 0.5) / (self.tokens[classes] + 0.5 * (self.kinds[classes] + 1)))
        within[classes <= OWN_CLASS] = 0.0
        if len(texts) == 0:
            return {k: np.zeros(0, kind) for k, kind in (("n_tokens", np.int64), ("n_known", np.int64), ("base_score", float), ("score", float))}
        score = within + self.class_scores(t.features(classes), classes)
        starts = t.bounds[:-1]  # an end stands in every text, so no run is empty
        return {
            "n_tokens": np.diff(t.bounds), "n_known": per_run(c > 0, t.bounds),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(score, starts),
        }


def _held(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.withColumn("held_out", crc_remainder(F.col("doc_id"), 5) == 1)


def word_counts(rows: DataFrame) -> DataFrame:
    """word (as bytes; empty for the end) and c over all rows. Each step adds up its own words first, so a
    frequent word is one row of a step and Spark's partial sums make it one row of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches):
            t = Tokens.of(texts_of(part))
            yield pa.RecordBatch.from_arrays([pa.array(t.words, pa.binary()), pa.array(np.bincount(t.ids, minlength=len(t.words)).astype(np.int64))], ["word", "n"])

    return rows.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


def train(rows: DataFrame, counts: DataFrame) -> MaxentModel:
    """Every task updates a copy of the weights over its documents; the copies are averaged row by row, each
    by how often it saw the row. A round takes its share of the documents, so all are used once. Copies
    are summed by Spark in slices of rows; the driver holds one model."""
    own = {bytes(r.word): k for k, r in enumerate(counts.where("length(word) > 0").orderBy(F.col("c").desc(), "word").limit(OWN_CLASS).collect(), 1)}

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, CLASSES), np.int64)
        for batch in batches:
            words = [bytes(w) for w in batch.column("word").to_pylist()]
            kinds = Tokens(words, np.arange(len(words)), np.zeros(1, np.int64)).classes(own)
            np.add.at(sums[0], kinds, batch.column("c").to_numpy())
            np.add.at(sums[1], kinds, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(sums[0]), pa.array(sums[1])], ["class", "tokens", "kinds"])

    found = counts.mapInArrow(total, "class bigint, tokens bigint, kinds bigint").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in found:
        tokens[r["class"]], kinds[r["class"]] = r.tokens, r.kinds
    weights, bias = np.zeros((ROWS, CLASSES), np.float32), np.log((tokens + 1) / (tokens.sum() + CLASSES)).astype(np.float32)
    slices = 64
    for turn in range(ROUNDS):
        share = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == turn).select("text")

        def update(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights, bias: np.ndarray = bias) -> Iterator[pa.RecordBatch]:
            def steps() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for part in by_bytes(batches):
                    t = Tokens.of(texts_of(part))
                    classes = t.classes(own)
                    yield t.features(classes), classes

            new, seen, new_bias, n = learn(weights, bias, steps())
            rows = np.append(np.flatnonzero(seen), ROWS)
            values = np.concatenate([new, new_bias[None]])[rows].astype(np.float32)
            times = np.append(seen, n)[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows % slices), pa.array(rows), pa.array([v.tobytes() for v in values], pa.binary()), pa.array(times)], ["slice", "row", "w", "seen"]
            )

        def average(frame: pd.DataFrame) -> pd.DataFrame:
            w = np.frombuffer(b"".join(frame.w), np.float32).reshape(-1, CLASSES).astype(np.float64) * frame.seen.to_numpy()[:, None]
            order = np.argsort(frame.row.to_numpy(), kind="stable")
            row = frame.row.to_numpy()[order]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            summed = np.add.reduceat(w[order], first, axis=0) / np.maximum(1, np.add.reduceat(frame.seen.to_numpy()[order], first))[:, None]
            return pd.DataFrame({"row": row[first], "w": [x.astype(np.float32).tobytes() for x in summed]})

        copies = share.mapInArrow(update, "slice bigint, row bigint, w binary, seen bigint")
        weights, bias = weights.copy(), bias.copy()
        for r in copies.groupBy("slice").applyInPandas(average, "row bigint, w binary").collect():
            if r.row < ROWS:
                weights[r.row] = np.frombuffer(r.w, np.float32)
            else:
                bias = np.frombuffer(r.w, np.float32).copy()
    return MaxentModel(weights, bias, own, tokens, kinds)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Counts and weights come from all documents whose crc32 of the id, modulo 5, is not 1. For scoring,
    documents are dealt to chunks; the distinct words of a chunk, not its tokens, are joined with the
    counts, and each chunk is scored with the counts of its own words. So the counts may grow with the
    corpus: no task and no broadcast holds them all. A null text is empty and has its end only; null
    ids count as the empty text in the crc; other columns are not read.
    """
    rows = _held(docs, doc_id, text)
    training = rows.where(~F.col("held_out"))
    counts = cut_lineage(word_counts(training))
    model = train(training, counts)
    kind = rows.schema["doc_id"].dataType.simpleString()
    n_chunks = groups_for(docs.count(), chunk_docs)
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))

    def words(key: tuple, table: pa.Table) -> pa.Table:
        found: set[bytes] = {END}
        for part in by_bytes(table.to_batches()):
            for t in texts_of(part):
                found.update(lower_word_bytes(t))
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(found), pa.int64()), "word": pa.array(list(found), pa.binary())})

    looked_up = chunked.groupBy("chunk").applyInArrow(words, "chunk bigint, word binary").join(counts, "word").select("chunk", "word", "c")
    total = int(model.tokens.sum())

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        own = dict(zip(known.column("word").to_pylist(), known.column("c").to_pylist(), strict=True))
        out = []
        for part in by_bytes(texts.combine_chunks().to_batches()):
            found = model.score(texts_of(part), own)
            fixed = pa.array(np.full(part.num_rows, total, np.int64))
            out.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(found["n_tokens"]), pa.array(found["n_known"]), fixed, pa.array(found["base_score"]), pa.array(found["score"])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.Table.from_batches(out, schema=pa.schema([
            texts.schema.field("doc_id"), texts.schema.field("held_out"), *(pa.field(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")),
            pa.field("base_score", pa.float64()), pa.field("score", pa.float64())]))

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return chunked.groupBy("chunk").cogroup(looked_up.groupBy("chunk")).applyInArrow(score, schema)
