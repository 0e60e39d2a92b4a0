"""Vector bin packing of training examples by the dot-product heuristic."""

from __future__ import annotations

import base64
import gc
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import by_bytes, groups_for, texts_of

SEQUENCE_TOKENS = 1024
#: Limits of one sequence: tokens, segments, loss-bearing tokens.
LIMITS = (SEQUENCE_TOKENS, 512, SEQUENCE_TOKENS)
#: Documents whose pieces are packed together in one task.
GROUP_DOCS = 8192
#: Distinct units a worker remembers the ids of.
CACHE_UNITS = 400_000
SEPARATOR_ID = 0


def dot_product_bins(vectors: np.ndarray, limits: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and its place there.

    A bin is filled until nothing fits: each time with the item that fits and has the greatest
    weighted dot product with what the bin has left, where a dimension weighs as much as all items
    ask of it. Equal items are one type, so a step looks at types. An item over a limit gets a bin
    of its own.
    """
    n = len(vectors)
    bins, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n == 0:
        return bins, place
    cap = np.asarray(limits, np.int64)
    kinds, kind_of, counts = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    kind_of = kind_of.reshape(-1)
    items = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(counts)[:-1])
    share = kinds / cap
    weight = share * (share * counts[:, None]).sum(0)
    left, current = counts.copy(), 0
    for k in np.flatnonzero((kinds > cap).any(1)):
        bins[items[k]] = current + np.arange(counts[k])
        current, left[k] = current + counts[k], 0
    alive = np.flatnonzero(left)
    while len(alive):
        room, chosen, spare = cap.copy(), [], left[alive].copy()
        own, value = kinds[alive], weight[alive]
        while True:
            fits = np.flatnonzero((own <= room).all(1) & (spare > 0))
            if len(fits) == 0:
                break
            k = fits[np.argmax(value[fits] @ (room / cap))]
            spare[k] -= 1
            room -= own[k]
            chosen.append(k)
        # What is chosen depends on the room and on which types are left, so while all types of this
        # bin last the next bins are filled alike.
        used, often = np.unique(chosen, return_counts=True)
        alike = int((left[alive[used]] // often).min())
        for at, k in enumerate(chosen):
            kind = alive[k]
            taken = items[kind][left[kind] - alike : left[kind]]
            left[kind] -= alike
            bins[taken], place[taken] = current + np.arange(alike), at
        current += alike
        alive = alive[left[alive] > 0]
    return bins, place


def pack_examples(
    examples: DataFrame, tokens: str = "tokens", loss_tokens: str = "loss_tokens", limits: tuple[int, int, int] = LIMITS,
    group_rows: int = GROUP_DOCS,
) -> DataFrame:
    """``examples`` with sequence_id, offset and oversize: each example lies in one sequence, and no
    sequence exceeds the limits on tokens, examples and loss-bearing tokens.

    Rows are dealt to groups of about ``group_rows`` by a hash of their place, so a group never
    grows with the input and no key gathers rows. Null or negative counts are 0; an example that
    exceeds a limit by itself is alone in its sequence and marked oversize; empty tables give empty
    results. Columns of the input that are named like a result column are replaced.
    """
    added = {"sequence_id", "offset", "oversize"}
    base = examples.drop(*[c for c in examples.columns if c.lower() in added])
    n_groups = groups_for(base.count(), group_rows)
    rows = base.withColumn("sequence_id", F.monotonically_increasing_id())
    return _packed(rows, F.col(tokens), F.col(loss_tokens), limits, n_groups)


def _packed(rows: DataFrame, tokens, loss, limits: tuple[int, int, int], n_groups: int) -> DataFrame:
    """Packs rows whose sequence_id is a number of their own. A sequence takes the least number of
    its members, so sequences of different groups never share one."""
    clean = lambda c: F.greatest(F.coalesce(c.cast("bigint"), F.lit(0)), F.lit(0))
    rows = rows.withColumns({
        "offset": clean(tokens), "oversize": F.lit(False), "_loss": clean(loss),
        "_group": F.pmod(F.xxhash64("sequence_id"), F.lit(n_groups)),
    })

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        size, own = frame["offset"].to_numpy(np.int64), frame["sequence_id"].to_numpy(np.int64)
        vectors = np.stack([size, np.ones_like(size), frame["_loss"].to_numpy(np.int64)], 1)
        by_own = np.argsort(own)  # the same packing whatever the order of arrival
        bins, place = np.empty_like(own), np.empty_like(own)
        bins[by_own], place[by_own] = dot_product_bins(vectors[by_own], limits)
        order = np.lexsort((place, bins))
        starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
        before = np.cumsum(size[order]) - size[order]
        runs = np.diff(np.append(starts, len(order)))
        offset, sequence = np.empty_like(own), np.empty_like(own)
        if len(order):
            offset[order] = before - np.repeat(before[starts], runs)
            sequence[order] = np.repeat(np.minimum.reduceat(own[order], starts), runs)
        out = frame.assign(sequence_id=sequence, offset=offset, oversize=(vectors > np.asarray(limits)).any(1))
        return out.drop(columns=["_loss", "_group"])

    kept = rows.drop("_loss", "_group")
    return rows.groupBy("_group").applyInPandas(run, kept.schema)


class _Units:
    """Ids of texts. A text is cut before every single space that a character other than white
    space follows; the tokenizer cuts there too, so a unit has the same ids wherever it stands."""

    CUT = re.compile(r" (?=\S)")

    def __init__(self, ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokenizer = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ids: dict[str, bytes] = {}
        self.added = {token: array("I", [number]).tobytes() for token, number in added}
        # Of added tokens that start at one place the longest counts.
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Native 32-bit ids of each text (little-endian where Spark runs). What stands between added
        tokens is encoded by itself."""
        if self.split is None:
            return self._ordinary(texts)
        parts = [self.split.split(t) for t in texts]  # ordinary text at even places, added tokens at odd ones
        encoded = iter(self._ordinary([x for p in parts for x in p[::2]]))
        return [b"".join(self.added[x] if k % 2 else next(encoded) for k, x in enumerate(p)) for p in parts]

    def _ordinary(self, texts: list[str]) -> list[bytes]:
        units = [self.CUT.split(t) for t in texts]
        ids, encode = self.ids, self.tokenizer.encode_ordinary
        if len(ids) > CACHE_UNITS:
            ids.clear()
        gc.disable()  # nothing here makes cycles, and the table is large to walk
        try:
            for unit in set().union(*(u[1:] for u in units)) - ids.keys():
                ids[unit] = array("I", encode(" " + unit)).tobytes()
        finally:
            gc.enable()
        get = ids.__getitem__
        return [array("I", encode(u[0])).tobytes() + b"".join(map(get, u[1:])) for u in units]


@lru_cache(maxsize=1)
def _units(ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...]) -> _Units:
    """The tokenizer of this worker process, with the units it remembers from earlier tasks."""
    return _Units(ranks_path, pattern, added)


def added_tokens(tokenizer_path: str) -> tuple[tuple[str, int], ...]:
    """The added tokens of a tokenizer file and their ids. They are matched as they stand, wherever they stand."""
    with open(tokenizer_path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    odd = [x["content"] for x in found if x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"]]
    if odd:
        raise ValueError(f"added tokens that match by more than their text: {odd}")
    return tuple((x["content"], x["id"]) for x in found)


def cut_documents(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE_TOKENS,
    added: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Pieces of at most ``size`` ids of every document's ids and a closing 0: doc_id, start, length,
    ids_crc32, doc_tokens. The ids are those of the byte-level vocabulary in the rank file; ``pattern``
    splits a text before its merges, and ``added`` are tokens with an id of their own wherever they
    stand. A null text is empty and so one closing id."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(ranks_path, pattern, added)
        for part in by_bytes(batches):
            rows, start, length, crc, total = [], [], [], [], []
            for row, ids in enumerate(units.encode(texts_of(part))):
                view = memoryview(ids + SEPARATOR_ID.to_bytes(4, "little"))
                n = len(view) // 4
                for begin in range(0, n, size):
                    piece = view[4 * begin : 4 * (begin + size)]
                    rows.append(row)
                    start.append(begin)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_documents(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", limits: tuple[int, int, int] = LIMITS,
    group_docs: int = GROUP_DOCS, added: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Documents as training sequences: tokenised, cut at the token limit, the pieces packed.

    Every id but a document's first bears loss. Only piece numbers are shuffled, never texts or
    ids. Documents are independent of one another: null ids and repeated rows are packed like any
    others, an empty table gives no pieces.
    """
    pieces = cut_documents(docs, ranks_path, pattern, doc_id, text, limits[0], added)
    n_groups = groups_for(docs.count(), group_docs)
    rows = pieces.withColumn("sequence_id", F.monotonically_increasing_id())
    loss = F.col("length") - (F.col("start") == 0).cast("bigint")
    return _packed(rows, F.col("length"), loss, limits, n_groups).drop("oversize")
