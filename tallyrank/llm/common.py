"""What the operators share: words, bounded slices of Arrow batches, names that clash with no column."""

from __future__ import annotations

import gc
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that ends a word, as bytes.split() has it: the words are [^\x20\x09-\x0D]+.
SPACE = " \t\n\x0b\x0c\r"
#: UTF-8 bytes of text that one step of an operator holds at a time; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def word_bytes(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def lower_word_bytes(text: str) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def by_bytes(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices of about ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        step = np.cumsum(sizes, dtype=np.int64) // limit
        starts = np.flatnonzero(np.diff(step, prepend=-1))
        for begin, end in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            yield batch.slice(int(begin), int(end - begin))


def numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, list[bytes]]:
    """All words end to end as numbers, and the words that have them, in order of appearance."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    collecting = gc.isenabled()
    gc.disable()  # nothing here makes cycles, and a growing table is large to walk
    try:
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
    finally:
        if collecting:
            gc.enable()
    return ids, list(number)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; a null text is empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def groups_for(rows: int, per_group: int) -> int:
    return max(1, math.ceil(rows / per_group))


def offsets(lengths: np.ndarray) -> np.ndarray:
    """Where each run starts, and where the last one ends."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def per_run(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the runs that ``offsets`` delimits; 0 for an empty run."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


