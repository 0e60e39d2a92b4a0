"""Array helpers for fixed-length sequences and dense vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pad_to(arr, length: int, fill=0, element: str = "bigint") -> Column:
    """Keep the first ``length`` elements and pad at the end with ``fill``."""
    filler = F.array_repeat(F.lit(fill).cast(element), length)
    return F.slice(F.concat(_col(arr), filler), 1, length)


def mask_of(arr, length: int) -> Column:
    """1.0 for each real position and 0.0 for each padded one."""
    real = F.least(F.size(_col(arr)), F.lit(length))
    ones = F.array_repeat(F.lit(1.0), real)
    zeros = F.array_repeat(F.lit(0.0), F.lit(length) - real)
    return F.concat(ones, zeros)


def joined(arr, sep: str = ",") -> Column:
    """The array as one string, in order."""
    return F.array_join(_col(arr).cast("array<string>"), sep)


def dot(a, b) -> Column:
    """Inner product of two numeric arrays of one length."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def multi_hot(arr, vocabulary: list[str]) -> Column:
    """0/1 flags, one per vocabulary entry, in vocabulary order."""
    words = F.array(*[F.lit(word) for word in vocabulary])
    return F.transform(words, lambda w: F.array_contains(_col(arr), w).cast("int"))


def flag_indices(flags) -> Column:
    """Positions of the non-zero flags."""
    marked = F.transform(_col(flags), lambda x, i: F.when(x != 0, i).otherwise(-1))
    return F.filter(marked, lambda i: i >= 0)


def slice_by_lengths(arr, lengths: list[int]) -> Column:
    """Cut a flat row into one sub-array per field length."""
    starts = [1 + sum(lengths[:k]) for k in range(len(lengths))]
    return F.array(*[F.slice(_col(arr), s, n) for s, n in zip(starts, lengths)])
