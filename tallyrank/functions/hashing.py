"""Repeatable pseudo-random columns.

Every draw is a function of the row's own key, so a retried or re-executed task
gives the same answer and no driver-side seed has to be shipped around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_digest(*parts) -> Column:
    """md5 of the key parts joined by '-'."""
    return F.md5(F.concat_ws("-", *[_col(p).cast("string") for p in parts]))


def hash_prefix(*parts, digits: int = 2) -> Column:
    """The first hex digits of the key digest, for threshold splits."""
    return F.substring(key_digest(*parts), 1, digits)


def hash_int(*parts) -> Column:
    """A BIGINT in [0, 2**32) from the key digest."""
    return F.conv(F.substring(key_digest(*parts), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """A DOUBLE in [0, 1) from the key digest."""
    return hash_int(*parts) / F.lit(float(HASH_RANGE))


def hash_fine(*parts) -> Column:
    """A DOUBLE in [0, 1) with all the bits a DOUBLE has: the first 13 hex digits of the key digest."""
    return F.conv(F.substring(key_digest(*parts), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))
