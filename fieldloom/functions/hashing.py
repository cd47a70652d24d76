"""Record hashes. The parts are joined without separators on purpose: hashes
already stored in delivery logs were made that way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "missing"  # fixed value


def hash_strict(*columns: Column) -> Column:
    """md5 of the parts as text; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*[c.cast("string") for c in columns]))


def all_present(*columns: Column) -> Column:
    """True where ``hash_strict`` of the parts is not NULL.

    A filter on the parts can go down to the scan and does not compute the hash.
    """
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def hash_coalesced(*columns: Column) -> Column:
    """md5 of the parts as text, a NULL part counting as ``missing``."""
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit(MISSING)) for c in columns]))
