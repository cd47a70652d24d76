"""Anti and semi joins.

They are spelled as such: a left join with an ``is null`` test stays an outer join
in Spark, and ``not in (subquery)`` becomes a null-aware join that has to broadcast.
No side is hinted; the planner broadcasts by measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loaded_hashes(log: DataFrame, hash_col: str) -> DataFrame:
    """Hashes of the log rows known to be loaded; a NULL flag counts as not loaded."""
    return log.where(F.coalesce("loaded", F.lit(False)) & F.col(hash_col).isNotNull()).select(hash_col)


def without_loaded(records: DataFrame, log: DataFrame, hash_col: str) -> DataFrame:
    """Records whose hash the log does not know as loaded."""
    return records.join(loaded_hashes(log, hash_col), hash_col, "left_anti")


def without_keys(df: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Rows whose key is in none of the other frames; rows without a key stay."""
    return reduce(lambda left, other: left.join(other.select(key), key, "left_anti"), others, df)


def with_keys(df: DataFrame, key: str, other: DataFrame) -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def mark_loaded(log: DataFrame, hashes: DataFrame, hash_col: str) -> DataFrame:
    """The log with ``loaded`` set on every row whose hash is among ``hashes``.

    Flips earlier failed attempts of the same record too.
    """
    done = hashes.where(F.col(hash_col).isNotNull()).select(hash_col).distinct().withColumn("_done", F.lit(True))
    marked = log.join(done, hash_col, "left").withColumn("loaded", F.coalesce("_done", "loaded"))
    return marked.select(log.columns)
