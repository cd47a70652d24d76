"""One best row per key, places in an order, chunks and tiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: int = 1) -> DataFrame:
    """The first ``keep`` rows of each key in ``order``, which must be total.

    The planner puts a group limit in front of the shuffle, so every map task sends
    at most ``keep`` rows of a key, however many it has seen.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def lowest_per_key(df: DataFrame, keys: Sequence[str], digest: str, ties: Sequence[str], keep: int) -> DataFrame:
    """The ``keep`` rows of each key with the lowest ``digest`` (hexadecimal, evenly spread).

    For any ``keep``: rows are counted by the first four digits, so what lies wholly below
    the limit is kept as it is, and only the one part in 65,536 of a key that the limit
    falls into is sorted. ``df`` is read twice: stage it.
    """
    part = F.coalesce(F.substring(F.col(digest), 1, 4), F.lit(""))
    counts = df.groupBy(*keys, part.alias("_part")).agg(F.count("*").alias("_n"))
    below = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0))).where(F.col("_below") < keep)
    rows, parts = df.withColumn("_part", part).alias("r"), needed.alias("p")
    same = F.col("r._part") == F.col("p._part")
    for k in keys:
        same &= F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}"))
    met = rows.join(parts, same).select("r.*", "p._n", "p._below")
    rank = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(digest, *ties))
    whole = met.where(F.col("_below") + F.col("_n") <= keep)
    cut = met.where(F.col("_below") + F.col("_n") > keep).withColumn("_rank", rank)
    return whole.select(*df.columns).unionAll(cut.where(F.col("_below") + F.col("_rank") <= keep).select(*df.columns))


def chunk_of(key: Column, chunks: int) -> Column:
    """Chunk 1..chunks of a key by hash: same answer on a retried task, and no shuffle.

    A random tile over a global order would bring every row into one task.
    """
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")
    return (F.pmod(F.coalesce(number, F.lit(0)), F.lit(chunks)) + 1).cast("int")


def numbered(
    df: DataFrame, order: Sequence[Column], write: Callable[[DataFrame, str], DataFrame], name: str = "number"
) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0, as column ``name``.

    Rows are dealt by range, sorted within the parts and written once by ``write`` (a
    stage table); a row's number is its place in its part plus the rows of the parts
    before. Rows that ``order`` holds equal are spread over parts as well, so neither
    a window over all rows nor a frequent value brings them into one task. What is
    broadcast has one row per shuffle partition, whatever the data.
    """
    tie, part, at = f"_{name}_tie", f"_{name}_part", f"_{name}_at"
    keys = [*order, F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = write(dealt.drop(tie).withColumn(part, F.spark_partition_id()).withColumn(at, inside), name)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n"))
    offsets = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    met = placed.join(F.broadcast(offsets), part)
    return met.withColumn(name, F.col("_offset") + F.col(at)).drop("_offset", part, at)


def tile_of(number: Column, rows: Column | int, tiles: int) -> Column:
    """Tile 1..tiles of a row by its ``number`` from 0; the first tiles take the rows left over.

    Tiles differ by one row at most, as those of ``ntile`` do.
    """
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    small, more = F.floor(rows / tiles), F.pmod(rows, F.lit(tiles))
    large = more * (small + 1)
    within = F.when(number < large, F.floor(number / (small + 1)))
    # without a whole row per tile every row lies in a large one
    return (within.otherwise(more + F.floor((number - large) / F.greatest(small, F.lit(1)))) + 1).cast("int")


def equal_tiles(
    df: DataFrame, order: Sequence[Column], tiles: int, write: Callable[[DataFrame, str], DataFrame], name: str = "tile"
) -> DataFrame:
    """``df`` with the tile 1..tiles that ``ntile`` over ``order`` gives a row, without its one task."""
    placed = numbered(df, order, write, f"_{name}_number")
    return placed.withColumn(name, tile_of(F.col(f"_{name}_number"), placed.count(), tiles)).drop(f"_{name}_number")
