"""Helpers that the corpus operators share: words, staging, checked broadcasts, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.session import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a run of characters outside these; A-Z are lowered first, nothing else is.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_is_word = [48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)]
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if _is_word[b] else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, as ``NOT_WORD`` parts them."""
    return text.translate(_TABLE).split() if text else []


def flat_words(text: Column) -> Column:
    """The words of a text joined by single spaces, as a column expression."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.trim(F.regexp_replace(lowered, NOT_WORD, " "))


def count_words(flat: Column) -> Column:
    spaces = F.length(flat) - F.length(F.translate(flat, " ", ""))
    return F.when(flat == "", F.lit(0)).otherwise(spaces + 1).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stage:
    """Tables of one run, written below the shared folder of the session.

    What is read more than once is written once: a lost executor then costs a task, and
    lineage starts at the files. ``drop`` removes them when the results are written.
    """

    def __init__(self, spark: SparkSession, run: str):
        self.spark = spark
        self.path = new_path(spark, run)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def numbered(self, df: DataFrame, name: str) -> DataFrame:
        """As ``table``, with a row number ``_row`` that all later reads agree on."""
        return self.table(df.withColumn("_row", F.monotonically_increasing_id()), name)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcasting if it was counted to hold at most ``max_rows`` rows.

    Beyond that the frame is returned as it is and the join shuffles both sides.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def components(edges: DataFrame, stage: Stage, max_rounds: int = 60) -> DataFrame:
    """``id, component`` for every node of ``edges`` (a, b): the smallest id it reaches.

    Alternates large and small stars: each round every node hands its smallest neighbour
    to the others, until each component is a star around its smallest node. Minima are
    aggregated before the shuffle and joined back, so a node with very many neighbours
    is never gathered in one task. Each round is written to the shared folder.
    """
    star = stage.table(_both(edges, "a", "b"), "round0")
    seen = None
    for k in range(1, max_rounds + 1):
        # large star: larger neighbours of a node move to its smallest neighbour
        lowest = star.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = star.join(lowest, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours move to the smallest of them
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tree = stage.table(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"tree{k}")
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return tree.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                tree.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        seen = now
        star = tree.select(F.col("u").alias("a"), F.col("v").alias("b")).union(
            tree.select(F.col("v").alias("a"), F.col("u").alias("b"))
        )
    raise RuntimeError("components did not settle")


def _both(edges: DataFrame, a: str, b: str) -> DataFrame:
    one = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b"))
    return one.union(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
