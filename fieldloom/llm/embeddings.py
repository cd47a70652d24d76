"""Near-duplicate vectors by spherical-cap filters.

Filter directions are a random product code: after a random rotation a vector is cut in
two halves, each half has its own random code words, and a direction is a pair of words.
A vector is listed under every direction whose cap it lies in, that is, whose inner
product reaches a threshold; sorting the halves' products gives the list without trying
all pairs. Vectors that share a label and a filter are compared in double precision. A
pair is counted under its smallest common filter only, so no pair is emitted or kept: a
filter hands on how many partners each vector has there, and edges to the smallest
vector it is connected with there.

Equal vectors are one class with a number of copies. Filters with more than
``block`` classes are dealt in blocks, each pair of blocks being a task's work of its own.

Parameters and recall: ``words`` code words per half give ``words ** 2`` directions, and
the threshold is set by the expected number of filters per vector, found on seeded random
vectors and so the same for all data. Vectors of few dimensions have fewer directions. Recall against brute force is measured in the
tests; pairs of equal vectors are always found. The similarity is exact: no pair below
the threshold is linked.

Defined results: rows with a null label or with a null, empty or zero vector or with null
or non-finite components have no links and are their own component; vectors are compared
only with those of equal length; repeated rows and repeated ids are vectors of their own
that count as links of each other; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, components, small_side

SEED = 5


@functools.cache
def _code(dim: int, words: int, per_vector: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rotation, code words of both halves, and the threshold on the sum of two products."""
    rng = np.random.default_rng(SEED + dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    half = max(1, dim // 2)
    codes = []
    for size in (half, max(1, dim - half)):
        # one dimension has two directions, not ``words``
        code = rng.standard_normal((words, size)) if size > 1 else np.array([[1.0], [-1.0]])
        codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
    trial = rng.standard_normal((64, max(dim, 2)))[:, :dim]
    trial = trial / np.linalg.norm(trial, axis=1, keepdims=True) @ rotation
    tops = []
    for v in trial:
        x, y = _products(v, codes[0], codes[1])
        sums = np.add.outer(x, y).ravel()
        k = min(len(sums), int(per_vector * 8))
        tops.append(np.sort(np.partition(sums, len(sums) - k)[-k:])[::-1])
    # the threshold that lists per_vector filters on average over the trial vectors
    every = np.sort(np.concatenate(tops))[::-1]
    threshold = float(every[min(len(every) - 1, int(per_vector * len(trial)))])
    return rotation, codes[0], codes[1], threshold


def _products(v: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = first.shape[1]
    tail = v[half:] if len(v) > half else np.zeros(second.shape[1])
    return first @ v[:half], second @ tail


def filters_of(vector: np.ndarray, words: int, per_vector: float) -> np.ndarray:
    """The filters a unit vector is listed under, in order; at least its best one."""
    rotation, first, second, threshold = _code(len(vector), words, per_vector)
    x, y = _products(vector @ rotation, first, second)
    i = np.flatnonzero(x >= threshold - y.max())
    j = np.flatnonzero(y >= threshold - x.max())
    a, b = np.nonzero(np.add.outer(x[i], y[j]) >= threshold)
    if not len(a):
        return np.array([int(x.argmax()) * len(second) + int(y.argmax())])
    return np.sort(i[a] * len(second) + j[b])


def _links(v: np.ndarray, weights: np.ndarray, lists: list[list[int]], own: int, first: int, threshold: float):
    """Links counted under filter ``own``: partners of each row, and a smaller connected row.

    Rows before ``first`` are one block, the others another, and only pairs across count;
    with ``first`` = 0 all pairs do.
    """
    norms = np.sqrt((v * v).sum(axis=1))
    linked = (v @ v.T) / np.outer(norms, norms) >= threshold
    np.fill_diagonal(linked, False)
    if first:
        linked[:first, :first] = False
        linked[first:, first:] = False
    if linked.any():
        smaller = sorted({f for fs in lists for f in fs if f < own})
        if smaller:
            place = {f: k for k, f in enumerate(smaller)}
            listed = np.zeros((len(v), len(smaller)), np.float32)
            for r, fs in enumerate(lists):
                for f in fs:
                    if f < own:
                        listed[r, place[f]] = 1
            linked &= listed @ listed.T == 0
    counts = linked @ weights
    root = np.arange(len(v))
    while linked.any():
        low = np.minimum(root, np.where(linked, root[None, :], len(v)).min(axis=1))
        if (low == root).all():
            break
        root = low
    return counts, root


def _compare(threshold: float, block: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:4] != row[:4]:
                    out += _bucket(held, threshold)
                    held = []
                held.append(row)
            if len(out) > 50_000:
                yield _pack(out)
                out = []
        if held:
            out += _bucket(held, threshold)
        yield _pack(out)

    return over


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["class", "links", "low"])


def _bucket(rows: list[tuple], threshold: float) -> list[tuple]:
    """Rows of one filter (or of one pair of its blocks), in order of class within a block."""
    if len(rows) < 2:
        return []
    own, left, right = rows[0][1:4]
    first = sum(r[4] == left for r in rows) if left != right else 0
    if left != right and first in (0, len(rows)):
        return []
    v = np.array([r[7] for r in rows], dtype=np.float64)
    counts, root = _links(v, np.array([r[6] for r in rows], dtype=np.float64), [r[8] for r in rows], own, first, threshold)
    out = []
    for r, n, k in zip(rows, counts, root):
        if n:
            out.append((r[5], int(n), rows[k][5]))
    return out


def near_duplicates(
    vectors: DataFrame,
    stage: Stage,
    threshold: float = 0.93,
    words: int = 768,
    per_vector: float = 48,
    block: int = 1024,
    partitions: int | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    rows = stage.numbered(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").alias("label"),
            F.col("embedding").cast("array<double>").alias("v"),
        ),
        "vectors",
    )
    sound = (
        F.col("label").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    usable = rows.where(F.coalesce(sound, F.lit(False)))
    classes = stage.numbered(
        usable.groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least")), "classes"
    ).withColumnRenamed("_row", "class")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(3).to_pylist():
                unit = np.array(v, dtype=np.float64)
                found.append(filters_of(unit / np.sqrt((unit * unit).sum()), words, per_vector).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(found, pa.list_(pa.int64()))], ["class", "copies", "label", "v", "filters"]
            )

    label = classes.schema["label"].dataType.simpleString()
    lists = classes.select("class", "copies", "label", "v").mapInArrow(
        listed, f"class long, copies long, label {label}, v array<double>, filters array<long>"
    )
    listed_rows = stage.table(lists.withColumn("kind", F.struct("label", F.size("v").alias("size"))).drop("label"), "lists")
    spread = listed_rows.select("class", "kind", F.explode("filters").alias("filter"))
    sizes = spread.groupBy("kind", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = stage.table(sizes.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "sizes")
    # rows of filters with company, each with the blocks its filter is dealt in
    meets = spread.join(blocks, ["kind", "filter"])
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    met = meets.withColumn("own", own).select(
        "class",
        "kind",
        "filter",
        "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    partitions = partitions or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = (
        met.join(listed_rows.select("class", "copies", "v", "filters"), "class")
        .select(
            F.xxhash64("kind").alias("kind"),
            "filter",
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            "own",
            "class",
            "copies",
            "v",
            "filters",
        )
        .repartition(partitions, "kind", "filter", "left", "right")
        .sortWithinPartitions("kind", "filter", "left", "right", "own", "class")
    )
    links = stage.table(work.mapInArrow(_compare(threshold, block), "class long, links long, low long"), "links")
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(links.where("class <> low").select(F.col("class").alias("a"), F.col("low").alias("b")), stage)
    by_class = (
        classes.select("class", "label", "v", "copies", "least")
        .join(counts, "class", "left")
        .join(joined.withColumnRenamed("id", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    lowest = by_class.groupBy("component").agg(F.min("least").alias("lowest"))
    final = stage.table(
        by_class.join(lowest, "component").select(
            "label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "lowest"
        ),
        "final",
    )
    return rows.join(final, ["label", "v"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("lowest", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("lowest", "vec_id")).alias("kept"),
    )
