"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its five-word shingles. The weight is the term frequency times
``1 + IDF_SHARE * idf``, where idf is between 0 (in every document) and 1 (in one): rare
shingles count more, but not so much more that a passage that a large group of copies
shares would weigh next to nothing beside each copy's own edits. Document frequencies are
counted over all documents in a table of fixed size by hash, less the mean load of its
cells.

Improved consistent weighted sampling gives each document ``ROWS * BANDS`` samples; two
documents agree on a sample with a chance equal to their weighted Jaccard similarity.
Documents that agree on all samples of a band are candidates, and a link is a candidate
pair whose exact weighted Jaccard similarity is ``similarity`` or more.

Texts with the same words are one class with a number of copies. A bucket of candidates is
dealt in blocks of bounded size, each pair of blocks being work of its own. Of a block
only the classes go on that have a partner there whose samples promise a similarity near
the threshold; the common weights of all those are found at once, as a product of the
matrix of their shingles with itself, and the block hands on edges that join what is
similar, at most one per class. No pair is emitted, so a group of copies of any size
stays linear in what is written. Buckets with the same members are worked through once.

Three rounds find the links. In the first two each class is compared within one block of its
largest bucket, with another block the second time, so their work grows with the number of
classes; they join nearly all that a large group of near copies has. The third is exact: in
every bucket with several components left, all pairs of blocks are compared but those
within the largest component. A group of copies of any size, once joined, costs no more
than its members times the blocks of what else shares its buckets.

Defined results: null and empty texts have no words and are copies of each other; texts
of fewer than five words are one shingle; repeated rows are copies of each other, and of
rows with the smallest id of a component the first one is kept; a null id comes before all
others only where its component has no other; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, components, small_side, words_of
from fieldloom.llm.shingling import WordNumbers, mix, occurrences, shingles

SHINGLE = 5
ROWS, BANDS = 3, 12
SAMPLES = ROWS * BANDS
CELLS = 1 << 17
IDF_SHARE = 0.1
_SEED = 11
#: Share of samples that agree, below which a pair is not near the threshold: 0.8 less 3.3 deviations.
PROMISE = 0.58


def weigh(words: list[bytes], numbers: WordNumbers) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and how often each stands there."""
    return np.unique(_hashes(words, numbers), return_counts=True)


def _hashes(words: list[bytes], numbers: WordNumbers) -> np.ndarray:
    found = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    return shingles(found, min(SHINGLE, len(words)) or 1)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(47)).astype(np.int64)


@functools.cache
def _tables() -> tuple[np.ndarray, ...]:
    """Draws r of Gamma(2, 1) and 1 / r, logs of such draws, a uniform grid, seeds of samples.

    A 32-bit hash picks one of each: 11 bits for r, 12 for c and 9 for beta.
    """
    rng = np.random.default_rng(_SEED)
    r = rng.gamma(2, 1, 1 << 11).astype(np.float32)
    return (
        r,
        1 / r,
        np.log(rng.gamma(2, 1, 1 << 12)).astype(np.float32),
        ((np.arange(1 << 9) + 0.5) / (1 << 9)).astype(np.float32),
        rng.integers(1, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1),
    )


def sample(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: a 32-bit number for each sample."""
    gamma, inverse, log_gamma, uniform, seeds = _tables()
    logs = np.log(weights).astype(np.float32)[None, :]
    x = (hashes >> np.uint64(32)).astype(np.uint32)[None, :] * seeds[:, None]
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    pick = (x & np.uint32(0x7FF)).astype(np.intp)
    beta = uniform.take(x >> np.uint32(23))
    t = inverse.take(pick)
    t *= logs
    t += beta
    np.floor(t, out=t)
    value = t - beta
    value += 1
    value *= gamma.take(pick)
    np.subtract(log_gamma.take((x >> np.uint32(11)) & np.uint32(0xFFF)), value, out=value)
    best = value.argmin(axis=1)
    level = t[np.arange(SAMPLES), best].astype(np.int64).astype(np.uint64)
    return (mix(hashes[best] + level * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)


def bands_of(samples: np.ndarray) -> np.ndarray:
    """One 64-bit number for the samples of each band."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + samples[k::ROWS].astype(np.uint64))
    return h.view(np.int64)


def weighted_set(text: bytes, numbers: WordNumbers, by_cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text, each repetition as an element of its own, and their weights."""
    hashes = _hashes(words_of(text), numbers)
    return occurrences(hashes), by_cell[_cell(hashes)].astype(np.float64)


def similarities(sets: list[tuple[np.ndarray, np.ndarray]], columns: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarities of all pairs of a block of weighted sets."""
    n = len(sets)
    total = np.array([w.sum() for _, w in sets])
    owner = np.repeat(np.arange(n), [len(h) for h, _ in sets])
    element, place, count = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.empty(len(element))
    weight[place] = np.concatenate([w for _, w in sets])
    shared = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[shared]]
    owner, weight = owner[shared], weight[count > 1]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n))
    for low in range(0, len(weight), columns):
        a, b = np.searchsorted(column, [low, low + columns])
        held = np.zeros((n, min(columns, len(weight) - low)))
        held[owner[a:b], column[a:b] - low] = 1
        common += (held * weight[low : low + columns]) @ held.T
    joint = total[:, None] + total[None, :] - common
    return np.where(joint > 0, common / np.where(joint > 0, joint, 1), 1.0)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of this task by cell of the table of document frequencies."""
    numbers, cells, docs = WordNumbers(), np.zeros(CELLS + 1, np.int64), 0
    last = np.zeros(CELLS, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            own = _cell(_hashes(words_of(text), numbers))
            places = np.arange(len(own))
            last[own] = places  # a cell keeps its last place, so each counts once
            cells[own[last[own] == places]] += 1
            docs += 1
    cells[CELLS] = docs
    full = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(cells[full])], ["cell", "n"])


def shingle_weights(docs: DataFrame) -> np.ndarray:
    """Weight of a shingle by cell, from the document frequencies of all ``docs``.

    What reaches the driver is the table itself: ``CELLS`` numbers, however many documents.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(_count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(CELLS + 1, np.float64)
    for cell, n in counted:
        cells[cell] = n
    n, cells = max(2.0, cells[CELLS]), cells[:CELLS]
    frequency = np.clip(cells - (cells.sum() - cells) / (CELLS - 1), 1, n)
    return (1 + IDF_SHARE * np.log(n / frequency) / np.log(n)).astype(np.float32)


def _sampled(weights):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, by_cell = WordNumbers(), weights.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                packed, digests, samples, bands = [], [], [], []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    # the words are all that is compared, and pack better than the text
                    flat = b" ".join(words)
                    packed.append(zlib.compress(flat, 6))
                    digests.append(md5(flat).digest())
                    hashes, counts = weigh(words, numbers)
                    if len(hashes):
                        found = sample(hashes, counts * by_cell[_cell(hashes)])
                        samples.append(found.astype(np.uint32).view(np.int32))
                        bands.append(bands_of(found))
                    else:
                        samples.append([])
                        bands.append([])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(packed, pa.binary()),
                        pa.array(digests, pa.binary()),
                        pa.array(samples, pa.list_(pa.int32())),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text", "digest", "samples", "bands"],
                )

    return over


def _by_block(work):
    """Call ``work`` for the rows of each block, which come together, and pass on its pairs."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64()) for k in range(len(work.names))], work.names
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    out += work(held)
                    held = []
                held.append(row)
            if len(out) > 50_000:
                yield packed()
                out = []
        if held:
            out += work(held)
        yield packed()

    return over


def _across(rows: list[tuple]) -> np.ndarray:
    """Which pairs of a block's rows are to be compared: of different components, and of
    different halves where the block pairs two. Rows start with bucket, left, right, own,
    class, component."""
    component = np.array([r[5] for r in rows])
    wanted = component[:, None] != component[None, :]
    if rows[0][1] != rows[0][2]:
        own = np.array([r[3] for r in rows])
        wanted &= own[:, None] != own[None, :]
    return wanted


class _Promising:
    """Rows of a block with a partner whose samples agree often enough."""

    names = ["bucket", "left", "right", "own", "class", "component"]

    def __call__(self, rows: list[tuple]) -> list[tuple]:
        wanted = _across(rows)
        samples = np.array([r[6] for r in rows])
        agree = np.zeros(len(rows), bool)
        for k in range(len(rows)):
            near = wanted[k] & ((samples == samples[k]).mean(axis=1) >= PROMISE)
            agree[k] = near.any()
        return [r[:6] for r, ok in zip(rows, agree) if ok]


class _Similar:
    """Edges that join the similar rows of a block to the smallest class they reach there."""

    names = ["a", "b"]

    def __init__(self, weights, similarity: float):
        self.weights, self.similarity, self.numbers = weights, similarity, None

    def __call__(self, rows: list[tuple]) -> list[tuple]:
        if self.numbers is None:
            self.numbers = WordNumbers()
        sets = [weighted_set(zlib.decompress(r[6]), self.numbers, self.weights.value) for r in rows]
        linked = _across(rows) & (similarities(sets) >= self.similarity - 1e-9)
        root = np.arange(len(rows))
        while linked.any():
            low = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(axis=1))
            if (low == root).all():
                break
            root = low
        return [(rows[r][4], rows[k][4]) for k, r in enumerate(root) if r != k]


def _marks() -> list[Column]:
    """Two numbers that the members of a bucket give, whatever their order."""
    return [F.bit_xor(F.xxhash64("class", F.lit(k))).alias(c) for k, c in enumerate("xy")]


def _within(members: DataFrame, block: int, salt: int, least: int) -> DataFrame:
    """Members of buckets of ``least`` rows or more, each in one block of its bucket, by a hash."""
    facts = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), *_marks()
    )
    chosen = _once(facts.where((F.col("n") >= least) & (F.col("low") != F.col("high"))))
    blocks = F.ceil(F.col("n") / block).cast("long")
    dealt = members.join(chosen.select("bucket", blocks.alias("blocks")), "bucket")
    own = F.pmod(F.xxhash64("class", F.lit(salt)), F.col("blocks"))
    return dealt.select("bucket", own.alias("left"), own.alias("right"), own.alias("own"), "class", "component")


def _across_all(members: DataFrame, block: int) -> DataFrame:
    """Members of buckets with several components, in pairs of blocks.

    If the largest component of a bucket fills more than a block, it has blocks of its own,
    which are paired with those of the other members only.
    """
    parts = members.groupBy("bucket", "component").agg(F.count("*").alias("n"), *_marks())
    facts = parts.groupBy("bucket").agg(
        F.sum("n").alias("n"),
        F.max(F.struct("n", "component")).alias("main"),
        F.count("*").alias("kinds"),
        F.bit_xor("x").alias("x"),
        F.bit_xor("y").alias("y"),
    )
    chosen = _once(facts.where("kinds > 1"))
    in_main = F.when(F.col("main.n") > block, F.col("main.n")).otherwise(0)
    chosen = chosen.select(
        "bucket",
        F.ceil((F.col("n") - in_main) / block).cast("long").alias("others"),
        F.ceil(in_main / block).cast("long").alias("mains"),
        F.col("main.component").alias("main"),
    )
    of_main = (F.col("mains") > 0) & (F.col("component") == F.col("main"))
    mark = F.xxhash64("class")
    dealt = members.join(chosen, "bucket").select(
        "bucket",
        "class",
        "component",
        F.when(of_main, F.col("others") + F.pmod(mark, F.greatest("mains", F.lit(1))))
        .otherwise(F.pmod(mark, F.col("others")))
        .alias("own"),
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("others") + F.when(of_main, 0).otherwise(F.col("mains")) - 1)
        ).alias("other"),
    )
    return dealt.select(
        "bucket", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "class", "component"
    )


def _once(facts: DataFrame) -> DataFrame:
    """One of the buckets that have the same members, that with the smallest number."""
    rest = [c for c in facts.columns if c not in ("bucket", "x", "y", "n")]
    same = facts.groupBy("n", "x", "y").agg(F.min(F.struct("bucket", *rest)).alias("m"))
    return same.select("n", "m.*")


def _link(dealt: DataFrame, samples: DataFrame, texts: DataFrame, weights, similarity: float, stage: Stage, name: str) -> DataFrame:
    """Edges (a, b) between similar classes of a block; ``dealt`` has the rows of the blocks."""
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def together(df: DataFrame, with_what: DataFrame, column: str) -> DataFrame:
        joined = df.join(with_what, "class").select("bucket", "left", "right", "own", "class", "component", column)
        return joined.repartition(parts, "bucket", "left", "right").sortWithinPartitions("bucket", "left", "right", "own", "class")

    kinds = ", ".join(f"{c} long" for c in _Promising.names)
    hopeful = stage.table(together(dealt, samples, "samples").mapInArrow(_by_block(_Promising()), kinds), f"hopeful_{name}")
    similar = together(hopeful, texts, "text").mapInArrow(_by_block(_Similar(weights, similarity)), "a long, b long")
    return stage.table(similar, f"links_{name}")


def _placed(members: DataFrame, joined: DataFrame | None) -> DataFrame:
    """``members`` (bucket, class) with the component of their class."""
    if joined is None:
        return members.withColumn("component", F.col("class"))
    found = members.join(joined.withColumnRenamed("id", "class"), "class", "left")
    return found.withColumn("component", F.coalesce("component", "class"))


def _joined(joined: DataFrame | None, links: DataFrame, stage: Stage) -> DataFrame:
    """``id, component`` after ``links`` have joined the components so far."""
    if joined is not None:
        links = links.union(joined.select("component", "id"))
    return components(links, stage)


def near_duplicates(
    docs: DataFrame, stage: Stage, similarity: float = 0.8, block: int = 512, max_ids: int = 4_000_000
) -> DataFrame:
    """``doc_id, component_id, kept, copies, digest`` for every row of ``docs``.

    ``component_id`` is the smallest id of the component; ``kept`` is true for one row of
    each; ``copies`` counts the rows with the same words, ``digest`` is the MD5 of these.
    Up to ``max_ids`` row numbers of candidates are broadcast to pick out their texts; more
    are joined by a shuffle.
    """
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(shingle_weights(docs))
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    rows = stage.numbered(
        source.mapInArrow(
            _sampled(weights), "doc_id long, text binary, digest binary, samples array<int>, bands array<long>"
        ),
        "rows",
    )
    # the first row of each digest stands for its class and names it
    facts = rows.groupBy("digest").agg(
        F.min("_row").alias("class"), F.min("doc_id").alias("least"), F.count("*").alias("copies")
    )
    facts = stage.table(facts, "classes")
    heads = rows.join(facts.select(F.col("class").alias("_row")), "_row", "left_semi")
    spread = heads.select(F.col("_row").alias("class"), F.explode("bands").alias("bucket"))
    company = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = stage.table(spread.join(company, "bucket"), "met")
    ids = stage.table(met.select(F.col("class").alias("_row")).distinct(), "ids")
    candidates = stage.table(
        rows.join(small_side(ids, max_ids), "_row", "left_semi").select(
            F.col("_row").alias("class"), "text", "samples"
        ),
        "candidates",
    )
    texts, samples = candidates.select("class", "text"), candidates.select("class", "samples")

    largest = met.groupBy("class").agg(F.max(F.struct("n", "bucket")).alias("m"))
    own = stage.table(largest.select(F.col("m.bucket").alias("bucket"), "class"), "largest")
    joined = None
    for name, salt, least in (("first", 1, 2), ("second", 2, block + 1)):
        dealt = _within(_placed(own, joined), block, salt, least)
        links = _link(dealt, samples, texts, weights, similarity, stage, name)
        joined = stage.table(_joined(joined, links, Stage(spark, f"{name}_components")), f"joined_{name}")
    rest = stage.table(_placed(met.select("bucket", "class"), joined), "rest")
    more = _link(_across_all(rest, block), samples, texts, weights, similarity, stage, "rest")
    joined = _joined(joined, more, Stage(spark, "components"))
    placed = facts.join(joined.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    lowest = placed.groupBy("component").agg(F.min("least").alias("lowest"))
    named = stage.table(placed.join(lowest, "component").select("digest", "component", "copies", "lowest"), "named")
    by_row = rows.select("_row", "doc_id", "digest").join(named, "digest")
    by_row = stage.table(by_row, "by_row")
    keeper = (
        by_row.where(F.col("doc_id").eqNullSafe(F.col("lowest"))).groupBy("component").agg(F.min("_row").alias("_keeper"))
    )
    return by_row.join(keeper, "component").select(
        "doc_id",
        F.coalesce("lowest", "doc_id").alias("component_id"),
        (F.col("_row") == F.col("_keeper")).alias("kept"),
        "copies",
        F.lower(F.hex("digest")).alias("digest"),
    )
