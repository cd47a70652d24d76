"""Benchmark passages in documents, by SimHash fingerprints of item-sized windows.

Items and windows are multisets of five-word shingles. A window has as many words as the
item (a shorter document is one window) and is taken up only where it holds enough of the
item's shingles to reach the similarity at all, which loses nothing. Its 64-bit SimHash is
looked up among those of the items of that size: the bits are cut into ``radius + 1``
blocks, so two fingerprints at most ``radius`` bits apart agree on a whole block, and a
join on size, block and its bits finds them all. What is within the radius is verified by
the exact weighted Jaccard similarity of the shingles (weights are multiplicities).

Items are searched in blocks of ``block_items``, each block's shingles being broadcast
for one pass over the documents; how many passes there are follows from a count.

Defined results: null and empty documents contain nothing; an item with fewer than
``shingle`` words is one shingle of all its words, and its windows are as short, so it is
found word for word only; items without words are in no document; repeated items and
repeated documents are reported each, those without an id too; of several windows of a
document the most similar is reported, the first if equal; documents of any length are
searched whole; other columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, small_side, words_of
from fieldloom.llm.shingling import STEP, WordNumbers, mix, occurrences, shingles, word_number

def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 and -1 for the 64 bits of each hash."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _number(sums: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits are the signs of sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<i8").ravel()


def simhash(hashes: np.ndarray) -> int:
    return int(_number(_bits(hashes).sum(axis=0, keepdims=True))[0])


def least_common(in_item: int, in_window: int, similarity: float) -> int:
    """How many common shingles a Jaccard similarity asks for at least."""
    return int(np.ceil(similarity / (1 + similarity) * (in_item + in_window) - 1e-9))


class Items:
    """Shingles of a block of items, for finding the places where windows can be similar."""

    def __init__(self, texts: list[bytes], size: int, similarity: float):
        self.size, self.similarity = size, similarity
        self.words = [words_of(t) for t in texts]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for ws in self.words for w in ws), 1)}
        self.numbers = np.array([0] + [word_number(w) for w in self.vocabulary], np.uint64)
        own = [shingles(np.array([word_number(w) for w in ws], np.uint64), size) for ws in self.words]
        pairs = sorted({(int(h), k) for k, hs in enumerate(own) for h in hs})
        self.hashes = np.array([h for h, _ in pairs], np.uint64)
        self.items = np.array([k for _, k in pairs], np.int64)
        self.distinct = np.unique(self.hashes)
        #: by length, the hashes of items that are one short shingle
        self.short = {k: self._whole(k) for k in sorted({len(ws) for ws in self.words} & set(range(1, size)))}

    def _whole(self, length: int) -> np.ndarray:
        every = [shingles(np.array([word_number(w) for w in ws], np.uint64), length) for ws in self.words if len(ws) == length]
        return np.unique(np.concatenate(every))

    def _hashes(self, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the runs of ``size`` words that are all words of items."""
        known = np.r_[0, np.cumsum(ids > 0)]
        at = np.flatnonzero(known[size:] - known[:-size] == size)
        h = np.zeros(len(at), np.uint64)
        for k in range(size):
            h = h * STEP + self.numbers[ids[at + k]]
        return at, mix(h)

    def windows(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(words of the item, first word) of each window that can reach the similarity."""
        if not self.vocabulary:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        found = set()
        for length, wanted in self.short.items():
            if length <= len(words):
                at, h = self._hashes(ids, length)
                found.update((length, int(start)) for start in at[np.isin(h, wanted)])
        n = len(words) - self.size + 1
        if n <= 0 or not len(self.distinct):
            return sorted(found)
        at, h = self._hashes(ids, self.size)
        place = np.minimum(np.searchsorted(self.distinct, h), len(self.distinct) - 1)
        hit = self.distinct[place] == h
        at, h = at[hit], h[hit]
        if not len(at):
            return sorted(found)
        low, high = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        item = self.items[np.concatenate([np.arange(a, b) for a, b in zip(low, high)])]
        where = np.repeat(at, high - low)
        for k in np.unique(item):
            length = len(self.words[k])
            in_item = length - self.size + 1
            in_window = min(in_item, n)
            need = least_common(in_item, in_window, self.similarity)
            places = where[item == k]
            if len(places) < need:
                continue
            marks = np.zeros(n + 1, np.int64)
            marks[places + 1] = 1
            total = np.cumsum(marks)
            inside = total[in_window:] - total[:-in_window]
            found.update((length, int(s)) for s in np.flatnonzero(inside >= need))
        return sorted(found)


def _describe(items: list[tuple], size: int) -> list[tuple]:
    """Rows (item, size, fingerprint, shingles) of items that have words."""
    rows = []
    for item_id, text in items:
        numbers = np.array([word_number(w) for w in words_of(text)], np.uint64)
        if len(numbers):
            hashes = shingles(numbers, min(size, len(numbers)))
            rows.append((item_id, len(numbers), simhash(hashes), occurrences(hashes).view(np.int64).tolist()))
    return rows


def _blocks(fingerprint, radius: int):
    """The bits of a fingerprint in ``radius + 1`` blocks."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[
            F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    stage: Stage,
    similarity: float = 0.8,
    shingle: int = 5,
    radius: int = 20,
    block_items: int = 20_000,
    key: str = "doc_id",
) -> DataFrame:
    """``doc_id, item_id, similarity, distance, first_word, n_words``, a row for each document
    and item it contains; ``first_word`` counts from 0. ``key`` is the column that names
    documents; it comes back as ``doc_id``."""
    spark = docs.sparkSession
    items = stage.numbered(
        benchmark.select(F.col("item_id").alias("item_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")), "items"
    )
    passes = max(1, -(-items.count() // block_items))
    source = docs.select(
        F.monotonically_increasing_id().alias("_doc"), F.col(key).alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    item_type = items.schema["item_id"].dataType.simpleString()
    found = []
    for k in range(passes):
        block = items.where(F.pmod(F.xxhash64("_row"), F.lit(passes)) == k).select("item_id", "text").collect()
        held = spark.sparkContext.broadcast([bytes(r["text"]) for r in block])

        def cut(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            searched, numbers = Items(held.value, shingle, similarity), WordNumbers()
            for batch in batches:
                rows = []
                for row, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                    words = words_of(text)
                    places = searched.windows(words)
                    if not places:
                        continue
                    own = np.array([numbers[w] for w in words], np.uint64)
                    hashes = shingles(own, shingle)
                    sums = np.r_[np.zeros((1, 64), np.int32), np.cumsum(_bits(hashes), axis=0)]
                    for size, start in places:
                        if size < shingle:
                            one = shingles(own[start : start + size], size)
                            rows.append((row, doc, size, start, simhash(one), one.view(np.int64)))
                            continue
                        end = min(start + size - shingle + 1, len(hashes))
                        mark = int(_number(sums[end : end + 1] - sums[start : start + 1])[0])
                        rows.append((row, doc, size, start, mark, occurrences(hashes[start:end]).view(np.int64)))
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64(), batch.schema.field(1).type, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, kinds)],
                    ["_doc", "doc_id", "size", "first_word", "mark", "own"],
                )

        windows = stage.table(
            source.mapInArrow(
                cut, f"_doc long, doc_id {id_type}, size int, first_word int, mark long, own array<long>"
            ),
            f"windows{k}",
        )
        index = stage.table(
            spark.createDataFrame(
                _describe([(r["item_id"], bytes(r["text"])) for r in block], shingle),
                f"item_id {item_type}, size int, item_mark long, theirs array<long>",
            ).withColumn("_item", F.monotonically_increasing_id()),
            f"index{k}",
        )
        near = windows.select("*", F.posexplode(_blocks(F.col("mark"), radius)).alias("block", "bits")).join(
            small_side(
                index.select("_item", "size", "item_mark", F.posexplode(_blocks(F.col("item_mark"), radius)).alias("block", "bits")),
                (radius + 1) * block_items,
            ),
            ["size", "block", "bits"],
        )
        distance = F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))).alias("distance")
        # a pair that agrees on several blocks counts at the first of them
        agree = F.transform(
            F.arrays_zip(_blocks(F.col("mark"), radius).alias("a"), _blocks(F.col("item_mark"), radius).alias("b")),
            lambda x: x["a"] == x["b"],
        )
        near = near.where(F.array_position(agree, True) == F.col("block") + 1)
        close = near.select("_doc", "doc_id", "first_word", "size", "own", "_item", distance).where(F.col("distance") <= radius)
        common = F.size(F.array_intersect("own", "theirs"))
        joint = F.size("own") + F.size("theirs") - common
        sure = close.join(small_side(index.select("_item", "item_id", "theirs"), block_items), "_item").select(
            "_doc", "_item", "doc_id", "item_id", "first_word", "size", "distance", (common / joint).alias("similarity")
        ).where(F.col("similarity") >= similarity - 1e-12)
        best = F.max(
            F.struct("similarity", (-F.col("first_word")).alias("_late"), "distance", "size", "doc_id", "item_id")
        ).alias("m")
        found.append(sure.groupBy("_doc", "_item").agg(best).select("m.*"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.select(
        "doc_id",
        "item_id",
        "similarity",
        "distance",
        (-F.col("_late")).alias("first_word"),
        F.col("size").alias("n_words"),
    )
