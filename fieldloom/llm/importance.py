"""Importance resampling towards a target distribution of hashed word n-grams.

A text is lowered (A-Z), its separators are collapsed to single spaces, and an
overlapped regular expression with a boundary lookaround emits the spans of the runs of
1 to ``max_n`` words that begin at each word, as nested groups; the bytes of a span are counted by crc32 in a fixed number of
buckets. What a bucket gains is the logarithm of its share in the target over its share
in the documents; a document's weight is the sum of its features' gains. Documents are
drawn by the highest weight plus Gumbel noise, the noise being a hash of the id, so a
draw without replacement needs no random state.

Texts are scanned once: the counts of a document are stored sparsely and read for the
corpus totals and again for the weights. What reaches the driver has one row per bucket.
Ranks come from a distributed order, never from one task.

Defined results: a null or empty text has no words and weight 0; a null id counts as the
text ''; repeated rows are documents of their own, and equal scores of equal ids are
ranked in any order; an empty table gives no rows, an empty target a T of 0; a document
of any length is scanned whole, a bounded number of spans at a time; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, words_of
from fieldloom.operators.windows import numbered

N_BUCKETS = 10_000
MAX_N = 3
#: Documents of fewer words are not drawn.
MIN_WORDS = 20
#: Share of the documents that may be drawn, in hundredths.
DRAWN = 5
SEED = 42
#: Spans of one length that are held of a text at a time, at most.
SPANS_AT_ONCE = 1 << 16

_COUNTED = "doc_id long, n_words long, n_features long, gaps binary, counts binary"


def span_patterns(max_n: int = MAX_N) -> regex.Pattern:
    """The spans that begin at a word as nested groups, the longest first: one scan finds all lengths.

    Words lie between single spaces. Near the end of a text, where fewer words are left,
    the longer groups are as short as what is left.
    """
    nested = rb"([^ ]+)"
    for _ in range(max_n - 1):
        nested = rb"(%b(?: [^ ]+)?)" % nested
    return regex.compile(rb" %b(?= )" % nested)


def collapsed(text: bytes | None) -> bytes:
    """The words of a text, each between single spaces."""
    return b" " + b" ".join(words_of(text)) + b" "


def _spans(flat: bytes, pattern: regex.Pattern) -> Iterator[list[Sequence[bytes]]]:
    """The spans of a text by length, shortest first; a long text comes in pieces."""
    longest, low, more = pattern.groups, 0, True
    while more:
        # a word and its space have two bytes or more; a piece overlaps the next by all but one word of a span
        high = end = flat.find(b" ", low + 2 * SPANS_AT_ONCE)
        for _ in range(longest - 1):
            end = flat.find(b" ", end + 1) if end >= 0 else end
        more = end >= 0
        rows = pattern.findall(flat, low, end + 1 if more else len(flat), overlapped=True)
        columns = [rows] if longest == 1 else list(zip(*rows))[::-1]
        yield [c[: max(len(rows) - (longest - 1 if more else n), 0)] for n, c in enumerate(columns)]
        low = high


def ngrams(text: bytes | None, max_n: int = MAX_N) -> Iterator[bytes]:
    """Every run of 1 to ``max_n`` words."""
    for spans in _spans(collapsed(text), span_patterns(max_n)):
        yield from chain.from_iterable(spans)


def _bucket_counts(flat: bytes, pattern: regex.Pattern, n_buckets: int) -> np.ndarray:
    counts = np.zeros(n_buckets, np.int64)
    for spans in _spans(flat, pattern):
        hashes = np.fromiter(map(crc32, chain.from_iterable(spans)), np.uint32)
        counts += np.bincount(hashes % n_buckets, minlength=n_buckets)
    return counts


def count_features(docs: DataFrame, n_buckets: int = N_BUCKETS, max_n: int = MAX_N, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, n_features, gaps, counts`` of ``id_col`` and ``text``.

    ``gaps`` holds the steps between a document's buckets as 16-bit numbers, the first
    from 0, and ``counts`` its features in them as 32-bit numbers.
    """
    if n_buckets > 1 << 16:
        raise ValueError("at most 65,536 buckets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = span_patterns(max_n)
        for batch in batches:
            words, features, gaps, counts = [], [], [], []
            for text in batch.column(1):
                flat = collapsed(text.as_buffer().to_pybytes() if text.is_valid else None)
                words.append(flat.count(b" ") - 1 if len(flat) > 2 else 0)
                found = _bucket_counts(flat, pattern, n_buckets)
                filled = np.flatnonzero(found)
                features.append(int(found.sum()))
                gaps.append(np.diff(filled, prepend=0).astype("<u2").tobytes())
                counts.append(found[filled].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words, pa.int64()),
                    pa.array(features, pa.int64()),
                    pa.array(gaps, pa.binary()),
                    pa.array(counts, pa.binary()),
                ],
                names=["doc_id", "n_words", "n_features", "gaps", "counts"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(count, _COUNTED)


def _read(gaps: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    steps = np.frombuffer(gaps.as_buffer(), "<u2")
    return np.cumsum(steps, dtype=np.int64), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64)


def bucket_totals(counted: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """``bucket, total`` over all documents; a task sends one row per bucket at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for pair in zip(batch.column(0), batch.column(1), strict=True):
                buckets, counts = _read(*pair)
                total[buckets] += counts
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(total[filled])], names=["bucket", "n"])

    partial = counted.select("gaps", "counts").mapInArrow(add, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("total"))


def bucket_gains(documents: DataFrame, target: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """``bucket, gain`` of every bucket, from the totals of the documents and of the target."""
    s, t = documents.select("bucket", F.col("total").alias("s")), target.select("bucket", F.col("total").alias("t"))
    both = documents.sparkSession.range(n_buckets).select(F.col("id").alias("bucket"))
    both = both.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    share = lambda part, whole: (F.col(part) + 1).cast("double") * F.lit(float(whole + n_buckets))
    return both.select("bucket", F.floor(1000 * F.log(share("t", all_s) / share("s", all_t))).alias("gain"))


def weigh(counted: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = (_read(*pair) for pair in zip(batch.column(3), batch.column(4), strict=True))
            weights = [int(gains[buckets] @ counts) for buckets, counts in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return counted.mapInArrow(add, "doc_id long, n_words long, n_features long, weight long")


def gumbel_noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousand times a Gumbel variate, rounded down, that the id alone decides."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(named, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    stage: Stage,
    *,
    target_id: str = "item_id",
    drawn: int = DRAWN,
    min_words: int = MIN_WORDS,
    n_buckets: int = N_BUCKETS,
    max_n: int = MAX_N,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    Of the documents with at least ``min_words`` words, ``drawn`` in a hundred (rounded
    down) with the highest scores get a rank from 1, ties going to the smaller id; the
    others have none.
    """
    counted = stage.table(count_features(docs, n_buckets, max_n), "counted")
    wanted = count_features(target, n_buckets, max_n, target_id)
    rows = bucket_gains(bucket_totals(counted, n_buckets), bucket_totals(wanted, n_buckets), n_buckets).collect()
    gains = np.zeros(n_buckets, np.int64)
    for bucket, gain in rows:
        gains[bucket] = gain
    scored = weigh(counted, gains).withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed))
    scored = stage.table(scored, "scored")
    able = F.col("n_words") >= min_words
    limit = scored.where(able).count() * drawn // 100
    placed = numbered(scored.where(able), [F.desc("score"), F.asc_nulls_first("doc_id")], stage.table, "_place")
    ranked = placed.withColumn("rank", F.when(F.col("_place") < limit, F.col("_place") + 1)).drop("_place")
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
