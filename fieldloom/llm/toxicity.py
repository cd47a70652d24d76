"""Toxic spans by a linear-chain conditional random field.

Documents carry labels, words do not; words of a bounded sample of labelled documents are
labelled first. A word, or a beginning of it, that stands in far more of the sample's toxic
than clean documents is evidence, and the words of toxic documents with evidence are the
toxic tokens. The field has two states per word; its features are the word, its
beginnings and its ends, hashed to a fixed number of weights. It is trained on chains of
at most ``CHAIN`` words within a line by gradients of the exact log-likelihood.

Scoring runs forward-backward over all chains of every document. The marginals of a
document are aggregated (expected number of toxic words, the surest word, their share),
and a logistic regression on the sample turns these into a score. Words whose marginal is
0.5 or more are joined into spans with character offsets.

The sample: at most ``max_docs`` documents of either label, lowest hash of the id first, and
no more of a document than its words in ``max_chains`` chains per label. Only these, and a
model of fixed size, ever reach the driver.

Defined results: null and empty texts have no words, no spans and the score of a document
without evidence; ids that repeat in the labels count as toxic if one row says so; repeated
documents are scored each; without labelled rows of both kinds every score is 0; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import words_of

CHAIN = 128
BUCKETS = 1 << 18
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def features_of(word: bytes) -> list[int]:
    """Hashed features of a lower-cased word: any, itself, its beginnings and its end."""
    found = [0, crc32(word, 1) % BUCKETS]
    found += [crc32(word[:k], k) % BUCKETS for k in (3, 4, 5, 6, 7) if len(word) > k]
    if len(word) > 4:
        found.append(crc32(word[-4:], 11) % BUCKETS)
    return found


def chains_of(text: bytes) -> list[list[bytes]]:
    """The words of each line, at most ``CHAIN`` to a chain."""
    chains = []
    for line in text.split(b"\n"):
        words = words_of(line)
        if len(words) <= CHAIN:
            if words:
                chains.append(words)
        else:
            chains += [words[k : k + CHAIN] for k in range(0, len(words), CHAIN)]
    return chains


class _Scores(dict):
    """Scores of words, worked out when first asked for."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, word: bytes) -> float:
        if len(self) > 500_000:
            self.clear()
        weights = self.weights
        self[word] = score = sum([weights[f] for f in features_of(word)])
        return score


@dataclass
class Model:
    weights: np.ndarray  # score of the toxic state by feature; the clean state has none
    moves: np.ndarray  # scores of state pairs
    calibration: np.ndarray  # of the document score

    def __post_init__(self):
        self.scores = _Scores(self.weights)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Marginals of the toxic state, the log normaliser, and expected counts of state pairs.

    ``scores`` are the toxic scores of all words, chain after chain. All chains advance
    together, longest first, so those that have ended cost nothing.
    """
    if not len(scores):
        return np.zeros(0), 0.0, np.zeros((2, 2))
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    alive = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
    steps, n = len(alive), len(lengths)
    odds = np.exp(np.clip(scores, -60, 60))
    (m00, m01), (m10, m11) = np.exp(moves)
    forward, scale = np.empty((steps, n)), np.empty((steps, n))  # share of the toxic state; what was divided out
    for t in range(steps):
        k = alive[t]
        u = odds[starts[:k] + t]
        if t:
            p1 = forward[t - 1, :k]
            p0 = 1 - p1
            a0, a1 = p0 * m00 + p1 * m10, (p0 * m01 + p1 * m11) * u
        else:
            a0, a1 = np.ones(k), u
        scale[t, :k] = a0 + a1
        forward[t, :k] = a1 / scale[t, :k]
    back0, back1 = np.ones(n), np.ones(n)
    marginals = np.empty(len(scores))
    pairs, log_z = np.zeros((2, 2)), 0.0
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        f1, b0, b1 = forward[t, :k], back0[:k], back1[:k]
        hot = f1 * b1
        marginals[at] = hot / ((1 - f1) * b0 + hot)
        log_z += np.log(scale[t, :k]).sum()
        if t:
            c0, c1 = b0 / scale[t, :k], odds[at] * b1 / scale[t, :k]
            p1 = forward[t - 1, :k]
            p0 = 1 - p1
            back0[:k], back1[:k] = m00 * c0 + m01 * c1, m10 * c0 + m11 * c1
            total = p0 * back0[:k] + p1 * back1[:k]
            pairs += [
                [(p0 * c0 * m00 / total).sum(), (p0 * c1 * m01 / total).sum()],
                [(p1 * c0 * m10 / total).sum(), (p1 * c1 * m11 / total).sum()],
            ]
    return marginals, float(log_z), pairs


def evidence(docs: list[tuple[list[list[bytes]], int]], least: int = 5, ratio: float = 8.0) -> set[int]:
    """Features that stand in ``ratio`` times as large a share of toxic as of clean documents."""
    counts = (Counter(), Counter())
    for chains, toxic in docs:
        counts[toxic].update({f for words in chains for w in set(words) for f in features_of(w)})
    n = [sum(1 for _, t in docs if t == k) for k in (0, 1)]
    return {
        f
        for f, c in counts[1].items()
        if c >= least and (c + 0.5) / (n[1] + 1) >= ratio * (counts[0][f] + 0.5) / (n[0] + 1)
    }


def _sizes(parted: list[list[list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each chain and of each document."""
    lengths = np.array([len(c) for chains in parted for c in chains], dtype=np.int64)
    return lengths, np.array([sum(map(len, chains)) for chains in parted], dtype=np.int64)


def _facts(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each document: expected toxic words, the surest word, and the share, as logs; and 1.

    The share is taken of 30 more words than there are, so that a few do not decide it."""
    facts = np.zeros((len(sizes), 4))
    facts[:, 3] = 1
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        expected = np.add.reduceat(marginals, starts)
        facts[full, 0] = np.log1p(expected)
        facts[full, 1] = np.maximum.reduceat(marginals, starts)
        facts[full, 2] = np.log1p(100 * expected / (sizes[full] + 30))
    return facts


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: list[tuple[bytes, int]], rounds: int = 25, max_chains: int = 40_000, ridge: float = 1e-6) -> Model:
    """Fit the field and the document score on labelled texts (text, 0 or 1)."""
    model = Model(np.zeros(BUCKETS), np.zeros((2, 2)), np.array([0.0, 0.0, 0.0, -30.0]))
    if len({t for _, t in docs}) < 2:
        return model
    parted = [(chains_of(text), toxic) for text, toxic in docs]
    known = evidence(parted)
    words, truth, lengths = [], [], []
    seen, room = np.zeros((2, 2)), [max_chains, max_chains]
    for chains, toxic in parted:
        for chain in chains[: room[toxic]]:
            y = [int(toxic and not known.isdisjoint(features_of(w))) for w in chain]
            words += chain
            truth += y
            lengths.append(len(chain))
            np.add.at(seen, (y[:-1], y[1:]), 1)
        room[toxic] -= min(room[toxic], len(chains))
    if not any(truth):
        return model
    # words repeat: gradients are summed by word before they go to its features
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(words))}
    place = np.fromiter((vocabulary[w] for w in words), np.int64, len(words))
    found = [features_of(w) for w in vocabulary]
    owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
    ids, local = np.unique(np.fromiter((x for f in found for x in f), np.int64), return_inverse=True)
    y, sizes = np.array(truth, dtype=np.float64), np.array(lengths)
    w, moves, grads, move_grads = np.zeros(len(ids)), np.zeros((2, 2)), np.full(len(ids), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        # steps are scaled by each weight's gradients so far
        unary = np.bincount(owner, w[local], len(found))
        marginals, _, pairs = forward_backward(unary[place], sizes, moves)
        by_word = np.bincount(place, y - marginals, len(found))
        g = np.bincount(local, by_word[owner], len(ids)) - ridge * len(y) * w
        gm = seen - pairs
        grads += g * g
        move_grads += gm * gm
        w += 0.7 * g / np.sqrt(grads)
        moves += 0.3 * gm / np.sqrt(move_grads)
    model.weights[ids] = w
    model = Model(model.weights, moves, model.calibration)
    marginals, sizes = mark(model, [chains for chains, _ in parted])
    model.calibration = _logistic(_facts(marginals, sizes), np.array([t for _, t in docs], dtype=np.float64))
    return model


def mark(model: Model, parted: list[list[list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state for all words of some documents, and words per document."""
    lengths, sizes = _sizes(parted)
    words = (w for chains in parted for chain in chains for w in chain)
    scores = np.fromiter(map(model.scores.__getitem__, words), np.float64, int(sizes.sum()))
    return forward_backward(scores, lengths, model.moves)[0], sizes


def score_texts(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Score, expected toxic words and spans of each text."""
    marginals, sizes = mark(model, [chains_of(t) for t in texts])
    facts = _facts(marginals, sizes)
    scores = 1 / (1 + np.exp(-np.clip(facts @ model.calibration, -30, 30)))
    parts = np.split(marginals, np.cumsum(sizes)[:-1])
    return scores, np.expm1(facts[:, 0]), [spans_of(t, p) for t, p in zip(texts, parts)]


def spans_of(text: bytes, marginals: np.ndarray) -> list[dict]:
    """Runs of words with a marginal of 0.5 or more, with character offsets."""
    spans: list[dict] = []
    hot = np.flatnonzero(marginals >= 0.5)
    if not len(hot):
        return spans
    # chains follow the text, so the k-th word of the text has the k-th marginal
    places = [m.span() for m in _WORD.finditer(text.decode("utf-8", "replace"))]
    last = -2
    for k in hot.tolist():
        start, end = places[k]
        if k == last + 1:
            spans[-1]["end"] = end
            spans[-1]["surest"] = max(spans[-1]["surest"], float(marginals[k]))
        else:
            spans.append({"start": start, "end": end, "surest": float(marginals[k])})
        last = k
    return spans


def labelled_sample(docs: DataFrame, labels: DataFrame, max_docs: int) -> list[tuple[str, int]]:
    """At most ``max_docs`` texts of either label, chosen by a hash of their id."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = []
    for toxic in (0, 1):
        of_kind = marks.where(F.col("toxic") == toxic).select("doc_id", "toxic")
        chosen += [tuple(r) for r in of_kind.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()]
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    # ids may repeat among the documents: the bound holds for rows, too
    kept = rows.orderBy(F.xxhash64("doc_id", "text")).limit(2 * max_docs).collect()
    return [(r["text"].encode("utf-8", "replace"), r["toxic"]) for r in sorted(kept, key=lambda r: (r["doc_id"], r["text"]))]


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """The columns ``keep`` of every document and its ``score, expected, spans``: the score,
    the expected number of toxic words, and the spans (start, end, surest).

    ``prefix`` goes before the three new names. The model has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.moves, model.calibration))
    new = [f"{prefix}{c}" for c in ("score", "expected", "spans")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Model(*shared.value)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("surest", pa.float64())]))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                scores, expected, spans = score_texts(held, part.column(len(keep)).to_pylist())
                columns = [*part.columns[: len(keep)], pa.array(scores), pa.array(expected), pa.array(spans, span)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *new])

    source = docs.select(*keep, F.coalesce("text", F.lit("")).cast("binary").alias(f"{prefix}_text"))
    kept = docs.select(*keep).schema.simpleString()[len("struct<") : -1]
    return source.mapInArrow(
        score, f"{kept},{new[0]}:double,{new[1]}:double,{new[2]}:array<struct<start:int,end:int,surest:double>>"
    )


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 1000) -> Model:
    """Train on at most ``max_docs`` documents of either label."""
    return train(labelled_sample(docs, labels, max_docs))
