"""Quality by the perplexity of an interpolated modified Kneser-Ney n-gram model.

The model is one of bytes, ``ORDER`` to a gram, trained on all trusted documents: counts of
the longest grams, continuation counts of the shorter ones, three discounts per order
from the counts of counts. Only counts of the longest grams are kept. They are sharded by
a hash of the ``LOW`` bytes before a gram's last one: a gram, all its shorter forms above
``LOW`` bytes and all their contexts then lie in one shard, which works out its own
continuation counts and context sums. Grams of up to ``LOW`` bytes, at most 256**``LOW``
whatever the corpus, are one table that every task gets.

Documents are packed into chunks of some megabytes. The distinct grams of a chunk are joined
with the counts, shard by shard; a shard interpolates their log-probabilities, and those come
back to the chunk, which adds them up over the bytes of each document. Neither the counts
nor the documents are ever held in one place. Grams and log-probabilities move as packed
arrays; a log-probability is rounded to 1/``SCALE``.

No trusted document is scored by a model that read it: texts are dealt into two folds by
hash, each fold has counts of its own in the same shards, and a trusted document is scored
by those of the other fold. All others are scored by the counts of all.

The perplexity of a short text is drawn towards the median of its language, as if
``PRIOR`` bytes more had been read. A document is rejected if the log of its perplexity
lies more than ``WIDTH`` times as far above its language's trusted median as that
language's trusted 0.9 quantile does. Quantiles are those of distinct texts and withstand
the noise in what is trusted. A language of few distinct trusted texts has its quantiles
blended with those of all, as if ``SUPPORT`` texts more had been read, and the higher of
its own and the blended median counts; the distance is at least ``LEAST_SPREAD``.

Defined results: null and empty texts have the median perplexity of their language and are
kept; languages (null is one) without trusted documents use the quantiles of all; without
any trusted document every document is kept with perplexity 1; a labelled id counts as
trusted if no row calls it bad; a text longer than a chunk is a chunk of its own; repeated
rows are scored each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage, small_side
from fieldloom.llm.shingling import mix

ORDER = 7
#: Grams up to this length are in one table; the bytes that decide a longer one's shard.
LOW = 3
PRIOR = 64
WIDTH = 4.0
SUPPORT = 20
LEAST_SPREAD = 0.02
#: Bytes of text whose grams are counted, or looked up, together.
CHUNK = 12 << 20
#: Bytes of it that are added up at a time.
ADDED = 1 << 21
#: Bytes of scored text per shard, and shards at most; and per task that has a shard's counts.
SHARD, MOST_SHARDS, DEALT = 1 << 24, 4096, 1 << 30
#: Parts of a unit that log-probabilities are rounded to; they go down to -512.
SCALE = 128
#: Counts of all trusted texts, of the first fold, of the second.
MODELS = (0, 1, 2)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")).cast("binary"))


def fold() -> Column:
    """1 or 2: the model that reads a trusted text, besides that of all."""
    return F.pmod(text_hash(), F.lit(2)).cast("int") + 1


def grams_of(text: bytes) -> np.ndarray:
    """A 64-bit number for each byte: itself and those before it, zero before the first."""
    b = np.frombuffer(b"\0" * (ORDER - 1) + text, np.uint8)
    n = len(text)
    gram = np.zeros(n, np.uint64)
    for k in range(ORDER):
        gram <<= np.uint64(8)
        gram |= b[k : n + k]
    return gram


def all_grams(texts: list[bytes]) -> np.ndarray:
    """The grams of some texts, one text after the other."""
    every, at = np.empty(sum(map(len, texts)), np.uint64), 0
    for text in texts:
        every[at : at + len(text)] = grams_of(text)
        at += len(text)
    return every


def distinct_grams(texts: list[bytes]) -> np.ndarray:
    """The distinct grams of some texts, in order."""
    grams = all_grams(texts)
    grams.sort()
    return grams[np.r_[True, grams[1:] != grams[:-1]]] if len(grams) else grams


def _tail(order: int) -> np.uint64:
    return np.uint64((1 << (8 * order)) - 1)


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each gram, by the bytes before its last one."""
    return (mix(grams >> np.uint64(8) & _tail(LOW)) % np.uint64(shards)).astype(np.int64)


def _by_shard(grams: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard's places in an array of grams."""
    shard = shard_of(grams, shards)
    order = np.argsort(shard, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(shard[order]) > 0]) if len(order) else []
    for low, high in zip(starts, np.r_[starts[1:], len(order)].astype(int)):
        yield int(shard[order[low]]), order[low:high]


def packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes, those of equal weight side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _turned(grams: np.ndarray) -> np.ndarray:
    """Grams with the bytes before the last one in front, then the last: those of a shard are then alike."""
    before, last, rest = grams >> np.uint64(8) & _tail(LOW), grams & np.uint64(255), grams >> np.uint64(8 * (LOW + 1))
    return before << np.uint64(40) | last << np.uint64(32) | rest


def sent(grams: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Distinct grams as they are sent: in which order, and packed."""
    turned = _turned(grams)
    order = np.argsort(turned)
    return order, packed(np.diff(turned[order], prepend=np.uint64(0)))


def received(data: bytes) -> np.ndarray:
    """The grams in the order they were sent in."""
    turned = np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)
    before, last, rest = turned >> np.uint64(40), turned >> np.uint64(32) & np.uint64(255), turned & _tail(4)
    return rest << np.uint64(8 * (LOW + 1)) | before << np.uint64(8) | last


_COUNTS = "shard int, grams binary, n1 binary, n2 binary"


def _counted(shard: int, grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    order, data = sent(grams)
    row = [shard], [data], [packed(n[0][order].astype(np.uint64))], [packed(n[1][order].astype(np.uint64))]
    kinds = pa.int32(), pa.binary(), pa.binary(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "grams", "n1", "n2"])


def _read_counts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A shard's grams in order and their counts by fold."""
    grams = received(row["grams"])
    order = np.argsort(grams)
    return grams[order], np.array([unpacked(row[c], np.uint64) for c in ("n1", "n2")]).astype(np.int64)[:, order]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order and their counts (a row per fold) from several such pairs."""
    grams = np.concatenate([np.zeros(0, np.uint64), *(g for g, _ in parts)])
    n = np.concatenate([np.zeros((2, 0), np.int64), *(n for _, n in parts)], axis=1)
    distinct, place = np.unique(grams, return_inverse=True)
    sums = [np.bincount(place, row, len(distinct)).astype(np.int64) for row in n]
    return distinct, np.array(sums).reshape(2, -1)


def count_grams(docs: DataFrame, shards: int) -> DataFrame:
    """A row per shard: its grams and their counts by fold, packed.

    Grams are counted over some megabytes before they move, so a frequent one moves
    once per so many.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {1: [], 2: []}, 0

        def flush():
            parts = []
            for k, texts in held.items():
                distinct, n = np.unique(all_grams(texts), return_counts=True)
                parts.append((distinct, np.array([n * (k == 1), n * (k == 2)])))
            grams, n = _merged(parts)
            for shard, places in _by_shard(grams, shards):
                yield _counted(shard, grams[places], n[:, places])

        for batch in batches:
            for text, k in zip(*(c.to_pylist() for c in batch.columns)):
                held[k].append(text)
                size += len(text)
                if size > CHUNK:
                    yield from flush()
                    held, size = {1: [], 2: []}, 0
        if size:
            yield from flush()

    def merge(rows: pa.Table) -> pa.Table:
        read = rows.to_pylist()
        return pa.Table.from_batches([_counted(read[0]["shard"], *_merged([_read_counts(r) for r in read]))])

    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), fold().alias("fold"))
    return texts.mapInArrow(count, _COUNTS).groupBy("shard").applyInArrow(merge, _COUNTS)


def _three(n: np.ndarray) -> np.ndarray:
    """Counts of all texts and of either fold, from those of the folds."""
    return np.concatenate([n.sum(axis=0, keepdims=True), n])


def levels(grams: np.ndarray, n: np.ndarray, top: int, bottom: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By order, down to ``bottom``: grams in order and their counts in each model.

    ``n`` are the counts of ``grams`` of ``top`` bytes; a shorter gram's are the distinct
    grams, one byte longer, that end in it.
    """
    found = {top: (grams, n)}
    for order in range(top - 1, bottom - 1, -1):
        longer, counts = found[order + 1]
        tails, place = np.unique(longer & _tail(order), return_inverse=True)
        kinds = [np.bincount(place, row > 0, len(tails)) for row in counts]
        found[order] = tails, np.array(kinds).astype(np.int64).reshape(len(counts), -1)
    return found


def _few(counts: np.ndarray) -> list[int]:
    """How many grams have the counts one to four, model by model."""
    return [int((row == k).sum()) for row in counts for k in range(1, 5)]


def _discounts(few: list[int]) -> list[float]:
    """The modified Kneser-Ney discounts for counts of one, two, and three or more."""
    n1, n2, n3, n4 = map(float, few)
    if not (n1 and n2 and n3):
        return [0.5, 0.75, 0.9]  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), k - 0.05) for k, d in enumerate(found, 1)]


@dataclass
class Level:
    """One order of one model: grams and contexts in order, with what interpolation needs of them."""

    grams: np.ndarray
    left: np.ndarray  # a gram's count less its discount
    contexts: np.ndarray
    total: np.ndarray  # a context's counts
    gone: np.ndarray  # what was discounted from them

    @classmethod
    def of(cls, grams: np.ndarray, n: np.ndarray, discounts: list[float]) -> Level:
        read = n > 0
        grams, n = grams[read], n[read]
        discount = np.asarray(discounts)[np.minimum(n, 3) - 1]
        contexts, place = np.unique(grams >> np.uint64(8), return_inverse=True)
        sums = [np.bincount(place, w, len(contexts)) for w in (n, discount)]
        return cls(grams, n - discount, contexts, *sums)

    def interpolate(self, sought: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The probability of the last byte of each gram, from that of the order below."""
        at, known = _find(self.contexts, sought >> np.uint64(8))
        place, hit = _find(self.grams, sought)
        own = np.where(hit, self.left[place] if len(self.left) else 0.0, 0.0)
        p = below.copy()
        p[known] = (own[known] + self.gone[at[known]] * below[known]) / self.total[at[known]]
        return p


def _find(own: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of what is sought in a sorted array, and whether it is there."""
    if not len(own):
        return np.zeros(len(sought), np.int64), np.zeros(len(sought), bool)
    place = np.minimum(np.searchsorted(own, sought), len(own) - 1)
    return place, own[place] == sought


def interpolated(held: list[Level], sought: np.ndarray, below: np.ndarray, first: int) -> np.ndarray:
    """The probability of each gram's last byte by the orders from ``first`` on."""
    for order, level in enumerate(held, first):
        below = level.interpolate(sought & _tail(order), below)
    return below


@dataclass
class Model:
    """Sharded counts, the orders up to ``LOW`` of each model, and the discounts of those above.

    ``deal`` is how many tasks have a shard's counts when texts are scored.
    """

    counts: DataFrame
    shards: int
    deal: int
    low: list[list[Level]]
    discounts: list[list[list[float]]]


def train(trusted: DataFrame, stage: Stage, size: int) -> Model | None:
    """The model of the trusted texts, sharded for scoring ``size`` bytes; None if they hold nothing."""
    shards = max(1, min(-(-size // SHARD), MOST_SHARDS))
    counts = stage.table(count_grams(trusted, shards), "counts")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of counts of the longer orders, and a shard's part of the counts of order ``LOW``."""
        for batch in batches:
            for row in batch.to_pylist():
                grams, n = _read_counts(row)
                found = levels(grams, _three(n), ORDER, LOW)
                few = [_few(found[order][1]) for order in range(LOW + 1, ORDER + 1)]
                grams, n = found[LOW]
                columns = [pa.array(grams.view(np.int64)), *map(pa.array, n)]
                columns.append(pa.array([sum(few, [])] + [None] * (len(grams) - 1), pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["gram", "n0", "n1", "n2", "few"])

    looked = stage.table(counts.mapInArrow(look, "gram long, n0 long, n1 long, n2 long, few array<long>"), "looked")
    places = range(12 * (ORDER - LOW))
    few = looked.where("few is not null").agg(F.array(*[F.sum(F.col("few")[k]) for k in places])).first()[0]
    # at most 256**LOW rows
    low = looked.groupBy("gram").agg(*[F.sum(f"n{m}").alias(f"n{m}") for m in MODELS]).orderBy("gram").toPandas()
    if not len(low):
        return None
    below = levels(low["gram"].to_numpy(np.int64).view(np.uint64), low[[f"n{m}" for m in MODELS]].to_numpy(np.int64).T, LOW, 1)
    kept, discounts = [], []
    for m in MODELS:
        orders = [(below[order][0], below[order][1][m]) for order in range(1, LOW + 1)]
        kept.append([Level.of(grams, n, _discounts(_few(n[None]))) for grams, n in orders])
        discounts.append([_discounts(few[12 * k + 4 * m : 12 * k + 4 * m + 4]) for k in range(ORDER - LOW)])
    return Model(counts, shards, max(1, -(-size // (shards * DEALT))), kept, discounts)


def _texts(rows: pa.Table | pa.RecordBatch, place: int) -> list[bytes]:
    return [t or b"" for t in rows.column(place).cast(pa.binary()).to_pylist()]


def _runs(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """Texts in runs of about so many bytes."""
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def added(texts: list[bytes], grams: np.ndarray, costs: np.ndarray) -> list[float]:
    """What the grams of each text cost together, by the costs of grams in order."""
    coded = pa.array(all_grams(texts)).dictionary_encode()
    own = coded.dictionary.to_numpy()
    order = np.argsort(own)
    # those sought are in order, so neighbours are found in one place
    own_costs = np.empty(len(own), np.float32)
    own_costs[order] = costs[np.searchsorted(grams, own[order])]
    cost, ends = own_costs[coded.indices.to_numpy()], np.cumsum([len(t) for t in texts])
    return [float(cost[end - len(t) : end].sum(dtype=np.float64)) for t, end in zip(texts, ends)]


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...], prefix: str = "", by: Column | None = None) -> DataFrame:
    """The columns ``keep`` with ``log_p`` and ``n_bytes`` of every document.

    ``by`` is the number of the model that scores a document, else 0.
    """
    new = [f"{prefix}log_p", f"{prefix}n_bytes"]
    columns = [*keep, *([] if "text" in keep else ["text"])]
    text_at, shards = columns.index("text"), model.shards
    source = docs.select(*columns, (F.lit(0) if by is None else by).cast("int").alias(f"{prefix}_by"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        sizes = dict.fromkeys(MODELS, 0)

        def chunk(m: int):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[m][0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as out:
                for part in held.pop(m):
                    out.write_batch(part)
            sizes[m] = 0
            return pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["by", "chunk"])

        for batch in batches:
            using = batch.column(len(columns)).to_numpy()
            for m in MODELS:
                mine = batch.filter(pa.array(using == m)) if (using == m).any() else None
                low = 0
                for i, text in enumerate(_texts(mine, text_at) if mine else []):
                    sizes[m] += len(text) + 256
                    if sizes[m] >= CHUNK:
                        held.setdefault(m, []).append(mine.slice(low, i + 1 - low))
                        yield chunk(m)
                        low = i + 1
                if mine and low < mine.num_rows:
                    held.setdefault(m, []).append(mine.slice(low))
        for m in list(held):
            yield chunk(m)

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, m, chunk in zip(*(c.to_pylist() for c in batch.columns)):
                grams = distinct_grams(_texts(pa.ipc.open_stream(chunk).read_all(), text_at))
                rows = [(row, m, shard, sent(grams[places])[1]) for shard, places in _by_shard(grams, shards)]
                kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["_row", "by", "shard", "grams"])

    low = docs.sparkSession.sparkContext.broadcast(model.low)
    discounts = model.discounts

    def look_up(counts: pa.Table, asked: pa.Table) -> pa.Table:
        held: dict[int, list[Level]] = {}
        for row in counts.to_pylist():  # one, or none
            grams, n = _read_counts(row)
            found = levels(grams, _three(n), ORDER, LOW + 1)
            for m in MODELS:
                orders = [(*found[order], discounts[m][order - LOW - 1]) for order in range(LOW + 1, ORDER + 1)]
                held[m] = [Level.of(grams, n[m], d) for grams, n, d in orders]
        values = []
        for m, grams in zip(asked.column("by").to_pylist(), asked.column("grams").to_pylist()):
            grams = received(grams)
            p = interpolated(low.value[m], grams, np.full(len(grams), 1 / 256), 1)
            p = interpolated(held.get(m, []), grams, p, LOW + 1)
            values.append(packed(np.minimum(np.rint(-np.log(p) * SCALE), 65535).astype(np.uint16)))
        return pa.table([asked.column("_row"), asked.column("shard"), pa.array(values, pa.binary())], ["_row", "shard", "log_p"])

    def add_up(chunks: pa.Table, found: pa.Table) -> pa.Table:
        values = dict(zip(found.column("shard").to_pylist(), found.column("log_p").to_pylist()))
        scored = []
        for chunk in chunks.column("chunk").to_pylist():
            rows = pa.ipc.open_stream(chunk).read_all()
            texts = _texts(rows, text_at)
            grams = distinct_grams(texts)
            costs = np.zeros(len(grams), np.float32)
            for shard, places in _by_shard(grams, shards):
                costs[places[sent(grams[places])[0]]] = unpacked(values.pop(shard), np.uint16)
            sums = [-total / SCALE for some in _runs(texts, ADDED) for total in added(some, grams, costs)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            scored.append(pa.Table.from_arrays([*rows.columns[: len(keep)], pa.array(sums, pa.float64()), sizes], [*keep, *new]))
        return pa.concat_tables(scored)

    kept = docs.select(*keep).schema.simpleString()[len("struct<") : -1]
    # chunks move once: what they ask for and what they are told meets them where they then lie
    chunks = source.mapInArrow(pack, "by int, chunk binary").select(F.monotonically_increasing_id().alias("_row"), "by", "chunk")
    chunks = chunks.repartition("_row")
    asked = chunks.mapInArrow(sought, "_row long, by int, shard int, grams binary")
    # where a shard would have to answer for too much text, several tasks have its counts
    asked = asked.withColumn("part", F.pmod("_row", F.lit(model.deal)).cast("int"))
    counts = model.counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(model.deal - 1))))
    found = counts.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInArrow(look_up, "_row long, shard int, log_p binary")
    schema = f"{kept},{new[0]}:double,{new[1]}:bigint"
    return chunks.groupBy("_row").cogroup(found.groupBy("_row")).applyInArrow(add_up, schema)


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good and never bad."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return marks.where("q = 1").select("doc_id")


def thresholds(scores: DataFrame) -> DataFrame:
    """``lang, middle, limit`` from the scores (lang, text_hash, log_p, n_bytes) of trusted
    documents: the median of the mean negative log-probability and the rejection limit; a row
    with ``every`` true holds for languages without trusted documents."""
    mean = F.min(-F.col("log_p") / F.col("n_bytes")).alias("mean")
    facts = scores.where("n_bytes > 0").groupBy("lang", "text_hash").agg(mean)

    def limits(grouped) -> DataFrame:
        return grouped.agg(
            F.count("*").alias("n"), F.percentile_approx("mean", 0.5, 10_000).alias("own"), F.percentile_approx("mean", 0.9, 10_000).alias("high")
        ).withColumn("spread", F.col("high") - F.col("own"))

    every = limits(facts.groupBy()).first()
    if not every["n"]:
        every = {"own": 0.0, "spread": 0.0}
    share = F.col("n") / (F.col("n") + SUPPORT)
    blended = share * F.col("own") + (1 - share) * every["own"]
    spread = F.greatest(share * F.col("spread") + (1 - share) * every["spread"], F.lit(LEAST_SPREAD))
    middle = F.greatest(blended, "own")
    own = limits(facts.groupBy("lang")).select("lang", F.lit(False).alias("every"), middle.alias("middle"), (middle + WIDTH * spread).alias("limit"))
    limit = every["own"] + WIDTH * max(every["spread"], LEAST_SPREAD)
    common = facts.limit(1).select(
        F.lit(None).cast(scores.schema["lang"].dataType).alias("lang"), F.lit(True).alias("every"), F.lit(every["own"]).alias("middle"), F.lit(limit).alias("limit")
    )
    return own.unionByName(common)


def judge(scores: DataFrame, limits: DataFrame, prefix: str = "") -> DataFrame:
    """``scores`` with ``perplexity``, ``threshold`` and ``accepted``."""
    p = prefix
    own = limits.where("not every").select(F.col("lang").alias(f"{p}_l"), F.col("middle").alias(f"{p}_m"), F.col("limit").alias(f"{p}_t"))
    every = limits.where("every").select(F.col("middle").alias(f"{p}_em"), F.col("limit").alias(f"{p}_et"))
    # a row per language; the common limits are one row, which languages without their own take
    joined = scores.join(small_side(own, 100_000), scores["lang"].eqNullSafe(F.col(f"{p}_l")), "left")
    common = every.first()
    middle = F.coalesce(F.col(f"{p}_m"), F.lit(common[0] if common else 0.0))
    limit = F.coalesce(F.col(f"{p}_t"), F.lit(common[1] if common else float("inf")))
    mean = (-F.col(f"{p}log_p") + PRIOR * middle) / (F.col(f"{p}n_bytes") + PRIOR)
    return joined.select(
        *[scores[c] for c in scores.columns],
        F.exp(mean).alias(f"{p}perplexity"),
        F.exp(limit).alias(f"{p}threshold"),
        (mean <= limit).alias(f"{p}accepted"),
    )


def _scored(docs: DataFrame, labels: DataFrame, stage: Stage, keep: tuple[str, ...], prefix: str, max_ids: int) -> tuple[DataFrame, DataFrame] | None:
    """Scores of all documents, and of the trusted ones (lang, text_hash, log_p, n_bytes); nothing
    without any trusted text."""
    p = prefix
    good = small_side(stage.table(trusted_ids(labels), "trusted"), max_ids)
    model = train(docs.select("doc_id", "text").join(good, "doc_id", "left_semi"), stage, text_bytes(docs))
    if model is None:
        return None
    marked = docs.join(good.withColumn(f"{p}_trusted", F.lit(True)), "doc_id", "left").select(
        *[docs[c] for c in docs.columns], F.coalesce(f"{p}_trusted", F.lit(False)).alias(f"{p}_trusted"), text_hash().alias(f"{p}_hash")
    )
    by = F.when(F.col(f"{p}_trusted"), 3 - fold()).otherwise(0)  # the fold that did not read the text
    scores = stage.table(score_documents(marked, model, (*keep, f"{p}_trusted", f"{p}_hash"), p, by), "scores")
    trusted = scores.where(f"{p}_trusted").select(
        "lang", F.col(f"{p}_hash").alias("text_hash"), F.col(f"{p}log_p").alias("log_p"), F.col(f"{p}n_bytes").alias("n_bytes")
    )
    return scores, trusted


def rate_documents(docs: DataFrame, labels: DataFrame, stage: Stage, max_ids: int = 4_000_000) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, accepted`` for every row of ``docs``.

    Trusted are the documents that ``labels`` call good; up to ``max_ids`` of their ids are
    broadcast, more are joined by a shuffle.
    """
    source = docs.select("doc_id", "lang", "text")
    found = _scored(source, labels, stage, ("doc_id", "lang"), "", max_ids)
    if found is None:
        return source.select(
            "doc_id", "lang", F.lit(1.0).alias("perplexity"), F.lit(float("inf")).alias("threshold"), F.lit(True).alias("accepted")
        )
    scores, trusted = found
    limits = stage.table(thresholds(trusted), "limits")
    return judge(scores, limits).select("doc_id", "lang", "perplexity", "threshold", "accepted")


def accept_documents(docs: DataFrame, labels: DataFrame, stage: Stage, max_ids: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` that are accepted, with their columns as they are."""
    found = _scored(docs, labels, stage, tuple(docs.columns), "_quality_", max_ids)
    if found is None:
        return docs
    scores, trusted = found
    limits = stage.table(thresholds(trusted), "limits")
    return judge(scores, limits, prefix="_quality_").where("_quality_accepted").select(*docs.columns)
