"""Documents packed into training sequences by first-fit decreasing.

A document's token ids, with the end id, are cut at multiples of the sequence length.
Pieces are dealt at random into groups of bounded size; in each group the pieces, longest
first, go to the first sequence with room, found in a tournament tree of the sequences'
free room. Groups are independent, so no task holds more than one group.

Defined results: null and empty texts are the end id alone; texts of any length are encoded
whole and cut into as many pieces as they take; repeated rows are packed each;
a null id is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage

#: Tokenized words that a worker remembers; it starts anew when they are so many.
MEMORY = 1_000_000
#: Bytes of text whose ids are put together at once.
BATCH_BYTES = 1 << 22


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


@functools.cache
def _space_tokens(tokenizer) -> np.ndarray:
    """By token id: does the token begin with a space (which byte-level vocabularies write as U+0120)?"""
    vocabulary = tokenizer.get_vocab()
    begins = np.zeros(max(vocabulary.values()) + 1, bool)
    begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
    return begins


#: Ids of words after a space, by tokenizer file.
_known: dict[str, dict[str, bytes]] = {}
#: White space as any tokenizer may see it.
_SPACES = "\\t-\\r\\x1c-\\x20\\x{85}\\x{A0}\\x{1680}\\x{180E}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
_ODD_SPACE = rf" ([{_SPACES}]|\z)"
_BEFORE_VISIBLE = re.compile(r" (?=[^\s\u180e])")


def _ids(tokenizer, texts: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _word_ids(tokenizer, words: list[str], together: int = 256) -> list[bytes]:
    """Ids of words that each follow a space.

    Many are encoded as one text. Each begins with the one token that begins with a space,
    so where there are as many of those as words they show where to part the ids.
    """
    begins = _space_tokens(tokenizer)
    whole = [w for w in words if " " not in w]
    groups = [whole[k : k + together] for k in range(0, len(whole), together)]
    found = {}
    for group, ids in zip(groups, _ids(tokenizer, [" " + " ".join(g) for g in groups])):
        starts = np.flatnonzero(begins[np.frombuffer(ids, "<u4")])
        if len(starts) == len(group) and starts[0] == 0:
            edges = [*(4 * starts).tolist(), len(ids)]
            found.update((w, ids[a:b]) for w, a, b in zip(group, edges, edges[1:]))
    rest = [w for w in words if w not in found]
    found.update(zip(rest, _ids(tokenizer, [" " + w for w in rest])))
    return [found[w] for w in words]


def _parts(texts: pa.Array) -> pa.ListArray:
    """Texts parted at the spaces that stand before a visible character, which are dropped.

    The tokenizer never joins a character before such a space with what follows, and the
    space goes with the next word; so the ids of a text are those of its parts.
    """
    odd = pc.match_substring_regex(texts, _ODD_SPACE)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    plain = iter(pc.split_pattern(texts.filter(pc.invert(odd)), " ").to_pylist())
    rows = zip(odd.to_pylist(), texts.to_pylist())
    return pa.array([_BEFORE_VISIBLE.split(text) if is_odd else next(plain) for is_odd, text in rows], pa.list_(pa.string()))


def encode_arrays(path: str, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all texts, each followed by ``end``, and where each text's stop.

    Every distinct part is encoded once per batch, and a part after a space once per
    worker as long as it is remembered; the ids are then put together for the whole batch.
    """
    if not len(texts):
        return np.zeros(0, "<u4"), np.zeros(0, np.int64)
    tokenizer, known = _tokenizer(path), _known.setdefault(path, {})
    parts = _parts(texts)
    n, offsets = len(parts), parts.offsets.to_numpy().astype(np.int64)
    offsets, values = offsets - offsets[0], parts.flatten()
    head = np.zeros(len(values), bool)
    head[offsets[:-1]] = True
    tails = values.filter(pa.array(~head)).dictionary_encode()
    words = tails.dictionary.to_pylist()
    new = [w for w in words if w not in known]
    if len(known) + len(new) > MEMORY:
        known.clear()
        new = words
    known.update(zip(new, _word_ids(tokenizer, new)))
    table = [*_ids(tokenizer, values.filter(pa.array(head)).to_pylist()), *map(known.__getitem__, words), end]
    sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
    which = np.empty(len(values), np.int64)
    which[head], which[~head] = np.arange(n), n + tails.indices.to_numpy()
    which = np.insert(which, offsets[1:], len(table) - 1)
    size, start = sizes[which], (np.cumsum(sizes) - sizes)[which]
    stops = np.cumsum(size)
    flat = np.frombuffer(b"".join(table), "<u4")
    ids = flat[np.repeat(start - (stops - size), size) + np.arange(stops[-1])]
    return ids, stops[offsets[1:] + np.arange(n)]


def encode(path: str, texts: list[str]) -> list[bytes]:
    """Token ids of each text as 32-bit numbers."""
    ids, stops = encode_arrays(path, pa.array(texts, pa.string()))
    return [one.tobytes() for one in np.split(ids, stops[:-1])] if len(stops) else []


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of some megabytes together; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
        yield texts.slice(low, high - low)
        low = high


def token_pieces(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``."""
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            low = 0
            for texts in _slices(batch.column(1)):
                tokens, stops = encode_arrays(tokenizer, texts, end)
                docs, low = batch.column(0).slice(low, len(texts)), low + len(texts)
                sizes = np.diff(stops, prepend=0)
                pieces = -(-sizes // length)
                doc = np.repeat(np.arange(len(texts)), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
                first = (stops - sizes)[doc] + start
                last = np.minimum(first + length, stops[doc])
                crcs = [zlib.crc32(tokens[a:b]) for a, b in zip(first.tolist(), last.tolist())]
                columns = [docs.take(pa.array(doc)), pa.array(start), pa.array(last - first), pa.array(crcs, pa.int64()), pa.array(sizes[doc])]
                if with_ids:
                    edges = np.r_[first, stops[-1:]].astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(tokens.astype(np.int32))))
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(cut, schema)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and its offset there.

    A tournament tree holds the free room of bins, the larger of two at each inner node;
    going down to the left wherever there is room enough finds the first bin that fits.
    """
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for item in np.argsort(-sizes, kind="stable"):
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
    return bins, offsets


def pack(pieces: DataFrame, stage: Stage, capacity: int = 2048, group_pieces: int = 4096, seed: int = 17) -> DataFrame:
    """``pieces`` (any columns, with ``length``) and their ``sequence_id`` and ``offset``.

    ``group_pieces`` is the mean size of a group; how many there are follows from a count.
    """
    kept = stage.numbered(pieces, "pieces")
    groups = max(1, -(-kept.count() // group_pieces))
    dealt = kept.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(groups)))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row", ignore_index=True)
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        placed = group.drop(columns=["_row", "_group"])
        return placed.assign(sequence_id=(group["_group"].to_numpy() << 32) + bins, offset=offsets)

    fields = pieces.schema.simpleString()[len("struct<") : -1]
    return dealt.groupBy("_group").applyInPandas(fill, f"{fields},sequence_id:bigint,offset:bigint")


def sequences(packed: DataFrame, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids, doc_ids, lengths``: whole sequences of pieces with ``ids``.

    ``ids`` is padded to ``capacity``. A sequence is bounded, so is what is gathered.
    """
    row = F.struct("offset", "doc_id", "length", "ids")
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("p"))
    ids = F.flatten(F.col("p")["ids"])
    padding = F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.size(ids))
    return held.select(
        "sequence_id",
        F.concat(ids, padding).alias("ids"),
        F.col("p")["doc_id"].alias("doc_ids"),
        F.col("p")["length"].alias("lengths"),
    )
