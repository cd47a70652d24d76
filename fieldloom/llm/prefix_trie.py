"""Prefix trie of conversations, rolled up band by band of depths.

A node is a distinct sequence of first turns. A turn enters as a digest of its role and
text, so texts never move. The turns of a conversation are cut in blocks of ``band``
turns; a block's digests make the next level's sequence, whose prefixes are found the
same way, and a node's id is a hash of the id before its block and the digests since. No
group holds more than ``band`` rows, however long a conversation is, and there are as
many levels as the longest one has digits to the base of ``band``.

Totals of subtrees: within a band of depths every node is exploded to its ancestors
there, ``band`` at most. The sums at the tops of bands form a trie of their own, rolled
up by the same rule; its completed totals are then handed to the nodes of the band above.
So neither the rounds nor the explosion grow with the depth (rounds do by its logarithm).

Defined results: null role and null text count as empty; turns come in the order of
their number, null first, then of role, then of the digest; repeated rows are turns of
their own; rows without a conversation id belong to no conversation; an empty table has
no nodes, not even a root; texts of any length are hashed whole; other columns are
ignored. The ids that end at a node are hashed in order by one task, which reads them
joined in pieces of a megabyte: a digest of one sequence cannot be split further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage
from fieldloom.operators.windows import numbered

#: Turns of a block, and depths of a band.
BAND = 16
#: Bytes of joined ids in one row.
PIECE_BYTES = 1 << 20
#: The id of the root.
ROOT = b"\0" * 16


def _hash(*parts: Column) -> Column:
    """The first 16 bytes of the SHA-256 of the parts put together."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turn_digest(role: Column, text: Column) -> Column:
    head = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role)
    return _hash(head.cast("binary"), text.cast("binary"))


def place_turns(rows: DataFrame, stage: Stage) -> DataFrame:
    """``conv_id, place, digest, bytes``: the turns of all conversations in one order.

    ``place`` counts on over conversations; ``conversations`` has where each begins.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    return numbered(turns, order, stage.table, "place").drop("turn", "role")


def conversations(placed: DataFrame) -> DataFrame:
    """``conv_id, begins, n_turns``."""
    return placed.groupBy("conv_id").agg(F.min("place").alias("begins"), F.count("*").alias("n_turns"))


def own_turns(placed: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as they are: turns ``conv_id, idx, digest, bytes`` and ``conv_id, n_turns``."""
    turns = placed.join(known, "conv_id").select("conv_id", (F.col("place") - F.col("begins")).alias("idx"), "digest", "bytes")
    return turns, known.select("conv_id", "n_turns")


def lend_first_turns(
    placed: DataFrame, known: DataFrame, lender: Callable[[Column], Column], lent: Callable[[Column], Column], most: int
) -> tuple[DataFrame, DataFrame]:
    """As ``own_turns``, each conversation's first ``lent`` turns being those of its ``lender``.

    A lender with fewer turns gives all it has, one that is not there none; the own turns
    after the first ``lent`` follow. ``lent`` gives ``most`` at most, so a lender's later
    turns are never copied.
    """
    me = F.col("conv_id")
    plan = known.withColumn("_lender", lender(me)).withColumn("_lent", lent(me))
    lenders = known.select(F.col("conv_id").alias("_lender"), F.col("n_turns").alias("_has"))
    plan = plan.join(lenders, "_lender", "left")
    plan = plan.withColumn("_given", F.least("_lent", F.coalesce("_has", F.lit(0))))
    length = F.col("_given") + F.greatest(F.col("n_turns") - F.col("_lent"), F.lit(0))
    plan = plan.withColumn("_length", length).drop("_has", "n_turns")
    at = F.col("place") - F.col("begins")
    mine = placed.join(plan, "conv_id").where(at >= F.col("_lent"))
    mine = mine.select("conv_id", (F.col("_given") + at - F.col("_lent")).alias("idx"), "digest", "bytes")
    begun = known.select(F.col("conv_id").alias("_lender"), "begins")
    first = placed.withColumnRenamed("conv_id", "_lender").join(begun, "_lender").where(at < most)
    first = first.select("_lender", at.alias("idx"), "digest", "bytes")
    given = plan.where("_given > 0").select("conv_id", "_lender", "_given")
    lent_rows = first.join(given, "_lender").where("idx < _given").select("conv_id", "idx", "digest", "bytes")
    return mine.unionByName(lent_rows), plan.select("conv_id", F.col("_length").alias("n_turns"))


def _blocks(turns: DataFrame, longest: int, band: int, stage: Stage, level: int = 0) -> list[DataFrame]:
    """Per level, from the turns up: ``conv_id, block, base, ids, items``.

    ``ids`` are the ids after each item of the block, ``base`` that before the first.
    """
    block = F.floor(F.col("idx") / band)
    made = turns.groupBy("conv_id", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest", "bytes"))).alias("items")
    )
    digests = F.col("items")["digest"]
    full = (F.size("items") == band) & F.element_at(digests, -1).isNotNull()
    if longest < band:
        met, levels = made.withColumn("base", F.lit(ROOT)).withColumn("_id", F.lit(None).cast("binary")), []
    else:
        made = stage.table(made, f"blocks{level}")
        above = made.where((F.col("block") > 0) | full).select(
            "conv_id",
            F.col("block").alias("idx"),
            F.when(full, _hash(F.array_join(F.transform(digests, F.hex), "").cast("binary"))).alias("digest"),
            F.lit(0).cast("long").alias("bytes"),
        )
        levels = _blocks(above, longest // band, band, stage, level + 1)
        ends = _items(levels[0], band).select("conv_id", F.col("idx").alias("block"), F.col("parent").alias("_base"), "id")
        met = made.join(ends.withColumnRenamed("id", "_id"), ["conv_id", "block"], "left")
        met = met.withColumn("base", F.coalesce("_base", F.lit(ROOT))).drop("_base")

    def step(made: Column, item: Column) -> Column:
        one = _hash(made["last"], item["digest"])
        return F.struct(one.alias("last"), F.array_append(made["ids"], one).alias("ids"))

    start = F.struct(F.col("base").alias("last"), F.array().cast("array<binary>").alias("ids"))
    chained = met.withColumn("ids", F.aggregate("items", start, step)["ids"])
    # the level above names the end of a full block
    last = F.when(full, F.coalesce("_id", F.element_at("ids", -1))).otherwise(F.element_at("ids", -1))
    ids = F.concat(F.slice("ids", 1, F.size("ids") - 1), F.array(last))
    done = stage.table(chained.withColumn("ids", ids).select("conv_id", "block", "base", "ids", "items"), f"ids{level}")
    return [done, *levels]


def _items(blocks: DataFrame, band: int) -> DataFrame:
    """``conv_id, idx, id, parent, chain, bytes``; ``chain`` are the ancestors in the band, top first."""
    rows = blocks.select("conv_id", "block", "base", "ids", F.posexplode("items").alias("_j", "item"))
    j = F.col("_j")
    return rows.select(
        "conv_id",
        (F.col("block") * band + j).alias("idx"),
        F.get("ids", j).alias("id"),
        F.when(j == 0, F.col("base")).otherwise(F.get("ids", j - 1)).alias("parent"),
        F.concat(F.array("base"), F.slice("ids", F.lit(1), j)).alias("chain"),
        F.col("item.bytes").alias("bytes"),
    )


def _rollup(values: DataFrame, chains: list[DataFrame], longest: int, band: int, stage: Stage, level: int = 0) -> DataFrame:
    """``id, leaves, saved`` summed over subtrees of ``values`` (id, depth, chain, leaves, saved).

    ``chains`` has ``id, depth, chain`` of the tops of bands, level by level.
    """
    inside = F.when(F.col("depth") % band == 0, F.array("id")).otherwise(F.array_append("chain", F.col("id")))
    sums = values.select(F.explode(inside).alias("id"), "leaves", "saved").groupBy("id")
    sums = sums.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if longest < band:
        return sums
    sums = stage.table(sums, f"sums{level}")
    tops = chains[0].join(sums, "id")
    totals = stage.table(_rollup(tops, chains[1:], longest // band, band, stage, level + 1), f"totals{level}")
    below = values.where((F.col("depth") > 0) & (F.col("depth") % band == 0)).select("id", "chain")
    handed = totals.join(below, "id").select(
        F.explode(F.slice("chain", F.lit(2), F.greatest(F.size("chain") - 1, F.lit(0)))).alias("id"), "leaves", "saved"
    )
    others = sums.join(totals.select("id"), "id", "left_anti").unionByName(handed).groupBy("id")
    others = others.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return totals.unionByName(others)


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, conv_id) as (id, first conv_id, joined conv_ids), a piece at a time."""
    now, first, texts, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        row = [[now], [first], [",".join(texts)]]
        kinds = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["id", "first", "joined"])

    for batch in batches:
        out = []
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if texts and (key != now or size >= PIECE_BYTES):
                out.append(piece())
                texts, size = [], 0
            if not texts:
                now, first = key, conv
            texts.append(str(conv))
            size += len(texts[-1]) + 1
        yield from _together(out)
    if texts:
        yield piece()


def _together(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if pieces:
        yield from pa.Table.from_batches(pieces).combine_chunks().to_batches()


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, first, joined) as (id, digest of all that is joined)."""
    now, running = None, None
    for batch in batches:
        keys, digests = [], []
        for key, joined in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key == now:
                running.update(b"," + joined.encode())
                continue
            if now is not None:
                keys.append(now)
                digests.append(running.hexdigest())
            now, running = key, sha256(joined.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["id", "d"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], names=["id", "d"])


def hash_members(ends: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of ``id, conv_id``: the digest of the conversation ids in order, comma-joined."""
    order = ["id", "conv_id"]
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_join_runs, "id binary, first long, joined string")
    whole = pieces.repartition("id").sortWithinPartitions("id", "first")
    return whole.mapInArrow(_hash_runs, "id binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, stage: Stage, band: int = BAND) -> DataFrame:
    """One row per node of ``turns`` (conv_id, idx from 0, digest, bytes) and ``lengths`` (conv_id, n_turns).

    ``conv_id`` is the smallest member of the node, ``parent_conv_id`` that of its parent;
    ``n_leaves`` and ``saved_bytes`` are sums over the subtree, the second of what later
    members need not hold again; ``ends_sha256`` hashes the members that end there.
    """
    lengths = stage.table(lengths, "lengths")
    longest = lengths.agg(F.max("n_turns")).first()[0] or 0
    levels = _blocks(turns, longest, band, stage)
    reached = _items(levels[0], band).withColumn("depth", F.col("idx") + 1).join(lengths, "conv_id")
    columns = ["id", "depth", "parent", "chain", "bytes", "conv_id", (F.col("depth") == F.col("n_turns")).alias("is_end")]
    nothing = lengths.select(
        F.lit(ROOT).alias("id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("parent"),
        F.array().cast("array<binary>").alias("chain"),
        F.lit(0).cast("long").alias("bytes"),
        "conv_id",
        "n_turns",
    )
    members = reached.select(*columns).unionByName(nothing.select(*columns))
    # all but the last two are the same for every member of a node
    nodes = members.groupBy("id", "depth", "parent", "bytes", "chain").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("is_end").cast("long")).alias("n_ends")
    )
    nodes = stage.table(nodes, "nodes")
    # a node whose members all end there has no children
    own = nodes.select(
        "id",
        "depth",
        "chain",
        (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    root = nodes.where("depth = 0").select("id", "depth", "chain")
    chains = [
        _items(blocks, band).where(F.col("id").isNotNull()).select("id", (F.col("idx") + 1).alias("depth"), "chain").distinct()
        .unionByName(root)
        for blocks in levels[1:]
    ]
    sums = _rollup(own, chains, longest, band, stage)
    child = nodes.where(F.col("parent").isNotNull()).select(F.col("parent").alias("id"), F.lit(1).alias("kids"))
    zero = F.lit(0).cast("long")
    stats = sums.withColumn("kids", zero).unionByName(child.withColumn("leaves", zero).withColumn("saved", zero))
    stats = stats.groupBy("id").agg(
        F.sum("kids").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_bytes")
    )
    above = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hashes = hash_members(members.where("is_end"))
    return (
        nodes.join(stats, "id")
        .join(hashes, "id", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"), "n_ends",
        )
    )
