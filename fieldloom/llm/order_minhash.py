"""Order MinHash: fingerprints that feel edits and moved passages, by SQL functions alone.

A text is read as pieces of at most ``PIECE`` code points without white space; ``k``
pieces in a row are a k-mer, and equal k-mers of a text are numbered in text order. A
hash of (k-mer, number) orders them and, by its first bits, deals them to ``sketches``
parts. Of each part the ``taken`` smallest are selected, put back in text order and
hashed as a tuple; so a tuple agrees between two texts where they share the selected
k-mers *and* hold them in the same order. The likeness of two fingerprints is the share
of equal tuples among the parts that either text fills.

One hash per k-mer serves all parts, and everything happens in arrays of one text:
k-mers are neither shuffled nor compared across texts.

Defined results: a null text is the empty one, which has no k-mers, an empty fingerprint
and likeness 1 to any other without k-mers; fewer than ``k`` pieces are one k-mer; equal
texts have equal fingerprints; texts of any length are read whole; other columns are
ignored. Documents follow each other by id, null first, and by a digest of the text
where ids are equal; rows equal in id and text are one document in that order and each
get its result. A single document follows itself; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Stage
from fieldloom.operators.windows import numbered

#: Code points of a piece at most.
PIECE = 8
#: Pieces of a k-mer, k-mers of a tuple, tuples of a fingerprint (a power of two).
K, TAKEN, SKETCHES = 3, 2, 64

_POSITION_BITS = 31
_HASH_BITS = 32


def _packed(hashed: Column, position: Column) -> Column:
    """The upper half of a hash, then the position, as one long: sorts without structs."""
    high = F.shiftleft(F.shiftrightunsigned(hashed, 64 - _HASH_BITS), _POSITION_BITS)
    return high.bitwiseOR(position.cast("long"))


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, taken: int = TAKEN, sketches: int = SKETCHES) -> DataFrame:
    """``df`` with column ``name``: the tuples of ``text``, each its part's number and 32 bits of hash.

    Every step is a column of its own, since an expression inside a lambda would be
    worked out again for each element.
    """
    if sketches & (sketches - 1):
        raise ValueError("the number of sketches is a power of two")
    shift = _HASH_BITS - (sketches.bit_length() - 1) + _POSITION_BITS
    part = lambda packed: F.shiftright(packed, shift)
    pieces, kmers, ordered, starts, packed = (f"_{name}_{c}" for c in ("pieces", "kmers", "ordered", "starts", "packed"))
    n = F.size(kmers)

    df = df.withColumn(pieces, F.transform(F.regexp_extract_all(text, F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0)), lambda p: F.xxhash64(p)))
    inner = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(pieces) - k, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(pieces, i + j) for j in range(k)]),
    )
    df = df.withColumn(kmers, F.when(F.size(pieces) > 0, inner).otherwise(F.array().cast("array<bigint>"))).drop(pieces)

    # where k-mers repeat: all of them by value and position, and where each value starts
    repeats = F.size(F.array_distinct(kmers)) < n
    by_value = F.sort_array(F.transform(kmers, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(ordered, F.when(repeats, by_value))
    value = lambda j: F.get(ordered, j)["h"]
    firsts = F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (value(j) != value(j - 1)))
    df = df.withColumn(starts, F.when(F.col(ordered).isNotNull(), firsts))
    numbered_runs = F.transform(
        starts,
        lambda s, r: F.transform(
            F.sequence(s, F.coalesce(F.get(starts, r + 1), n) - 1),
            lambda j: _packed(F.xxhash64(value(j), j - s), F.get(ordered, j)["i"]),
        ),
    )
    single = F.transform(kmers, lambda h, i: _packed(F.xxhash64(h, F.lit(0)), i))
    all_packed = F.when(F.col(ordered).isNull(), single).otherwise(F.flatten(numbered_runs))
    df = df.withColumn(packed, F.sort_array(all_packed)).drop(ordered, starts)

    chosen = F.filter(packed, lambda q, i: (i < taken) | (part(F.get(packed, i - taken)) != part(q)))
    df = df.withColumn(packed, chosen)
    begins = F.filter(
        F.sequence(F.lit(0), F.size(packed)), lambda i: (i < F.size(packed)) & ((i == 0) | (part(F.get(packed, i)) != part(F.get(packed, i - 1))))
    )
    df = df.withColumn(starts, begins)

    def tuple_at(i: Column) -> Column:
        own = part(F.get(packed, i))
        same = F.filter(F.slice(packed, i + 1, F.lit(taken)), lambda q: part(q) == own)
        places = F.sort_array(F.transform(same, lambda q: q.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")))
        in_order = F.xxhash64(F.transform(places, lambda p: F.get(kmers, p)))
        return F.shiftleft(own, 32).bitwiseOR(F.shiftrightunsigned(in_order, 32))

    return df.withColumn(name, F.transform(starts, tuple_at)).drop(kmers, packed, starts)


def fingerprint_text(tuples: Column) -> Column:
    """A fingerprint as text: ten hexadecimal digits a tuple."""
    return F.array_join(F.transform(tuples, lambda t: F.lpad(F.hex(t), 10, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Equal tuples among the parts that either fingerprint fills, 0 to 1."""
    parts = lambda tuples: F.transform(tuples, lambda t: F.shiftright(t, 32))
    filled = F.size(F.array_union(parts(one), parts(other)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / filled)


def follow(docs: DataFrame, stage: Stage, id_col: str = "doc_id") -> DataFrame:
    """``_key, doc_id, n_chars, copies, next_key, prev_key, prev_chars`` of each distinct row.

    ``docs`` has ``_key``, the id and ``text``; the last is followed by the first.
    """
    rows = docs.groupBy("_key").agg(
        F.min(id_col).alias("doc_id"), F.min(F.length("text").cast("long")).alias("n_chars"), F.count("*").alias("copies")
    )
    placed = numbered(rows, [F.asc_nulls_first("doc_id"), F.col("_key")], stage.table, "_place")
    n = placed.count()
    if not n:
        nothing = F.lit(None)
        return placed.drop("_place").withColumns({"next_key": nothing.cast("binary"), "prev_key": nothing.cast("binary"), "prev_chars": nothing.cast("long")})
    after = placed.select(F.pmod(F.col("_place") - 1, F.lit(n)).alias("_place"), F.col("_key").alias("next_key"))
    before = placed.select(
        F.pmod(F.col("_place") + 1, F.lit(n)).alias("_place"), F.col("_key").alias("prev_key"), F.col("n_chars").alias("prev_chars")
    )
    return stage.table(placed.join(after, "_place").join(before, "_place").drop("_place"), "links")


def fingerprint_documents(docs: DataFrame, stage: Stage, id_col: str = "doc_id", k: int = K, taken: int = TAKEN, sketches: int = SKETCHES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    In the edited text the last quarter of the code points is replaced by as many from
    the beginning of the next document. Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``, fingerprints as arrays.
    """
    options = {"k": k, "taken": taken, "sketches": sketches}
    text = F.coalesce("text", F.lit(""))
    named = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    rows = docs.select(F.unhex(F.md5(named)).alias("_key"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    links = follow(rows, stage)
    own = rows.groupBy("_key").agg(F.first("text").alias("text")).join(links, "_key")
    heads = own.select(F.col("prev_key").alias("_key"), F.left("text", F.floor(F.col("prev_chars") / 4).cast("int")).alias("_head"))
    kept = F.left("text", (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    both = own.join(heads, "_key").withColumn("_edited", F.concat(kept, "_head"))
    both = both.select("_key", "next_key", "doc_id", "n_chars", "copies", F.sha2("_edited", 256).alias("edited_sha256"), "text", "_edited")
    made = with_fingerprint(both, "text", "fingerprint", **options).drop("text")
    made = with_fingerprint(made, "_edited", "edited_fingerprint", **options).drop("_edited")
    made = stage.table(made, "fingerprints")
    following = made.select(F.col("_key").alias("next_key"), F.col("fingerprint").alias("_next"))
    near = made.join(following, "next_key").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return near.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
