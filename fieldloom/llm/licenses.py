"""License notices found by an exact containment join of text blocks and templates.

Blocks (lines, by default) and templates are sets of words. Words of the templates are
ordered by how many blocks of the corpus hold them, rarest first. A block that holds at
least ``need = ceil(threshold * size)`` words of a template holds one of the template's
first ``size - need + 1`` words in that order, so joining blocks with these prefixes on
the word finds every such pair. The length filter drops blocks with fewer template words
than ``need``, the positional filter pairs whose places in both orders leave room for
too few common words; what is left is counted exactly. Column expressions only.

Blocks are lines, and what is wrapped over lines: a run of lines with words of which none
holds a template alone. In a run, only words that stand together count: as many in a row, over
a line end, as the template has.

A block gets the labels of all templates it contains, but for those of which another one of
the same family (``FAMILIES``) is contained better and has their words, but for as many as
may lack and one at least (gpl-2 beside gpl-3, which differ by one word): highest containment, then most
common words, then the last label in alphabetical order.

Defined results: null text counts as empty; documents without words or matches are
returned with zero counts, null places and empty labels; repeated rows and repeated ids
give a result row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import NOT_WORD, UPPER, Stage, count_words

# Phrases whose words in a row name a license.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices in common use, by label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
]

# Labels whose notices differ by a word or two, by family; others are their own.
FAMILIES = {"gpl-2": "gpl", "gpl-3": "gpl", "lgpl-3": "gpl", "cc-by": "cc", "cc-by-sa": "cc", "cc-by-nc": "cc", "cc-by-nd": "cc"}

#: ``NOT_WORD`` without the line end.
_NOT_WORD_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def _places(flat: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often the words of ``phrase`` stand in a row, and the first and last start."""
    parts = F.split(F.concat(F.lit(" "), flat, F.lit(" ")), f"(?<= ){phrase}(?= )")
    n = F.size(parts) - 1
    before = count_words(F.trim(parts[0]))
    after = count_words(F.trim(F.element_at(parts, -1)))
    last = count_words(flat) - after - len(phrase.split())
    found = flat.contains(phrase) & (n > 0)
    return F.when(found, n).otherwise(0), F.when(found, before), F.when(found, last)


def _wrapped(run: Column, t_words: Column, length: Column) -> Column:
    """``common, words`` of the ``length`` words in a row, over a line end of ``run``, that hold
    most words of a template; null without any."""
    lines = F.transform(F.split(run, "\n"), lambda line, i: F.transform(F.split(F.trim(line), " "), lambda w: F.struct(w.alias("w"), i.alias("i"))))

    def windows(words: Column) -> Column:
        def window(k: Column) -> Column:
            held = F.slice(words, k, length)
            own = F.array_sort(F.array_intersect(held["w"], t_words))
            over = F.element_at(held, 1)["i"] < F.element_at(held, -1)["i"]
            return F.when(over, F.struct(F.size(own).alias("common"), own.alias("words")))

        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(words)), window))

    # the words are made once for all windows
    return F.element_at(F.transform(F.array(F.flatten(lines)), windows), 1)


def license_scan(
    docs: DataFrame,
    stage: Stage,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = 0.9,
    delimiter: str = "\n",
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base columns come from ``phrases``; ``labels`` adds those of the containment join and
    ``score`` is 1 with a phrase, else the best containment of a block (0 without one).
    ``delimiter`` is the pattern between blocks, lines by default.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, UPPER.lower())
    sets = [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]
    need = {i: math.ceil(threshold * len(s) - 1e-9) for i, _, s in sets}
    vocabulary = sorted({w for _, _, s in sets for w in s})
    length = {i: len(text.split()) for i, (_, text) in enumerate(templates)}

    if delimiter == "\n":  # parts words once for blocks and phrases
        by_line = docs.select("doc_id", F.regexp_replace(lowered, _NOT_WORD_IN_LINE, " ").alias("_lines"))
        flat = F.trim(F.regexp_replace("_lines", " *\n[ \n]*", " "))
        texts = by_line.select("doc_id", F.split("_lines", "\n").alias("_blocks"), flat.alias("_flat"))
    else:
        texts = docs.select(
            "doc_id",
            F.transform(F.split(lowered, delimiter), lambda b: F.regexp_replace(b, NOT_WORD, " ")).alias("_blocks"),
            F.trim(F.regexp_replace(lowered, NOT_WORD, " ")).alias("_flat"),
        )
    places = {p: _places(F.col("_flat"), p) for p in phrases}
    known = F.array(*[F.lit(w) for w in vocabulary])

    def told(b: Column) -> Column:
        return F.struct(F.array_intersect(F.split(F.trim(b), "[ \n]+"), known).alias("tokens"), b.alias("run"))

    def holds(tokens: Column) -> Column:
        each = [F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in s]))) >= need[i] for i, _, s in sets]
        return (F.size(tokens) >= min(need.values())) & F.coalesce(*[F.when(e, True) for e in each], F.lit(False))

    lines = F.transform("_blocks", told)
    unexplained = F.transform("_told", lambda t: F.when(holds(t["tokens"]), "").otherwise(t["run"]))
    # what has no line end is one of the lines
    runs = F.filter(F.split(F.array_join(unexplained, "\n"), r"\n *(?:\n *)+"), lambda r: F.trim(F.translate(r, "\n", " ")) != "")
    runs = F.transform(F.filter(runs, lambda r: r.contains("\n")), told)
    none = F.lit(None).cast("string")
    named = F.array(*[F.when(places[p][0] > 0, F.lit(label)) for p, label in phrases.items()])
    least = [places[p][1] for p in phrases] + [F.lit(None)] * 2
    most = [places[p][2] for p in phrases] + [F.lit(None)] * 2
    alone = F.transform(F.filter("_told", lambda t: F.size(t["tokens"]) > 0), lambda t: F.struct(t["tokens"], none.alias("run")))
    scanned = texts.withColumn("_told", lines).select(
        "doc_id",
        count_words(F.col("_flat")).alias("n_words"),
        sum((places[p][0] for p in phrases), F.lit(0)).cast("long").alias("n_base"),
        F.least(*least).cast("long").alias("first_word"),
        F.greatest(*most).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(named))).alias("_base"),
        F.concat(alone, F.filter(runs, lambda t: holds(t["tokens"]))).alias("_sets"),
    )
    kept = stage.numbered(scanned, "blocks")
    blocks = kept.select("_row", F.posexplode("_sets").alias("_block", "b")).select("_row", "_block", "b.tokens", "b.run")

    # at most one row per template word
    counts = {r[0]: r[1] for r in blocks.select(F.explode("tokens").alias("w")).groupBy("w").count().collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefixes = []
    for i, label, words in sets:
        ordered = sorted(words, key=rank.get)
        family = FAMILIES.get(label, label)
        prefixes += [(w, i, label, family, p, len(words), need[i], length[i], words) for p, w in enumerate(ordered[: len(words) - need[i] + 1])]
    index = spark.createDataFrame(
        prefixes, "word string, template int, label string, family string, t_pos int, t_size int, need int, length int, t_words array<string>"
    )
    ranks = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rank[w])])
    ordered_block = F.array_sort(F.transform("tokens", lambda t: F.struct(ranks[t].alias("rank"), t.alias("word"))))
    probes = (
        blocks.where(F.size("tokens") >= min(need.values()))
        .withColumn("_ordered", ordered_block)
        .select("_row", "_block", "tokens", "run", F.posexplode("_ordered").alias("b_pos", "b"))
        .withColumn("word", F.col("b.word"))
    )
    b_size = F.size("tokens")
    room = F.least(F.col("t_pos"), F.col("b_pos")) + F.least(F.col("t_size") - F.col("t_pos"), b_size - F.col("b_pos"))
    shared = F.array_sort(F.array_intersect("tokens", "t_words"))
    pairs = (
        probes.join(F.broadcast(index), "word")  # the templates: a fixed table
        .where((b_size >= F.col("need")) & (room >= F.col("need")))
        .withColumn("words", shared)
        .where(F.size("words") >= F.col("need"))
        # by another of its words, a pair comes again
        .groupBy("_row", "_block", "template")
        .agg(*[F.first(c).alias(c) for c in ("run", "label", "family", "t_size", "need", "length", "t_words", "words")])
    )
    in_line = F.struct(F.size("words").alias("common"), F.col("words"))
    held = F.when(F.col("run").isNull(), in_line).otherwise(_wrapped(F.col("run"), F.col("t_words"), F.col("length")))
    match = F.struct((F.col("held.common") / F.col("t_size")).alias("part"), F.col("held.common").alias("common"), "label", F.col("held.words").alias("words"), "t_words", "need")
    met = pairs.withColumn("held", held).where(F.col("held.common") >= F.col("need"))
    families = met.groupBy("_row", "_block", "family").agg(F.collect_list(match).alias("ms"))

    def explained(m: Column) -> Column:
        better = lambda o: F.struct(o["part"], o["common"], o["label"]) > F.struct(m["part"], m["common"], m["label"])
        return F.exists("ms", lambda o: better(o) & (F.size(F.array_except(m["words"], o["t_words"])) <= F.greatest(F.lit(1), F.size(m["t_words"]) - m["need"])))

    best = families.select("_row", F.explode(F.filter("ms", lambda m: ~explained(m))).alias("m"))
    found = best.groupBy("_row").agg(F.collect_set("m.label").alias("_found"), F.max("m.part").alias("_part"))
    none = F.array().cast("array<string>")
    return (
        kept.drop("_sets")
        .join(found, "_row", "left")
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join("_base", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_found", none))), ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_part", F.lit(0.0))).alias("score"),
        )
    )
