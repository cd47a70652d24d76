"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Each rendered turn is
reparsed; where the parser does not give the source back, the turn's control strings
are escaped and the turn is parsed again. A conversation whose final text does not
parse into its source turns raises an error. Column expressions only.

Escapes are reversible: in texts and roles ``<``, any backslashes and ``|`` in a row get
one more backslash, so no escaped text holds ``<|``; in roles a line end is written
``%0A`` and ``%`` as ``%25``.

Defined results: null text and null role count as empty; turns with equal numbers are
ordered by role, then text; repeated rows stay separate turns; a null conversation id is
one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns ``array<struct<role, text, body>>`` of a rendered conversation.

    ``body`` is the text as it stands there, still escaped. Null if the text does not
    follow the grammar.
    """
    pieces = F.split(formatted, r"<\|im_start\|>")
    turns = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(F.substring_index(p, "\n", 1).alias("role"), p.alias("piece")),
    )
    parsed = F.transform(
        turns,
        lambda t: F.struct(
            _unescape_role(t["role"]).alias("role"),
            unescape(_body(t["role"], t["piece"])).alias("text"),
            _body(t["role"], t["piece"]).alias("body"),
        ),
    )
    sound = (pieces[0] == "") & F.forall(
        turns,
        lambda t: t["piece"].endswith(END)
        & (F.length(t["piece"]) >= F.length(t["role"]) + 1 + len(END))
        & ~_body(t["role"], t["piece"]).contains(END.strip()),
    )
    return F.when(sound, parsed)


def _body(role: Column, piece: Column) -> Column:
    return F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, turns, loss_spans``.

    ``turns`` are the source turns (role, text); ``loss_spans`` the places of assistant
    texts in ``formatted`` (start from 0, length, in code points). A conversation is one
    row because its text is the result; rows meet by conversation in one shuffle.
    """
    source = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    plain = source.withColumn("_plain", _render(F.col("role"), F.col("text")))
    read = plain.withColumn("_read", parse(F.col("_plain")))
    same = (
        (F.size("_read") == 1)
        & (F.col("_read")[0]["role"] == F.col("role"))
        & (F.col("_read")[0]["text"] == F.col("text"))
    )
    segment = F.when(same, F.col("_plain")).otherwise(_render(_escape_role(F.col("role")), escape(F.col("text"))))
    rendered = read.select("conv_id", "turn", "role", "text", segment.alias("segment"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    head = F.length(F.substring_index("segment", "\n", 1)) + 1
    placed = rendered.select(
        "conv_id",
        F.struct(
            F.row_number().over(order).alias("pos"),
            "role",
            "text",
            "segment",
            (F.coalesce(before, F.lit(0)) + head).alias("start"),
            (F.length("segment") - head - len(END)).cast("long").alias("length"),
        ).alias("t"),
    )
    joined = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    done = joined.select(
        "conv_id",
        F.array_join(F.col("t")["segment"], "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"], x["text"])).alias("turns"),
        F.transform(
            F.filter("t", lambda x: x["role"] == "assistant"), lambda x: F.struct(x["start"], x["length"])
        ).alias("loss_spans"),
    )
    back = done.withColumn("_back", parse(F.col("formatted")))
    proved = F.transform("_back", lambda x: F.struct(x["role"], x["text"])) == F.col("turns")
    return back.select(
        "conv_id",
        F.when(proved, F.col("formatted"))
        .otherwise(F.raise_error(F.lit("a rendered conversation does not parse into its turns")))
        .alias("formatted"),
        "turns",
        "loss_spans",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, loss_text``, all read from the output alone."""
    parsed = formatted.withColumn("_read", parse(F.col("formatted")))
    return parsed.select(
        "conv_id",
        "formatted",
        F.transform("_read", lambda x: F.struct(x["role"], x["text"])).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
            ),
            "",
        ).alias("loss_text"),
    )
