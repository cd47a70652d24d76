"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = "\u0001 "


def initcap_words(column: Column) -> Column:
    """Capitalise every run of letters and digits, so also after ``-`` and ``'``.

    The built-in breaks words at blanks only. A marked blank after every other
    separator makes it break there too, and is taken out again.
    """
    marked = F.regexp_replace(column, r"([^\p{L}\p{N}])", "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def none_if_empty(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def same_text(left: Column, right: Column) -> Column:
    """Equality in any case. A plain comparison: data is never used as a pattern."""
    return F.lower(left) == F.lower(right)


def fits(column: Column, length: int) -> Column:
    """Cut to ``length`` characters, as a cast to a sized text type does in a warehouse."""
    return F.left(column.cast("string"), F.lit(length))


def seconds_to_text(seconds: Column, as_clock: bool = False) -> Column:
    """A duration in words (``1 hour, 2 minutes``) or as clock text."""
    secs = seconds.cast("double")
    days, within = F.floor(secs / 86400), F.pmod(secs, F.lit(86400.0))
    hours, minutes, rest = F.floor(within / 3600), F.floor(F.pmod(within, F.lit(3600.0)) / 60), F.pmod(within, F.lit(60.0))

    def counted(count: Column, text: Column, unit: str) -> Column:
        return F.when(count != 0, F.concat(text, F.when(count == 1, f" {unit}").otherwise(f" {unit}s")))

    rest_text = F.format_string("%.4f", rest)
    day_words = counted(days, days.cast("string"), "day")
    if as_clock:
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        parts = [
            day_words,
            F.when(hours != 0, two(hours)),
            F.when(minutes != 0, two(minutes)).otherwise("00"),
            F.when(rest != 0, rest_text).otherwise("00"),
        ]
        text = F.concat_ws(":", *parts)
    else:
        parts = [
            day_words,
            counted(hours, hours.cast("string"), "hour"),
            counted(minutes, minutes.cast("string"), "minute"),
            counted(rest, rest_text, "second"),
        ]
        text = F.concat_ws(", ", *parts)
    return F.when(secs.isNotNull(), text)
