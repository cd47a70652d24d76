"""Lists kept as text, and job ids inside workflow definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_list(column: Column, cast: str | None = None) -> Column:
    """``a,b`` as an array; empty or NULL text as an empty one."""
    parts = F.split(column, ",")
    if cast:
        parts = parts.cast(f"array<{cast}>")
    empty = F.array().cast(f"array<{cast or 'string'}>")
    return F.when(F.length(column) > 0, parts).otherwise(empty)


def list_to_text(column: Column) -> Column:
    return F.array_join(column.cast("array<string>"), ",", "None")


def is_true_text(column: Column) -> Column:
    return F.coalesce(column == "true", F.lit(False))


def job_ids_in(definition: Column) -> Column:
    """What follows each ``job_id: `` in a definition, up to the end of its line."""
    return F.regexp_extract_all(definition, F.lit(r"job_id: ((?:(?!job_id: )[^\n])*)"), 1)


def id_texts(list_text: Column) -> Column:
    """The elements of a stringified list such as ``['1', 'None', None, '-3']``."""
    return F.split(F.translate(list_text, "[]'\" ", ""), ",")


def usable_id(id_text: Column) -> Column:
    """A positive id, NULL for everything else."""
    number = id_text.try_cast("bigint")
    return F.when(number > 0, number)
