"""Normal forms of personal fields, and the keys that two records may share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.functions.text import none_if_empty

SEPARATOR = "\u001f"


def _name(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def _lower(c: Column) -> Column:
    return F.translate(F.lower(F.trim(c)), SEPARATOR, "")


def _address(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


#: Country prefix that a number of this many further digits is written with or without.
PHONE_PREFIX, PHONE_DIGITS = "1", 10


def _phone(c: Column) -> Column:
    """All digits, without the country prefix of a home number."""
    return F.regexp_replace(F.regexp_replace(c, r"\D", ""), rf"^{PHONE_PREFIX}(?=\d{{{PHONE_DIGITS}}}$)", "")


_NORMAL = {
    "first_name": _name,
    "middle_name": _name,
    "last_name": _name,
    "phone": _phone,
    "email": _lower,
    "full_address": _address,
    "street": _address,
    "city": _name,
    "zip": lambda c: F.left(F.regexp_replace(c, r"\D", ""), F.lit(5)),
}


def normal(field: str, column: Column) -> Column:
    """The form in which a field is compared; empty text is no value."""
    return none_if_empty(_NORMAL.get(field, _lower)(column.cast("string")))


def one_letter_less(text: Column, made: Callable[[Column], Column] = lambda form: form) -> Column:
    """The text itself and every text it becomes by losing one letter, each put through ``made``.

    Two names have such a form in common if one slip (a letter missing, added or
    replaced, or two neighbours swapped) turns one into the other. That makes a
    tolerant comparison an equality join. A single letter has no shorter form.
    """
    length = F.length(text)
    cut = F.sequence(F.when(length > 1, 1).otherwise(2), length + 1)
    return F.transform(cut, lambda i: made(F.concat(F.left(text, i - 1), F.substr(text, i + 1))))


#: Names up to this length are indexed by what two dropped letters leave of them, longer ones by halves.
WHOLE_NAME = 16


def two_letters_less(text: Column) -> Column:
    """The text itself and every text it becomes by losing one or two letters.

    Two texts that are at most two letters apart have such a form in common. A text of n
    letters has 1 + n + n(n-1)/2 of them at most.
    """
    length = F.length(text)
    # a second place behind the last letter stands for one letter lost
    pairs = F.transform(
        F.sequence(F.lit(1), length),
        lambda i: F.transform(
            F.sequence(i + 1, length + 1),
            lambda j: F.concat(F.left(text, i - 1), F.substr(text, i + 1, j - i - 1), F.substr(text, j + 1)),
        ),
    )
    return F.array_distinct(F.concat(F.array(text), F.flatten(pairs)))


def _halves(text: Column, cut: Column) -> Column:
    """What one dropped letter leaves of the text before and behind the cut, each marked by its side."""
    before = one_letter_less(F.left(text, cut), lambda form: F.concat(F.lit("<"), form))
    behind = one_letter_less(F.substr(text, cut + 1), lambda form: F.concat(F.lit(">"), form))
    return F.concat(before, behind)


def name_keys(name: Column) -> Column:
    """Keys that a name is indexed by; it shares one with ``name_probes`` of any name two letters apart.

    Of two edits at most one falls on one of two halves. So a name longer than
    ``WHOLE_NAME`` needs only what one letter less leaves of either half: n + 2 keys for n
    letters, where the whole would have n(n+1)/2 + 1. No name is left out or shortened.
    """
    length = F.length(name)
    halves = _halves(name, F.floor(length / 2).cast("int"))
    return _digests(F.when(length <= WHOLE_NAME, two_letters_less(name)).otherwise(halves))


def name_probes(name: Column) -> Column:
    """Keys to look a name up by: those of any name within two letters of it, however that is indexed.

    Such a name is up to two letters longer or shorter, and its middle up to two letters
    off from the same place in this one.
    """
    length = F.length(name)
    middle = lambda n: F.floor(n / 2).cast("int")
    cuts = F.sequence(F.greatest(middle(length - 2) - 2, F.lit(1)), F.least(middle(length + 2) + 2, length - 1))
    whole = F.when(length - 2 <= WHOLE_NAME, two_letters_less(name)).otherwise(F.array().cast("array<string>"))
    halves = F.when(length + 2 > WHOLE_NAME, F.flatten(F.transform(cuts, lambda c: _halves(name, c))))
    return _digests(F.concat(whole, F.coalesce(halves, F.array().cast("array<string>"))))


def _digests(forms: Column) -> Column:
    return F.array_distinct(F.transform(forms, lambda f: F.unhex(F.md5(f))))


def part(field: Column, how: str) -> Column:
    """The form of a normal field that two records must share."""
    if how == "exact":
        return field
    if how.startswith("prefix"):
        return F.left(field, F.lit(int(how[len("prefix"):])))
    raise ValueError(f"unknown comparison: {how}")
