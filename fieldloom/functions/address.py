"""Postal addresses in one standard spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.functions.text import none_if_empty
from fieldloom.functions.zones import OTHER_SPELLINGS, STATES

# --- fixed values: usual postal abbreviations ---

STREET_WORDS = {
    "ALLEY": "ALY",
    "AVENUE": "AVE",
    "BOULEVARD": "BLVD",
    "CIRCLE": "CIR",
    "COURT": "CT",
    "DRIVE": "DR",
    "EXPRESSWAY": "EXPY",
    "FREEWAY": "FWY",
    "HEIGHTS": "HTS",
    "HIGHWAY": "HWY",
    "LANE": "LN",
    "PARKWAY": "PKWY",
    "PLACE": "PL",
    "PLAZA": "PLZ",
    "ROAD": "RD",
    "SQUARE": "SQ",
    "STREET": "ST",
    "TERRACE": "TER",
    "TRAIL": "TRL",
    "TURNPIKE": "TPKE",
    "NORTH": "N",
    "EAST": "E",
    "SOUTH": "S",
    "WEST": "W",
    "NORTHEAST": "NE",
    "NORTHWEST": "NW",
    "SOUTHEAST": "SE",
    "SOUTHWEST": "SW",
}

UNIT_WORDS = {
    "APARTMENT": "APT",
    "FLOOR": "FL",
    "ROOM": "RM",
    "SUITE": "STE",
}

UNIT_PATTERN = r"^(.+?) (APT|APARTMENT|UNIT|STE|SUITE|FL|FLOOR|RM|ROOM|#) ?([A-Z0-9-]+)$"

# --- end of fixed values ---


def _words(text: Column) -> Column:
    """Upper case, no punctuation but ``#``, ``-`` and ``/``, single blanks, ``#`` on its own."""
    spaced = F.replace(F.upper(text), F.lit("#"), F.lit(" # "))
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[.,;:'\"]", " "), r"\s+", " "))


def _respell(text: Column, words: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(table[w], w)), " ")


def _split_unit(line: Column) -> tuple[Column, Column]:
    """(street line, unit) of an address line; the unit is empty if it has none."""
    has_unit = line.rlike(UNIT_PATTERN)
    street = F.when(has_unit, F.regexp_extract(line, UNIT_PATTERN, 1)).otherwise(line)
    unit = F.when(
        has_unit,
        F.concat_ws(" ", F.regexp_extract(line, UNIT_PATTERN, 2), F.regexp_extract(line, UNIT_PATTERN, 3)),
    ).otherwise("")
    return street, unit


def standard_street(address: Column) -> Column:
    """First line: without its unit, street types and directions abbreviated."""
    return none_if_empty(_respell(_split_unit(_words(address))[0], STREET_WORDS))


def standard_unit(address: Column, unit: Column) -> Column:
    """Second line: the given unit, or else the one at the end of the first line."""
    given = none_if_empty(_words(unit))
    return none_if_empty(_respell(F.coalesce(given, _split_unit(_words(address))[1]), UNIT_WORDS))


def standard_city(city: Column) -> Column:
    return none_if_empty(_words(city))


def standard_state(state: Column) -> Column:
    """Two-letter code of a state name; other text upper-cased as it is."""
    name = F.upper(F.trim(state))
    codes = {full: code for code, full, _ in STATES} | OTHER_SPELLINGS
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return none_if_empty(F.coalesce(table[name], name))


def standard_zip(zip_code: Column) -> Column:
    return none_if_empty(F.regexp_extract(zip_code, r"^\D*(\d{5})", 1))
