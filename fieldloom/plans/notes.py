"""Free-text notes on people.

Output of every view: ``van_id, text, is_view_restricted, note_category_id,
date_canvassed, contacttimestamp, state_code, note_hash``.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import codes
from fieldloom.functions.hashing import all_present, hash_strict
from fieldloom.functions.zones import local_time
from fieldloom.operators.windows import best_per_key

RECORD = [
    "van_id", "text", "is_view_restricted", "note_category_id", "date_canvassed", "contacttimestamp",
    "state_code", "note_hash",
]


def category_table(spark: SparkSession) -> DataFrame:
    """(note, state_code, note_category_id) for every view and state that has a category."""
    rows = [(n, s, c) for n, states in codes.NOTE_CATEGORIES.items() for s, c in states.items()]
    note, state_code, category = zip(*rows, strict=True)
    return spark.createDataFrame(
        pa.table({"note": note, "state_code": state_code, "note_category_id": pa.array(category, pa.int32())})
    )


def with_category(df: DataFrame, categories: Mapping[str, int]) -> DataFrame:
    """Rows of the states that have a category for the note, with its id."""
    return df.withColumn("note_category_id", codes.lookup(F.col("state_code"), categories)).where(
        F.col("note_category_id").isNotNull()
    )


def notes_view(
    df: DataFrame,
    van_id: Column,
    text: Column,
    state_code: Column,
    categories: Mapping[str, int],
    contacttimestamp: Column | None = None,
    state: str | None = None,
    distinct: bool = False,
    dedupe_batch: bool = False,
) -> DataFrame:
    """Notes from any table, given the expressions for person, text and state.

    The hash covers person, text and state only: rows that differ in their
    timestamp share one, and all of them go out unless ``dedupe_batch`` keeps the
    earliest.
    """
    stamp = F.lit(None) if contacttimestamp is None else contacttimestamp
    notes = df.select(
        van_id.cast("string").alias("van_id"),
        text.alias("text"),
        F.lit(False).alias("is_view_restricted"),
        state_code.alias("state_code"),
        stamp.cast("timestamp_ntz").alias("contacttimestamp"),
    )
    notes = with_category(notes.where(F.col("state_code") == state) if state else notes, categories)
    hashed = [F.col(c) for c in ("van_id", "text", "state_code")]
    notes = notes.where(all_present(*hashed))
    if distinct and not dedupe_batch:
        # before the hash, which follows from the columns compared
        notes = notes.distinct()
    notes = notes.withColumn("note_hash", hash_strict(*hashed))
    if dedupe_batch:
        notes = best_per_key(notes, ["note_hash"], [F.col("contacttimestamp").asc_nulls_last()])
    return notes.withColumn("date_canvassed", local_time(F.col("state_code"), F.col("contacttimestamp"))).select(RECORD)


def donor_text(occupation: Column, employer: Column) -> Column:
    # fixed value: the wording is part of stored hashes
    return F.concat(F.lit("Donor Occupation: "), occupation, F.lit("\n"), F.lit("Employer: "), employer)


def donor_notes(
    donors: DataFrame, crosswalk: DataFrame, state: str | None = None, dedupe_batch: bool = False
) -> DataFrame:
    """Occupation and employer of donors, one note per distinct person, text and payment time."""
    person = F.col("st_myc_van_id")
    return notes_view(
        donors.join(crosswalk, "actionkit_id"),
        van_id=F.split_part(person, F.lit("-"), F.lit(2)),
        text=donor_text(F.col("occupation_clean"), F.col("employer_clean")),
        state_code=F.split_part(person, F.lit("-"), F.lit(1)),
        categories=codes.NOTE_CATEGORIES["donation_profession"],
        contacttimestamp=F.col("paidat"),
        state=state,
        distinct=True,
        dedupe_batch=dedupe_batch,
    )
