"""People who signed up for an event away from home and are unknown in their home state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import codes
from fieldloom.functions.hashing import hash_coalesced
from fieldloom.operators.windows import best_per_key, lowest_per_key
from fieldloom.session import stage_table

# fixed values: the columns of the export, in its order
EXPORT = [
    "first_name", "middle_name", "last_name",
    "address_line_1", "address_line_2", "city", "state_or_province", "zip_or_postal_code", "address_is_preferred",
    "email", "email_is_preferred", "email_is_subscribed", "email_subscription_status",
    "home_phone", "home_phone_is_preferred", "home_phone_opt_in_status",
    "cell_phone", "cell_phone_is_preferred", "cell_phone_opt_in_status",
    "work_phone", "work_phone_is_preferred", "work_phone_opt_in_status",
    "main_phone", "main_phone_is_preferred", "main_phone_opt_in_status",
    "fax_phone", "fax_phone_is_preferred", "fax_phone_opt_in_status",
    "external_id", "external_id_type", "source_external_id", "custom_field_id",
]

# fixed values: the columns in the hash, in its order; the state closes it
HASHED = [
    "first_name", "middle_name", "last_name", "address_line_1", "address_line_2", "city",
    "state_or_province", "zip_or_postal_code", "email", "home_phone", "cell_phone", "work_phone",
    "main_phone", "fax_phone", "source_external_id", "custom_field_id",
]

_PERSON = ["state_code", "myc_van_id"]

_ORDER = [
    "address_line_1", "city", "zip_or_postal_code", "email", "email_is_preferred",
    "main_phone", "main_phone_is_preferred", "first_name", "middle_name", "last_name",
]


def signed_up_people(signups: DataFrame, people: DataFrame, committee_id: int) -> DataFrame:
    """Person records with a signup of the committee; a person's signups count once.

    Signups are reduced to distinct people before they are joined: one person may
    have any number of them.
    """
    attending = signups.where(F.col("created_by_committee_id") == committee_id).select(_PERSON).distinct()
    return attending.join(people, _PERSON)


def with_contact_details(
    people: DataFrame, addresses: DataFrame, emails: DataFrame, phones: DataFrame, committee_id: int
) -> DataFrame:
    """Add the committee's own address (required), email and phone (optional) of each person."""
    ad = addresses.where((F.col("person_committee_id") == committee_id) & F.col("state").isNotNull()).select(
        *_PERSON,
        "contacts_address_id",
        F.col("voting_address").alias("address_line_1"),
        "city",
        F.col("state").alias("state_or_province"),
        F.col("zip").alias("zip_or_postal_code"),
    )
    em = emails.where(F.col("committee_id") == committee_id).select(
        *_PERSON,
        F.col("contacts_email_id").alias("email_id"),
        F.lower("email").alias("email"),
        F.col("is_preferred_email").alias("email_is_preferred"),
    )
    ph = phones.where(F.col("committee_id") == committee_id).select(
        *_PERSON,
        F.col("contacts_phone_id").alias("phone_id"),
        F.col("phone_number").alias("main_phone"),
        F.col("is_preferred_phone").alias("main_phone_is_preferred"),
    )
    return (
        people.join(ad, [*_PERSON, "contacts_address_id"])
        .join(em, [*_PERSON, "email_id"], "left")
        .join(ph, [*_PERSON, "phone_id"], "left")
    )


def unknown_at_home(people: DataFrame, emails: DataFrame) -> DataFrame:
    """Drop people whose email any committee of their home state has, in any case.

    A person without an email cannot be found and stays; each of them gets a key of
    their own, or the join would bring all of them into one task per state.
    """
    known = (
        emails.where(F.col("myc_van_id").isNotNull() & F.col("email").isNotNull())
        .select(F.lower("email").alias("_email"), F.col("state_code").alias("state_or_province"))
        .distinct()
    )
    nobody = F.concat(F.lit("\u0000"), F.col("myc_van_id").cast("string"))
    keyed = people.withColumn("_email", F.coalesce("email", nobody))
    return keyed.join(known, ["_email", "state_or_province"], "left_anti").drop("_email")


def people_view(
    signups: DataFrame,
    people: DataFrame,
    addresses: DataFrame,
    emails: DataFrame,
    phones: DataFrame,
    committee_id: int = codes.COMMITTEE_ID,
    state: str | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """The export columns and ``person_hash``, for one home state or for all of them.

    ``max_records`` keeps that many people per home state, lowest hashes first; people are
    then written once to the shared folder, since they are counted before they are chosen.
    """
    if state:
        addresses = addresses.where(F.col("state") == state)
    found = with_contact_details(
        signed_up_people(signups, people, committee_id), addresses, emails, phones, committee_id
    ).where(F.col("state_code") != F.col("state_or_province"))
    once = best_per_key(
        unknown_at_home(found, emails),
        [*_PERSON, "state_or_province"],
        [F.col(c).asc_nulls_last() for c in _ORDER],
    ).withColumn("source_external_id", F.concat("state_code", F.lit("-"), F.col("myc_van_id").cast("string")))
    have = set(once.columns)
    # one row per person and home state is left, and both are among the columns:
    # a distinct over them would shuffle everything to find nothing
    export = once.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in EXPORT])
    hashed = export.withColumn(
        "person_hash", hash_coalesced(*[F.col(c) for c in HASHED], F.col("state_or_province"))
    )
    if max_records is None:
        return hashed
    staged = stage_table(hashed, "people")
    return lowest_per_key(staged, ["state_or_province"], "person_hash", ["source_external_id"], max_records)
