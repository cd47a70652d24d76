"""Survey records: (person, question, answer) made from contacts.

Output of every view: ``van_id, survey_question_id, survey_response_id,
input_type_id, contact_type_id, date_canvassed, contacttimestamp, state_code,
sq_hash``. A record with a part missing has no hash and is left out, so an unknown
answer text or contact type drops the record.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import codes
from fieldloom.functions.hashing import all_present, hash_strict
from fieldloom.functions.zones import local_time

RECORD = [
    "van_id", "survey_question_id", "survey_response_id", "input_type_id", "contact_type_id",
    "date_canvassed", "contacttimestamp", "state_code", "sq_hash",
]


@dataclass(frozen=True)
class SurveySpec:
    """What distinguishes one survey question from another."""

    question_id: int
    answers: Mapping[str, int]
    question_text: str | None = None
    contact_types: Mapping[str, int] = field(default_factory=lambda: codes.CONTACT_TYPES)
    excluded_contact_type: int = codes.DOOR_CANVASS
    id_col: str = "st_myv_van_id"
    only_without: str | None = None


FIRST_CHOICE = SurveySpec(codes.FIRST_CHOICE_QUESTION, codes.FIRST_CHOICE_ANSWERS, codes.FIRST_CHOICE_TEXT)
SECOND_CHOICE = SurveySpec(codes.SECOND_CHOICE_QUESTION, codes.SECOND_CHOICE_ANSWERS, codes.SECOND_CHOICE_TEXT)
VOLUNTEER = SurveySpec(codes.VOLUNTEER_QUESTION, codes.VOLUNTEER_ANSWERS)
SUPPORT = SurveySpec(
    codes.SUPPORT_QUESTION, codes.SUPPORT_ANSWERS, contact_types=codes.SUPPORT_CONTACT_TYPES
)
CAMPAIGN_SUPPORT = SurveySpec(
    codes.SUPPORT_QUESTION,
    codes.SUPPORT_ANSWERS,
    contact_types=codes.SUPPORT_CONTACT_TYPES,
    id_col="st_myc_van_id",
    only_without="st_myv_van_id",
)


def usable_contacts(contacts: DataFrame, spec: SurveySpec, state: str | None = None) -> DataFrame:
    """Contacts with a person id and an exportable contact type, ids split into parts."""
    kept = contacts.where(F.col(spec.id_col).isNotNull())
    if spec.only_without:
        kept = kept.where(F.col(spec.only_without).isNull())
    kept = (
        kept.withColumn("van_id", F.split_part(spec.id_col, F.lit("-"), F.lit(2)))
        .withColumn("state_code", F.upper(F.split_part(spec.id_col, F.lit("-"), F.lit(1))))
        .withColumn("contact_type_id", codes.lookup(F.col("contacttype"), spec.contact_types))
        .where(F.col("contact_type_id") != spec.excluded_contact_type)
    )
    return kept.where(F.col("state_code") == state) if state else kept


def survey_records(answered: DataFrame, spec: SurveySpec) -> DataFrame:
    """Hash and stamp rows that have ``van_id``, ``survey_response_id`` and the contact columns."""
    parts = ["van_id", "survey_question_id", "survey_response_id", "contact_type_id", "contacttimestamp", "state_code"]
    parts = [F.col(p) for p in parts]
    return (
        answered.withColumn("survey_question_id", F.lit(spec.question_id))
        .withColumn("input_type_id", F.lit(codes.INPUT_TYPE_API))
        .where(all_present(*parts))
        .withColumn("sq_hash", hash_strict(*parts))
        .withColumn("date_canvassed", local_time(F.col("state_code"), F.col("contacttimestamp")))
        .select(RECORD)
    )


def survey_view(
    contacts: DataFrame,
    responses: DataFrame,
    questions: DataFrame | None,
    answers: DataFrame,
    spec: SurveySpec,
    state: str | None = None,
) -> DataFrame:
    """Records of one question for all states, or for one.

    Answer ids are looked up on the answer texts and unknown texts go before the
    join, so only answers that can be exported meet the contacts.
    """
    known_answers = (
        answers.withColumn("survey_response_id", codes.lookup(F.col("surveyresponsetext"), spec.answers))
        .where(F.col("survey_response_id").isNotNull())
        .select("surveyresponseid", "survey_response_id")
    )
    given = responses.join(known_answers, "surveyresponseid")
    if spec.question_text is not None:
        asked = questions.where(F.col("surveyquestiontext").ilike(f"%{spec.question_text}%"))
        given = given.join(asked.select("surveyquestionid"), "surveyquestionid")
    people = usable_contacts(contacts, spec, state).select(
        "contactcontact_id", "van_id", "state_code", "contact_type_id", "contacttimestamp"
    )
    return survey_records(people.join(given.select("contactcontact_id", "survey_response_id"), "contactcontact_id"), spec)


def support_view(joined_contacts: DataFrame, spec: SurveySpec = SUPPORT, state: str | None = None) -> DataFrame:
    """Records from contacts that carry their support answer; no join at all."""
    valid = joined_contacts.where(F.col("support_response_text").isin(list(spec.answers)))
    mapped = usable_contacts(valid, spec, state).withColumn(
        "survey_response_id", codes.lookup(F.col("support_response_text"), spec.answers)
    )
    return survey_records(mapped, spec)
