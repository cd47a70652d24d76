"""Survey views on hand-made contacts."""

from datetime import datetime

import pytest

from fieldloom.functions import codes
from fieldloom.plans import survey

T = datetime(2024, 7, 1, 3)
CONTACT = "contactcontact_id bigint, st_myv_van_id string, contacttype string, contacttimestamp timestamp_ntz"
JOINED = (
    "st_myv_van_id string, st_myc_van_id string, support_response_text string, contacttype string,"
    " contacttimestamp timestamp_ntz"
)


@pytest.fixture
def view(rows):
    responses = rows(
        "contactcontact_id bigint, surveyquestionid bigint, surveyresponseid bigint",
        *[(i, 1, 10) for i in range(1, 9)], (9, 1, 11), (10, 2, 10), (11, 1, 10), (11, 3, 10),
    )
    questions = rows(
        "surveyquestionid bigint, surveyquestiontext string",
        (1, "the CANDIDATE interest first choice?"), (2, "Other question"), (3, "Candidate Interest First Choice"),
    )
    answers = rows("surveyresponseid bigint, surveyresponsetext string", (10, "Beto"), (11, "Nobody known"))
    contacts = rows(
        CONTACT,
        (1, "il-77", "spoke", T),
        (2, "IL-78", "myc_phone", T),
        (3, "IL-79", "bern_app_door_canvass", T),
        (4, None, "spoke", T),
        (5, "ZZ-80", "spoke", T),
        (6, "IL-81", "spoke", None),
        (7, "IL", "spoke", T),
        (8, "tx-82", "bern_app_relational", T),
        (9, "IL-83", "spoke", T),
        (10, "IL-84", "spoke", T),
        (11, "ny-85", "spoke", T),
    )
    return lambda **kw: survey.survey_view(contacts, responses, questions, answers, survey.FIRST_CHOICE, **kw)


def test_incomplete_records_are_left_out(view):
    got = [(r.van_id, r.state_code) for r in view().collect()]
    # a contact asked twice is there twice; a person id without a second part stays, with empty text
    assert sorted(got) == [("", "IL"), ("77", "IL"), ("80", "ZZ"), ("82", "TX"), ("85", "NY"), ("85", "NY")]


def test_record(view, rows):
    import hashlib

    (r,) = view(state="TX").collect()
    assert r.survey_question_id == 349867 and r.survey_response_id == 1439370
    assert r.input_type_id == 11 and r.contact_type_id == 131
    assert r.date_canvassed == datetime(2024, 6, 30, 22)
    assert r.sq_hash == hashlib.md5(b"8234986714393701312024-07-01 03:00:00TX").hexdigest()


def test_unknown_zone_keeps_the_record(view):
    (r,) = view(state="ZZ").collect()
    assert r.date_canvassed is None and r.sq_hash


def test_state_run_is_a_part_of_all(view):
    everything = {tuple(r) for r in view().collect()}
    assert everything == {tuple(r) for s in ("IL", "ZZ", "TX", "NY") for r in view(state=s).collect()}


def test_support_and_campaign_ids(rows):
    joined = rows(
        JOINED,
        ("IL-1", "IL-9", "3 - Undecided", "quickbase", T),
        (None, "IL-8", "3 - Undecided", "quickbase", T),
        (None, "IL-7", "Refused", "quickbase", T),
        (None, None, "3 - Undecided", "quickbase", T),
    )
    assert [r.van_id for r in survey.support_view(joined).collect()] == ["1"]
    (r,) = survey.support_view(joined, survey.CAMPAIGN_SUPPORT).collect()
    assert (r.van_id, r.contact_type_id) == ("8", 145)


def test_volunteers_need_no_question(rows):
    contacts = rows(CONTACT, (1, "IL-1", "getthru_dialer", T))
    responses = rows("contactcontact_id bigint, surveyresponseid bigint", (1, 5), (1, 6))
    answers = rows("surveyresponseid bigint, surveyresponsetext string", (5, "Volunteer Maybe"), (6, "volunteer maybe"))
    (r,) = survey.survey_view(contacts, responses, None, answers, survey.VOLUNTEER).collect()
    assert r.survey_response_id == codes.VOLUNTEER_ANSWERS["Volunteer Maybe"]
