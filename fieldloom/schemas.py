"""Declared schemas of logs and JSON inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _TEXT, _FLAG, _TIME = (
    T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampNTZType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- fixed values: columns of the logs and of the JSON inputs, as stored tables have them ---

SURVEY_LOG = struct(
    myv_van_id=_LONG,
    survey_question_id=_LONG,
    survey_response_id=_LONG,
    input_type_id=_LONG,
    contact_type_id=_LONG,
    date_canvassed=_TIME,
    contacttimestamp=_TIME,
    state_code=_TEXT,
    sq_hash=_TEXT,
    loaded=_FLAG,
)

PEOPLE_LOG = struct(
    first_name=_TEXT,
    middle_name=_TEXT,
    last_name=_TEXT,
    address_line_1=_TEXT,
    address_line_2=_TEXT,
    city=_TEXT,
    state_or_province=_TEXT,
    email=_TEXT,
    home_phone=_TEXT,
    cell_phone=_TEXT,
    main_phone=_TEXT,
    source_external_id=_TEXT,
    person_hash=_TEXT,
    loaded=_FLAG,
)

NOTES_LOG = struct(
    myc_van_id=_LONG,
    text=_TEXT,
    is_view_restricted=_FLAG,
    note_category_id=_INT,
    contacttimestamp=_TIME,
    date_canvassed=_TIME,
    state_code=_TEXT,
    note_hash=_TEXT,
    loaded=_FLAG,
)

SCHEDULE = struct(scheduled=_FLAG, scheduled_days=T.ArrayType(_INT), scheduled_hours=T.ArrayType(_INT))

RUN = struct(state=_TEXT, started_at=_TEXT, finished_at=_TEXT)

WORKFLOW = struct(
    id=_LONG, name=_TEXT, state=_TEXT, user=struct(name=_TEXT), schedule=SCHEDULE, definition=_TEXT
)

JOB = struct(id=_LONG, name=_TEXT, type=_TEXT, state=_TEXT, runs=T.ArrayType(RUN), schedule=SCHEDULE)

# --- end of fixed values ---
