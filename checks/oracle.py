"""The SQL that each registered query is compared with, written independently of it.

Only fixed value tables (codes, zones) are shared with the library.
"""

from __future__ import annotations

from collections.abc import Mapping

from checks import queries
from checks.inputs import with_inputs
from fieldloom.functions import codes, zones
from fieldloom.plans import people

ORACLE: dict[str, str] = {}


def sql(name: str, inputs: list[str], body: str, /, **extra: str) -> None:
    ORACLE[name] = with_inputs(inputs, body, **extra)


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _case(column: str, table: Mapping[str, int]) -> str:
    whens = " ".join(f"WHEN {_quoted(k)} THEN {v}" for k, v in table.items())
    return f"CASE {column} {whens} END"


def _zone(state: str) -> str:
    names = [(n, z) for code, name, z in zones.STATES for n in (code, name)]
    names.append(("D.C.", "US/Eastern"))
    return f"CASE upper({state}) " + " ".join(f"WHEN '{n}' THEN '{z}'" for n, z in names) + " END"


def _at(ts: str, zone: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC' AT TIME ZONE ({zone}))"


def _local(state: str, ts: str) -> str:
    return f"CASE WHEN {_zone(state)} IS NOT NULL THEN {_at(ts, _zone(state))} END"


def _initcap(x: str) -> str:
    pieces = f"regexp_extract_all(lower({x}), '[a-z0-9]+|[^a-z0-9]+')"
    return f"array_to_string(list_transform({pieces}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')"


# --- scans, sinks, catalog ---------------------------------------------------------------

sql("src_scan", [], "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
sql("src_param_sql", [], "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000")
sql("sink_replace", [], "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
sql("ctas_keyed_layout", [], "SELECT o_custkey, o_orderkey, o_orderdate FROM orders")
sql("join_keyed", [], "SELECT c_custkey AS o_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
sql("sink_csv", [], "SELECT c_custkey, c_name, c_mktsegment FROM customer")
sql(
    "catalog_exists",
    [],
    """SELECT count(*) AS table_rows, 'catalog_orders' AS table_name FROM orders
       UNION ALL SELECT count(*), 'catalog_customer' FROM customer""",
)
sql("union_nonempty", [], "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
sql(
    "filled_tables",
    [],
    "SELECT 'lines_of_' || lower(l_returnflag) AS table_name, count(*) AS table_rows FROM lineitem GROUP BY l_returnflag",
)
sql(
    "agg_count_diff",
    [],
    """SELECT l.n AS left_rows, o.n AS right_rows, abs(l.n - o.n) AS difference
       FROM (SELECT count(*) AS n FROM lineitem) l, (SELECT count(*) AS n FROM orders) o""",
)

# --- column functions ----------------------------------------------------------------------

sql(
    "fn_string",
    [],
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS part_2, split_part(o_orderpriority, '-', 3) AS part_3,
              lower(o_orderpriority) AS low, upper(left(o_orderpriority, 3)) AS head, substr(o_orderpriority, 3) AS tail,
              CAST(length(o_orderpriority) AS INTEGER) AS len, CAST(instr(o_orderpriority, 'O') AS INTEGER) AS first_o,
              left(o_orderpriority, 5) AS cut, nullif(split_part(o_orderpriority, '-', 3), '') AS no_part
       FROM orders""",
)
_title = "replace(p_name, ' ', '-') || ' o''' || lower(p_type)"
sql("fn_initcap", [], f"SELECT p_partkey, {_initcap(_title)} AS title FROM part")
sql(
    "fn_regex",
    [],
    """SELECT c_custkey, regexp_replace(lower(c_name), '[a-z#]|0{2}', '', 'g') AS stripped,
              regexp_extract(c_name, '[1-9][0-9]*$', 0) AS number, nullif(regexp_extract(c_name, '^[0-9]+', 0), '') AS leading
       FROM customer""",
)
sql(
    "fn_lists",
    [],
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END::BIGINT AS items,
              CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey + o_orderkey END AS total,
              CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_custkey || ',' || o_orderkey END AS again,
              o_orderstatus = 'O' AS flag
       FROM orders""",
)
sql(
    "fn_date_formats",
    [],
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS yyyy_mm_dd, strftime(ts, '%Y-%m-%d %H:%M:%S') AS yyyy_mm_dd_hh_mm_ss,
              strftime(ts, '%Y%m%d') AS yyyymmdd, strftime(ts, '%Y%m%d_%H%M%S') AS yyyymmdd_hhmmss, ts AS raw
       FROM events""",
)
_REPORT = {"utc": "UTC", "est": "US/Eastern", "cst": "US/Central", "pst": "US/Pacific"}
_local_columns = ", ".join(
    f"{_at('ts', repr(z))} AS datetime_{n}, CAST({_at('ts', repr(z))} AS DATE) AS date_{n}" for n, z in _REPORT.items()
)
sql("fn_local_date", [], f"SELECT event_id, {_local_columns} FROM events")


def _words(s: str) -> str:
    def unit(count: str, shown: str, name: str) -> str:
        return f"CASE WHEN {count} <> 0 THEN {shown} || ' {name}' || CASE WHEN {count} = 1 THEN '' ELSE 's' END END"

    d, h, m, r = _parts(s)
    parts = [unit(d, f"CAST({d} AS VARCHAR)", "day"), unit(h, f"CAST({h} AS VARCHAR)", "hour")]
    parts += [unit(m, f"CAST({m} AS VARCHAR)", "minute"), unit(r, f"printf('%.4f', {r})", "second")]
    return f"concat_ws(', ', {', '.join(parts)})"


def _clock(s: str) -> str:
    d, h, m, r = _parts(s)
    return f"""concat_ws(':', CASE WHEN {d} <> 0 THEN CAST({d} AS VARCHAR) || CASE WHEN {d} = 1 THEN ' day' ELSE ' days' END END,
        CASE WHEN {h} <> 0 THEN printf('%02d', {h}) END, printf('%02d', {m}),
        CASE WHEN {r} <> 0 THEN printf('%.4f', {r}) ELSE '00' END)"""


def _parts(s: str) -> tuple[str, str, str, str]:
    d = f"CAST(floor({s} / 86400) AS BIGINT)"
    h = f"CAST(floor(({s} - {d} * 86400) / 3600) AS BIGINT)"
    m = f"CAST(floor(({s} - {d} * 86400 - {h} * 3600) / 60) AS BIGINT)"
    return d, h, m, f"CAST({s} - {d} * 86400 - {h} * 3600 - {m} * 60 AS DOUBLE)"


sql(
    "fn_duration_text",
    [],
    f"""SELECT event_id, {_words('secs')} AS words, {_clock('secs')} AS clock,
               {_words('odd')} AS odd_words, {_clock('odd')} AS odd_clock
        FROM (SELECT event_id, (event_id * 397) % 400000 AS secs, floor(value * 100) / 4 AS odd FROM events)""",
)
sql(
    "filter_hhmm",
    [],
    "SELECT event_id, ts FROM events WHERE CAST(strftime(ts, '%H%M') AS INTEGER) - 400 BETWEEN 600 AND 1330",
)
sql(
    "filter_local_hhmm",
    [],
    f"""SELECT event_id, ts FROM events
        WHERE CAST(strftime({_at('ts', "'US/Eastern'")}, '%H%M') AS INTEGER) BETWEEN 600 AND 1330""",
)
sql(
    "tz_local_time",
    ["contact"],
    f"""SELECT contactcontact_id, state, {_zone('state')} AS zone, {_local('state', 'contacttimestamp')} AS local_time
        FROM (SELECT *, split_part(st_myv_van_id, '-', 1) AS state FROM contact)""",
)
sql(
    "hash_strict",
    ["contact"],
    """SELECT contactcontact_id, md5(st_myv_van_id || CAST(contacttimestamp AS VARCHAR) || contacttype) AS record_hash
       FROM contact""",
)
sql(
    "hash_coalesced",
    ["contact"],
    """SELECT contactcontact_id, md5(coalesce(st_myv_van_id, 'missing') || coalesce(contacttype, 'missing') || 'IL') AS record_hash
       FROM contact""",
)
sql(
    "cast_project",
    [],
    """SELECT CAST(split_part('IL-' || o_custkey, '-', 2) AS BIGINT) AS van_id, CAST(o_orderdate AS DATE) AS day,
              o_orderdate AS stamp, left(o_orderpriority || '/' || o_orderstatus, 10) AS cut
       FROM orders""",
)
sql("pii_project", ["match_source"], "SELECT pk, fname, lname, email, addr, city, state, zip FROM match_source")

# --- survey records ----------------------------------------------------------------------

_support = f"{_case('support_response_text', codes.SUPPORT_ANSWERS)}"
sql(
    "value_map",
    ["joined_contact"],
    f"""SELECT support_response_text, contacttype, {_support} AS survey_response_id,
               {_case('contacttype', codes.SUPPORT_CONTACT_TYPES)} AS contact_type_id FROM joined_contact""",
)
sql("filter_ilike", [], "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%ED W%'")
_valid = ", ".join(_quoted(t) for t in codes.SUPPORT_ANSWERS)
sql(
    "filter_inlist",
    ["joined_contact"],
    f"SELECT st_myc_van_id, support_response_text FROM joined_contact WHERE support_response_text IN ({_valid})",
)

_CHAIN_INPUTS = ["contact", "response", "question", "answer"]
_ANSWERED = """contact JOIN response USING (contactcontact_id) JOIN question USING (surveyquestionid)
               JOIN answer USING (surveyresponseid)"""
sql(
    "join_inner_chain",
    _CHAIN_INPUTS,
    f"SELECT contactcontact_id, contacttype, surveyquestiontext, surveyresponsetext FROM {_ANSWERED}",
)


def _values(table: Mapping[str, int], alias: str) -> str:
    return "(VALUES " + ", ".join(f"({_quoted(k)}, {v})" for k, v in table.items()) + f") {alias}"


def _records(
    question: int,
    rows: str,
    id_col: str,
    text: str,
    answers: Mapping[str, int],
    kinds: Mapping[str, int],
    where: str = "true",
) -> str:
    """Records by joining code tables; whatever has no code or no time stamp joins nothing."""
    exported = {k: v for k, v in kinds.items() if v != 2}
    return f"""
        SELECT van_id, {question} AS survey_question_id, answer_code AS survey_response_id, 11 AS input_type_id,
               kind_code AS contact_type_id, {_local('state_code', 'contacttimestamp')} AS date_canvassed,
               contacttimestamp, state_code,
               md5(concat(van_id, '{question}', answer_code, kind_code, contacttimestamp, state_code)) AS sq_hash
        FROM (SELECT *, string_split({id_col}, '-')[2] AS van_id, upper(string_split({id_col}, '-')[1]) AS state_code
              FROM {rows}) r
        JOIN {_values(answers, 'known(answer_text, answer_code)')} ON {text} = answer_text
        JOIN {_values(exported, 'kinds(kind, kind_code)')} ON contacttype = kind
        WHERE {where} AND {id_col} IS NOT NULL AND contacttimestamp IS NOT NULL"""


def _choice(question: int, text: str, answers: Mapping[str, int]) -> str:
    asked = f"contains(lower(surveyquestiontext), '{text}')"
    return _records(
        question, _ANSWERED, "st_myv_van_id", "surveyresponsetext", answers, codes.CONTACT_TYPES, asked
    )


_FIRST_CHOICE = _choice(349867, "candidate interest first choice", codes.FIRST_CHOICE_ANSWERS)
_VOLUNTEER_ROWS = "contact JOIN response USING (contactcontact_id) JOIN answer USING (surveyresponseid)"
sql("view_survey", _CHAIN_INPUTS, _FIRST_CHOICE)
sql(
    "view_survey_second",
    _CHAIN_INPUTS,
    _choice(349875, "candidate interest second choice", codes.SECOND_CHOICE_ANSWERS),
)
sql(
    "view_volunteer",
    _CHAIN_INPUTS,
    _records(
        349878, _VOLUNTEER_ROWS, "st_myv_van_id", "surveyresponsetext", codes.VOLUNTEER_ANSWERS, codes.CONTACT_TYPES
    ),
)


def _support_records(id_col: str, where: str) -> str:
    return _records(
        349811, "joined_contact", id_col, "support_response_text", codes.SUPPORT_ANSWERS,
        codes.SUPPORT_CONTACT_TYPES, where,
    )


_SUPPORT_VIEW = _support_records("st_myv_van_id", "true")
sql("view_support", ["joined_contact"], _SUPPORT_VIEW)
sql("view_myc_only", ["joined_contact"], _support_records("st_myc_van_id", "st_myv_van_id IS NULL"))
_QUEUES = """SELECT van_id, survey_question_id, survey_response_id, input_type_id, contact_type_id, date_canvassed,
              state_code || '_sqs_current_load' AS queue, state_code || '_sqs_current_load_r' AS response_table
       FROM records"""
sql("export_queue", _CHAIN_INPUTS, _QUEUES, records=_FIRST_CHOICE)
_BY_RUN = _QUEUES.replace("\n       FROM records", ", {} AS run\n       FROM records")
sql(
    "export_queue_runs",
    _CHAIN_INPUTS,
    _BY_RUN.format("CASE state_code WHEN 'IL' THEN 'run_a' ELSE 'run_b' END") + " WHERE state_code IN ('IL', 'NY')",
    records=_FIRST_CHOICE,
)

# --- loads -----------------------------------------------------------------------------------

_LOG_COLUMNS = """CAST(van_id AS BIGINT) AS myv_van_id, CAST(survey_question_id AS BIGINT) AS survey_question_id,
    CAST(survey_response_id AS BIGINT) AS survey_response_id, CAST(input_type_id AS BIGINT) AS input_type_id,
    CAST(contact_type_id AS BIGINT) AS contact_type_id, date_canvassed, contacttimestamp, state_code, sq_hash"""
_LOG = f"""SELECT {_LOG_COLUMNS},
                  CASE WHEN contacttimestamp < TIMESTAMP '{queries.LOADED_BEFORE}' THEN true
                       WHEN survey_response_id % 2 = 0 THEN false END AS loaded
           FROM records WHERE contacttimestamp < TIMESTAMP '{queries.TRIED_BEFORE}'"""
_NEW = "SELECT * FROM records ANTI JOIN (FROM log WHERE loaded) done USING (sq_hash)"
_STEPS = {"records": _SUPPORT_VIEW, "log": _LOG, "fresh": _NEW}
_PENDING = f"SELECT * FROM log UNION ALL SELECT {_LOG_COLUMNS}, false FROM fresh"

sql("load_survey_new", ["joined_contact"], "SELECT * FROM fresh", **_STEPS)
sql("load_log_pending", ["joined_contact"], _PENDING, **_STEPS)
sql(
    "load_log_mark",
    ["joined_contact"],
    """SELECT pending.* REPLACE (coalesce(done, loaded) AS loaded)
       FROM pending LEFT JOIN (SELECT DISTINCT sq_hash, true AS done FROM fresh) marks USING (sq_hash)""",
    **_STEPS,
    pending=_PENDING,
)
sql("load_semi_attempts", ["joined_contact"], "SELECT * FROM log WHERE sq_hash IN (SELECT sq_hash FROM fresh)", **_STEPS)
for _name in ("load_cycle_second_run", "load_compacted"):
    sql(
        _name,
        ["joined_contact"],
        f"""SELECT {_LOG_COLUMNS}, true AS loaded, '1' AS run_id FROM early
            UNION ALL SELECT {_LOG_COLUMNS}, true, '2' FROM records WHERE sq_hash NOT IN (SELECT sq_hash FROM early)""",
        records=_SUPPORT_VIEW,
        early=f"SELECT * FROM records WHERE contacttimestamp < TIMESTAMP '{queries.LOADED_BEFORE}'",
    )

_THIRD = f"""CASE WHEN contacttimestamp < TIMESTAMP '{queries.LOADED_BEFORE}' THEN '1'
                  WHEN contacttimestamp < TIMESTAMP '{queries.TRIED_BEFORE}' THEN '2' ELSE '3' END"""
_ANSWERING = ", ".join(map(_quoted, queries.ANSWERING))
_TAKEN_IN = f"({_THIRD} = '1' OR {_THIRD} = '2' AND state_code IN ({_ANSWERING}))"
sql(
    "load_receipts",
    ["joined_contact"],
    f"SELECT {_LOG_COLUMNS}, {_TAKEN_IN} AS loaded, {_THIRD} AS run_id FROM records",
    records=_SUPPORT_VIEW,
)
sql("export_receipts", ["joined_contact"], _BY_RUN.format(f"'run_' || {_THIRD}"), records=_SUPPORT_VIEW)
sql(
    "export_manifest",
    ["joined_contact"],
    f"""SELECT {_THIRD} AS run_id, state_code || '_sqs_current_load' AS queue,
               state_code || '_sqs_current_load_r' AS response_table, count(*) AS rows,
               CASE WHEN {_TAKEN_IN} THEN 'answered' ELSE 'sent' END AS state
        FROM records GROUP BY ALL""",
    records=_SUPPORT_VIEW,
)
sql(
    "load_stream",
    ["joined_contact"],
    f"SELECT {_LOG_COLUMNS}, true AS loaded FROM records",
    records=_SUPPORT_VIEW,
)

# --- people ------------------------------------------------------------------------------------

_PEOPLE = ["signup", "person_record", "address", "email", "phone"]
_LOCATED = {
    "attending": "SELECT state_code, myc_van_id FROM signup WHERE created_by_committee_id = 73296 GROUP BY ALL",
    "own_address": """SELECT state_code, myc_van_id, contacts_address_id, voting_address AS address_line_1, city,
                             state AS state_or_province, zip AS zip_or_postal_code
                      FROM address WHERE person_committee_id = 73296 AND state IS NOT NULL""",
    "own_email": """SELECT state_code, myc_van_id, contacts_email_id AS email_id, lower(email) AS email,
                           is_preferred_email AS email_is_preferred FROM email WHERE committee_id = 73296""",
    "own_phone": """SELECT state_code, myc_van_id, contacts_phone_id AS phone_id, phone_number AS main_phone,
                           is_preferred_phone AS main_phone_is_preferred FROM phone WHERE committee_id = 73296""",
    "located": """FROM attending JOIN person_record USING (state_code, myc_van_id)
                  JOIN own_address USING (state_code, myc_van_id, contacts_address_id)
                  LEFT JOIN own_email USING (state_code, myc_van_id, email_id)
                  LEFT JOIN own_phone USING (state_code, myc_van_id, phone_id)""",
}
_UNKNOWN = """NOT EXISTS (FROM email known WHERE lower(known.email) = located.email
                          AND known.state_code = located.state_or_province)"""
sql(
    "join_left_on_const",
    ["person_record", "email"],
    """SELECT state_code, myc_van_id, own.email FROM person_record
       LEFT JOIN (FROM email WHERE committee_id = 73296) own USING (state_code, myc_van_id)""",
)
sql(
    "join_theta_residual",
    _PEOPLE,
    """SELECT state_code, state_or_province, myc_van_id, address_line_1 FROM located
       WHERE state_code <> state_or_province""",
    **_LOCATED,
)
sql(
    "anti_email_home",
    _PEOPLE,
    f"SELECT myc_van_id, email, state_or_province, address_line_1 FROM located WHERE {_UNKNOWN}",
    **_LOCATED,
)
sql(
    "dedupe_person",
    ["address"],
    """SELECT state_code, myc_van_id, state, voting_address, city, zip FROM address
       QUALIFY row_number() OVER (PARTITION BY state_code, myc_van_id
               ORDER BY state NULLS LAST, voting_address NULLS LAST, city NULLS LAST, zip NULLS LAST) = 1""",
)
_KNOWN_COLUMNS = [
    "first_name", "middle_name", "last_name", "address_line_1", "city", "state_or_province", "zip_or_postal_code",
    "email", "email_is_preferred", "main_phone", "main_phone_is_preferred",
]
_PEOPLE_STEPS = {
    **_LOCATED,
    "once": f"""SELECT *, concat(state_code, '-', myc_van_id) AS source_external_id
        FROM (SELECT * FROM located WHERE state_code <> state_or_province AND {_UNKNOWN}) away
        QUALIFY row_number() OVER (PARTITION BY state_code, myc_van_id, state_or_province ORDER BY
            address_line_1 NULLS LAST, city NULLS LAST, zip_or_postal_code NULLS LAST, email NULLS LAST,
            email_is_preferred NULLS LAST, main_phone NULLS LAST, main_phone_is_preferred NULLS LAST) = 1""",
    "people": f"""SELECT {', '.join(_KNOWN_COLUMNS)}, source_external_id,
        {', '.join(f'NULL::VARCHAR AS {c}' for c in people.EXPORT if c not in [*_KNOWN_COLUMNS, 'source_external_id'])},
        md5(array_to_string(list_transform([first_name, middle_name, last_name, address_line_1, NULL, city,
            state_or_province, zip_or_postal_code, email, NULL, NULL, NULL, main_phone, NULL, source_external_id, NULL],
            lambda x: coalesce(x, 'missing')), '') || state_or_province) AS person_hash
        FROM once""",
}
sql("people_oos", _PEOPLE, "FROM people", **_PEOPLE_STEPS)
sql("people_oos_state", _PEOPLE, "FROM people WHERE state_or_province = 'NY'", **_PEOPLE_STEPS)
sql(
    "people_oos_limit",
    _PEOPLE,
    """FROM people QUALIFY row_number() OVER (PARTITION BY state_or_province
                                              ORDER BY person_hash, source_external_id) <= 5""",
    **_PEOPLE_STEPS,
)
sql(
    "load_people_log",
    _PEOPLE,
    """SELECT first_name, middle_name, last_name, address_line_1, address_line_2, city, state_or_province, email,
              home_phone, cell_phone, main_phone, source_external_id, person_hash, true AS loaded FROM people""",
    **_PEOPLE_STEPS,
)

# --- notes ----------------------------------------------------------------------------------

sql("distinct_rows", ["donor"], "SELECT DISTINCT actionkit_id, occupation_clean, employer_clean FROM donor")


def _notes(rows: str, categories: Mapping[str, int]) -> str:
    """Notes of (van_id, text, state_code, contacttimestamp) rows in states with a category."""
    return f"""
        SELECT van_id, "text", false AS is_view_restricted, note_category_id,
               {_local('state_code', 'contacttimestamp')} AS date_canvassed, contacttimestamp, state_code,
               md5(concat(van_id, "text", state_code)) AS note_hash
        FROM ({rows}) n JOIN {_values(categories, 'k(category_state, note_category_id)')} ON state_code = category_state
        WHERE van_id IS NOT NULL AND "text" IS NOT NULL"""


_DONOR = _notes(
    """SELECT string_split(st_myc_van_id, '-')[2] AS van_id, string_split(st_myc_van_id, '-')[1] AS state_code,
              format(E'Donor Occupation: {}\\nEmployer: {}', occupation_clean, employer_clean) AS "text",
              paidat AS contacttimestamp
       FROM donor JOIN crosswalk USING (actionkit_id)
       WHERE occupation_clean IS NOT NULL AND employer_clean IS NOT NULL GROUP BY ALL""",
    {"IL": 2, "PA": 11},
)
sql("notes_donor", ["donor", "crosswalk"], _DONOR)
sql(
    "notes_donor_deduped",
    ["donor", "crosswalk"],
    f"SELECT * FROM ({_DONOR}) QUALIFY row_number() OVER (PARTITION BY note_hash ORDER BY contacttimestamp) = 1",
)
sql(
    "load_notes_log",
    ["donor", "crosswalk"],
    """SELECT CAST(van_id AS BIGINT) AS myc_van_id, "text", is_view_restricted, note_category_id,
              contacttimestamp, date_canvassed, state_code, note_hash, true AS loaded, run_id
       FROM notes, (SELECT unnest(['1', '2']) AS run_id)""",
    notes=_DONOR,
)
sql(
    "notes_generic",
    ["polling"],
    _notes(
        """SELECT CAST(myv_van_id AS VARCHAR) AS van_id, place AS "text", state AS state_code,
                  NULL::TIMESTAMP AS contacttimestamp FROM polling""",
        queries.POLLING_CATEGORIES,
    ),
)
_categories = ", ".join(
    f"({_quoted(n)}, {_quoted(s)}, {c})" for n, states in codes.NOTE_CATEGORIES.items() for s, c in states.items()
)
sql(
    "notes_category",
    ["polling"],
    f"""SELECT p.myv_van_id, upper(p.state) AS state_code, k.note, k.note_category_id
        FROM polling p JOIN (VALUES {_categories}) k(note, state_code, note_category_id) ON upper(p.state) = k.state_code""",
)

# --- person matching ----------------------------------------------------------------------------

sql(
    "chunk_assign",
    [],
    """SELECT c_custkey,
              CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 15) AS BIGINT) % chunks + 1 AS INTEGER) AS chunk
       FROM customer,
            (SELECT 3 AS chunks) c""",
)
_CHUNK = "CAST(CAST('0x' || substr(md5(CAST(pk AS VARCHAR)), 1, 15) AS BIGINT) % 3 + 1 AS INTEGER)"
sql(
    "rematch_universe",
    ["match_source", "earlier_match"],
    f"""SELECT pk, fname, lname, score, {_CHUNK} AS chunk FROM match_source LEFT JOIN earlier_match USING (pk)
        WHERE score < 0.6 OR score IS NULL""",
)
sql(
    "anti_two_tables",
    ["match_source", "earlier_match", "earlier_cleaned"],
    """SELECT s.pk, s.fname, s.lname FROM match_source s LEFT JOIN earlier_match m ON s.pk = m.pk
       LEFT JOIN earlier_cleaned c ON s.pk = c.pk WHERE m.pk IS NULL AND c.pk IS NULL""",
)
sql(
    "dedupe_nulls_last",
    ["match_source"],
    """SELECT state, email, pk FROM match_source
       QUALIFY row_number() OVER (PARTITION BY state ORDER BY email NULLS LAST, pk) = 1""",
)

sql(
    "chunk_tiles",
    [],
    "SELECT c_custkey, c_acctbal, CAST(ntile(7) OVER (ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS tile FROM customer",
)
sql(
    "match_birth_date",
    ["born_source", "born_person"],
    """SELECT pk AS source_id, voterbase_id AS matched_id, score FROM born_source LEFT JOIN (
           SELECT s.pk, p.voterbase_id, 0.95::DOUBLE AS score FROM born_source s JOIN born_person p
           ON lower(fname) = first_name AND lname = lower(last_name) AND born = birth_date
           QUALIFY row_number() OVER (PARTITION BY s.pk ORDER BY p.voterbase_id) <= 3) found USING (pk)""",
)

# all pairs that satisfy a rule, scored by their best rule, then the top of each source
_FORMS = {
    "fn": "nullif(regexp_replace(lower({first}), '[^a-z0-9]', '', 'g'), '')",
    "ln": "nullif(regexp_replace(lower({last}), '[^a-z0-9]', '', 'g'), '')",
    "ct": "nullif(regexp_replace(lower({city}), '[^a-z0-9]', '', 'g'), '')",
    "em": "nullif(lower(trim({email})), '')",
    "st": "nullif(lower(trim({state})), '')",
    "ph": "nullif(regexp_replace(regexp_replace({phone}, '[^0-9]', '', 'g'), '^1([0-9]{{10}})$', '\\1'), '')",
    "zp": "nullif(left(regexp_replace({zip}, '[^0-9]', '', 'g'), 5), '')",
    "ad": "nullif(trim(regexp_replace(lower({address}), '[^a-z0-9]+', ' ', 'g')), '')",
}


def _normal(columns: Mapping[str, str]) -> str:
    return ", ".join(f"{form.format(**columns)} AS {name}" for name, form in _FORMS.items())


_SOURCE_COLUMNS = dict(
    first="fname", last="lname", city="city", email="email", state="state", phone="phone", zip="zip", address="addr"
)
_PERSON_COLUMNS = dict(
    first="first_name", last="last_name", city="city", email="email", state="state_code", phone="phone", zip="zip",
    address="full_address",
)


def _less(x: str) -> str:
    return f"""CASE WHEN length({x}) > 1 THEN list_append(list_transform(range(1, length({x}) + 1),
        lambda i: substr({x}, 1, i - 1) || substr({x}, i + 1)), {x}) ELSE [{x}] END"""


_PAIR_RULES = [
    (0.98, "s.em = p.em AND s.ln = p.ln"),
    (0.96, "s.ph = p.ph AND s.ln = p.ln"),
    (0.92, "s.fn = p.fn AND s.ln = p.ln AND s.ad = p.ad AND s.zp = p.zp"),
    (0.85, "s.fn = p.fn AND s.ln = p.ln AND s.zp = p.zp"),
    (0.75, "left(s.fn, 3) = left(p.fn, 3) AND s.ln = p.ln AND s.zp = p.zp"),
    (0.7, "s.fn = p.fn AND s.zp = p.zp AND list_has_any(s.ln_less, p.ln_less)"),
    (0.65, "s.ln = p.ln AND s.zp = p.zp AND list_has_any(s.fn_less, p.fn_less)"),
    (0.55, "s.fn = p.fn AND s.ln = p.ln AND s.ct = p.ct AND s.st = p.st"),
    (0.5, "s.em = p.em"),
    (0.45, "s.ph = p.ph"),
    (0.35, "s.fn = p.fn AND s.ln = p.ln AND s.st = p.st"),
    (0.25, "left(s.fn, 3) = left(p.fn, 3) AND s.ln = p.ln AND s.st = p.st"),
]


def _candidates(source: str, prefix: str) -> dict[str, str]:
    """Named steps ending in ``<prefix>cand``: (source_id, matched_id, score), three per source at most."""
    pairs = " UNION ALL ".join(
        f"SELECT s.pk AS source_id, p.voterbase_id AS matched_id, {score} AS score"
        f" FROM {prefix}src s JOIN person_forms p ON {rule}"
        for score, rule in _PAIR_RULES
    )
    return {
        f"{prefix}src": f"""SELECT *, {_less('fn')} AS fn_less, {_less('ln')} AS ln_less
            FROM (SELECT pk, {_normal(_SOURCE_COLUMNS)} FROM {source}) x""",
        f"{prefix}cand": f"""SELECT source_id, matched_id, score FROM (
            SELECT source_id, matched_id, max(score)::DOUBLE AS score FROM ({pairs}) x GROUP BY 1, 2) y
            QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY score DESC, matched_id) <= 3""",
    }


_PERSON_FORMS = {
    "person_forms": f"""SELECT *, {_less('fn')} AS fn_less, {_less('ln')} AS ln_less
        FROM (SELECT voterbase_id, {_normal(_PERSON_COLUMNS)} FROM person_file) x"""
}
_MATCH_INPUTS = ["match_source", "person_file", "earlier_match", "earlier_cleaned"]
_SRC = ["pk", "fname", "lname", "phone", "email", "addr", "city", "state", "zip"]
_DAY = f"DATE '{queries.RUN_DATE.isoformat()}'"


def _best(candidates: str, source: str, extra: bool = True, cutoff: float = 0.4) -> str:
    same = " AND ".join(
        ["lower(s.state) = lower(p.state_code)", "lower(s.lname) = lower(p.last_name)",
         "lower(s.fname[:3]) = lower(p.first_name[:3])"]
    )
    return f"""
        SELECT * EXCLUDE (tied) FROM (
            SELECT p.person_id, c.matched_id AS voterbase_id, c.score, {_DAY} AS matched_date,
                   {', '.join(f's.{x}' for x in _SRC)}, coalesce({same}, false) AND {extra} AS tied
            FROM {candidates} c LEFT JOIN person_file p ON p.voterbase_id = c.matched_id
            LEFT JOIN {source} s ON s.pk = c.source_id
            QUALIFY row_number() OVER (PARTITION BY c.source_id ORDER BY tied DESC, c.score DESC, c.matched_id) = 1) top
        WHERE person_id IS NOT NULL AND (tied OR score >= {cutoff})"""


def _merge(*rounds: str) -> str:
    columns = ", ".join(["person_id", "voterbase_id", "score", "matched_date", *_SRC])
    union = " UNION ALL ".join(f"SELECT {columns} FROM {r}" for r in rounds)
    return f"""SELECT {columns} FROM ({union}) x QUALIFY row_number() OVER (
        PARTITION BY pk ORDER BY score DESC, matched_date DESC, voterbase_id, person_id) = 1"""


_FIRST = {**_PERSON_FORMS, **_candidates("match_source", "a_")}
sql(
    "match_candidates",
    ["match_source", "person_file"],
    "SELECT s.pk AS source_id, c.matched_id, c.score FROM match_source s LEFT JOIN a_cand c ON s.pk = c.source_id",
    **_FIRST,
)
sql("match_best", ["match_source", "person_file"], _best("a_cand", "match_source"), **_FIRST)
sql("match_best_plain", ["match_source", "person_file"], _best("a_cand", "match_source", False, 0.8), **_FIRST)
_EARLIER = f"SELECT e.*, {', '.join(f's.{c}' for c in _SRC[1:])} FROM earlier_match e JOIN match_source s ON e.pk = s.pk"
sql(
    "match_merge",
    ["match_source", "person_file", "earlier_match"],
    _merge("best", "earlier"),
    **_FIRST,
    best=_best("a_cand", "match_source"),
    earlier=_EARLIER,
)


def _names(source: str) -> str:
    """Name guesses of the one row per key with the lowest email."""
    empty = lambda x: f"nullif({x}, '')"
    return f"""
        SELECT pk,
               CASE WHEN second_partner IS NOT NULL AND first_partner IS NOT NULL THEN first_partner
                    WHEN fname IS NOT NULL AND lname IS NULL AND rest_is_new AND word IS NOT NULL THEN word
                    WHEN fname IS NULL AND mail_first <> mail_last THEN mail_first
                    ELSE {_initcap('fname')} END AS first_name_guess,
               coalesce({_initcap('lname')}, CASE WHEN rest_is_new THEN rest END, mail_last) AS last_name_guess
        FROM (SELECT *, rest IS NOT NULL AND rest <> fname AS rest_is_new FROM (
            SELECT pk, fname, lname, {empty(_initcap("partners[1]"))} AS first_partner,
                   {empty(_initcap("coalesce(partners[2], '')"))} AS second_partner,
                   {empty(_initcap("fname[:instr(fname, ' ')]"))} AS word,
                   {empty(_initcap("fname[instr(fname, ' ') + 1:]"))} AS rest,
                   {empty(_initcap("regexp_extract(box, '^[^._]+')"))} AS mail_first,
                   {empty(_initcap("string_split(replace(box, '_', '.'), '.')[-1]"))} AS mail_last
            FROM (SELECT pk, fname, lname, string_split(regexp_replace(lower(fname), ' (and|&) ', ';', 'g'), ';') AS partners,
                         regexp_replace(lower(regexp_extract(email, '^([^@]*)@', 1)), '[^a-z._]', '', 'g') AS box
                  FROM {source} QUALIFY row_number() OVER (PARTITION BY pk ORDER BY email NULLS LAST) = 1) a) b) c"""


sql("name_guess", ["match_source"], _names("match_source"))


def _map(table: Mapping[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in table.items()) + "}"


def _respelled(x: str, table: Mapping[str, str]) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: coalesce({_map(table)}[w], w)), ' ')"


def _line(x: str) -> str:
    spaced = f"regexp_replace(replace(upper({x}), '#', ' # '), '[.,;:''\"]', ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '\\s+', ' ', 'g'))"


# --- fixed values: the usual postal abbreviations, stated again so that the comparison is of two rules ---
_STREET_PAIRS = """ALLEY ALY, AVENUE AVE, BOULEVARD BLVD, CIRCLE CIR, COURT CT, DRIVE DR, EXPRESSWAY EXPY, FREEWAY FWY,
    HEIGHTS HTS, HIGHWAY HWY, LANE LN, PARKWAY PKWY, PLACE PL, PLAZA PLZ, ROAD RD, SQUARE SQ, STREET ST, TERRACE TER,
    TRAIL TRL, TURNPIKE TPKE, NORTH N, EAST E, SOUTH S, WEST W, NORTHEAST NE, NORTHWEST NW, SOUTHEAST SE, SOUTHWEST SW"""
_UNIT_PAIRS = "APARTMENT APT, FLOOR FL, ROOM RM, SUITE STE"
_UNIT_SIGNS = "'APT', 'APARTMENT', 'UNIT', 'STE', 'SUITE', 'FL', 'FLOOR', 'RM', 'ROOM', '#'"
# --- end of fixed values ---


def _pairs(text: str) -> dict[str, str]:
    return dict(pair.split() for pair in text.split(","))


# a line ends in its unit if its last word but one is a unit sign, and not its first
_HAS_UNIT = rf"(len(words) > 2 AND words[-2] IN ({_UNIT_SIGNS}) AND regexp_full_match(words[-1], '[A-Z0-9-]+'))"
_state_codes = {name: code for code, name, _ in zones.STATES} | {"D.C.": "DC"}


def _standard(source: str) -> str:
    street = f"array_to_string(CASE WHEN {_HAS_UNIT} THEN words[:-3] ELSE words END, ' ')"
    unit = f"CASE WHEN {_HAS_UNIT} THEN words[-2] || ' ' || words[-1] ELSE '' END"
    return f"""
        SELECT pk,
               nullif({_respelled(street, _pairs(_STREET_PAIRS))}, '') AS std_priadr,
               nullif({_respelled(unit, _pairs(_UNIT_PAIRS))}, '') AS std_secadr,
               nullif({_line('city')}, '') AS std_city,
               nullif(coalesce({_map(_state_codes)}[upper(trim(state))], upper(trim(state))), '') AS std_state,
               nullif(regexp_extract(zip, '^[^0-9]*([0-9]{{5}})', 1), '') AS std_zip
        FROM (SELECT *, string_split({_line('addr')}, ' ') AS words FROM {source}) x"""


sql("address_standardise", ["match_source"], _standard("match_source"))


def _coalesced(source: str, names: str, standard: str) -> str:
    return f"""
        SELECT i.pk, coalesce(n.first_name_guess, i.fname) AS fname, coalesce(n.last_name_guess, i.lname) AS lname,
               i.phone, i.email, coalesce(c.std_priadr, i.addr) AS addr,
               coalesce(c.std_city, i.city) AS city,
               coalesce(c.std_state, i.state) AS state,
               coalesce(c.std_zip, i.zip) AS zip
        FROM {source} i LEFT JOIN {names} n ON i.pk = n.pk LEFT JOIN {standard} c ON i.pk = c.pk
        WHERE i.pk IS NOT NULL"""


_TIDY = {
    "names": _names("match_source"),
    "standard": _standard("match_source"),
    "tidy": _coalesced("match_source", "names", "standard"),
}
sql("cass_coalesce", ["match_source"], "SELECT * FROM tidy", **_TIDY)
sql(
    "cass_history",
    ["match_source", "earlier_cleaned"],
    f"""SELECT *, {_DAY} AS cass_date FROM tidy WHERE pk IN (SELECT pk FROM earlier_cleaned)
        UNION ALL SELECT *, DATE '2024-03-01' FROM tidy WHERE pk NOT IN (SELECT pk FROM earlier_cleaned)""",
    **_TIDY,
)


def _two_rounds(universe: str, cleaned: str) -> dict[str, str]:
    return {
        "universe": universe,
        **_PERSON_FORMS,
        **_candidates("universe", "a_"),
        "first_round": _best("a_cand", "universe"),
        "left_over": f"""SELECT * FROM universe WHERE pk NOT IN (SELECT pk FROM first_round)
                         AND pk NOT IN ({cleaned})""",
        "names": _names("left_over"),
        "standard": _standard("left_over"),
        "tidy": _coalesced("left_over", "names", "standard"),
        **_candidates("tidy", "b_"),
        "second_round": _best("b_cand", "tidy"),
    }


sql(
    "match_run",
    _MATCH_INPUTS,
    _merge("first_round", "second_round", "earlier"),
    earlier=_EARLIER,
    **_two_rounds(
        """SELECT s.* FROM match_source s LEFT JOIN (SELECT pk, score FROM earlier) e ON s.pk = e.pk
           WHERE e.score < 0.6 OR e.score IS NULL""",
        "SELECT pk FROM earlier_cleaned",
    ),
)
sql(
    "match_run_first",
    ["match_source", "person_file"],
    _merge("first_round", "second_round"),
    **_two_rounds("SELECT * FROM match_source", "SELECT -1"),
)

sql(
    "match_run_plain",
    ["match_source", "person_file"],
    _merge("first_round"),
    **_FIRST,
    first_round=_best("a_cand", "match_source", extra=False),
)


def _again(day: str, universe: str) -> dict[str, str]:
    """The first round of a later run."""
    steps = {"universe_2": universe, **_candidates("universe_2", "c_")}
    steps["third_round"] = _best("c_cand", "universe_2").replace(_DAY, day)
    return steps


sql(
    "match_job",
    ["match_source", "person_file"],
    """SELECT * FROM (SELECT * FROM (SELECT * FROM published UNION ALL
                      SELECT * FROM third_round UNION ALL SELECT * FROM fourth_round) x
                      QUALIFY row_number() OVER (PARTITION BY pk
                              ORDER BY score DESC, matched_date DESC, voterbase_id, person_id) = 1) y""",
    **_two_rounds("SELECT * FROM match_source", "SELECT -1"),
    published=_merge("first_round", "second_round"),
    **_again(
        "DATE '2024-03-01'",
        """SELECT s.* FROM match_source s LEFT JOIN (SELECT pk, score FROM published) e ON s.pk = e.pk
           WHERE e.score < 0.6 OR e.score IS NULL""",
    ),
    left_over_2="""SELECT * FROM universe_2 WHERE pk NOT IN (SELECT pk FROM third_round)
                   AND pk NOT IN (SELECT pk FROM tidy)""",
    names_2=_names("left_over_2"),
    standard_2=_standard("left_over_2"),
    tidy_2=_coalesced("left_over_2", "names_2", "standard_2"),
    **_candidates("tidy_2", "d_"),
    fourth_round=_best("d_cand", "tidy_2").replace(_DAY, "DATE '2024-03-01'"),
)
ORACLE["match_pipeline"] = ORACLE["match_job"]

# all pairs of people whose full names are two letters apart at most, by the weighted mean of what both have
_WEIGHTS = {"em": 2, "ph": 2, "ad": 2, "zp": 1}
_SAME = " + ".join(f"CASE WHEN s.{f} = p.{f} THEN {w} ELSE 0 END" for f, w in _WEIGHTS.items())
_BOTH = " + ".join(f"CASE WHEN s.{f} IS NOT NULL AND p.{f} IS NOT NULL THEN {w} ELSE 0 END" for f, w in _WEIGHTS.items())
sql(
    "match_similar",
    ["match_source", "person_file"],
    f"""SELECT source_id, matched_id, score FROM (
            SELECT pk AS source_id, voterbase_id AS matched_id,
                   max(round((3 * (1 - apart / greatest(length(s.full_name), length(p.full_name))) + {_SAME}) / (3 + {_BOTH}), 6)) AS score
            FROM named n JOIN s USING (full_name) JOIN p ON p.full_name = n.person_name GROUP BY ALL) x
        QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY score DESC, matched_id) <= 3""",
    s=f"SELECT *, fn || ' ' || ln AS full_name FROM (SELECT pk, {_normal(_SOURCE_COLUMNS)} FROM match_source) x",
    p=f"SELECT *, fn || ' ' || ln AS full_name FROM (SELECT voterbase_id, {_normal(_PERSON_COLUMNS)} FROM person_file) x",
    named="""SELECT a.full_name, b.full_name AS person_name, levenshtein(a.full_name, b.full_name) AS apart
             FROM (SELECT DISTINCT full_name FROM s) a, (SELECT DISTINCT full_name FROM p) b
             WHERE levenshtein(a.full_name, b.full_name) <= 2""",
)

# --- audit -----------------------------------------------------------------------------------------

_IDS = "list_transform(string_split(definition, 'job_id: ')[2:], lambda v: split_part(v, chr(10), 1))"
_ALLOW = ", ".join(str(i) for i in queries.ALLOWED)
sql(
    "audit_workflows",
    ["workflow_flat"],
    f"""SELECT id, name, state, user_name AS "user", scheduled, array_to_string({_IDS}, ',') AS job_ids
        FROM workflow_flat WHERE scheduled OR id IN ({_ALLOW})""",
)
_JOB_IDS = f"""SELECT name AS workflow, TRY_CAST(id_text AS BIGINT) AS job_id FROM (
    SELECT name, unnest({_IDS}) AS id_text FROM workflow_flat WHERE {{where}}) x WHERE TRY_CAST(id_text AS BIGINT) > 0"""
sql("audit_job_ids", ["workflow_flat"], _JOB_IDS.format(where="scheduled"))


def _runtime(start: str, end: str) -> str:
    """Text of the difference of the times of day, as a time delta prints it."""
    day = f"(epoch(CAST({end} AS TIME))::BIGINT - epoch(CAST({start} AS TIME))::BIGINT)"
    clock = lambda s: f"(({s}) // 3600) || printf(':%02d:%02d', (({s}) % 3600) // 60, ({s}) % 60)"
    return f"CASE WHEN {day} < 0 THEN '-1 day, ' || {clock(day + ' + 86400')} ELSE {clock(day)} END"


_RUNTIME = f"""CASE WHEN run_state <> 'running' AND end_ts IS NOT NULL
    THEN {_runtime("date_trunc('second', start_ts)", "date_trunc('second', end_ts)")} END AS latest_runtime,
    CASE WHEN run_state <> 'running' THEN date_diff('second', date_trunc('second', start_ts), date_trunc('second', end_ts)) END
        AS runtime_seconds"""
sql("audit_runtime", ["run_flat"], f"SELECT event_id, {_RUNTIME} FROM run_flat")
_NEWEST = "run_flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY start_ts DESC, event_id DESC) = 1"
sql("audit_newest_run", ["run_flat"], f"SELECT user_id AS job_id, run_state AS state, {_RUNTIME} FROM {_NEWEST}")
sql(
    "audit_jobs",
    ["workflow_flat", "run_flat"],
    """SELECT id, 'job ' || id AS name, 'container' AS type,
              CASE WHEN id % 7 = 0 THEN 'failed' ELSE 'succeeded' END AS state, latest_runtime, runtime_seconds, workflow
       FROM jobs JOIN latest ON id = job_id""",
    jobs=_JOB_IDS.format(where=f"scheduled OR id IN ({_ALLOW})"),
    latest=f"SELECT user_id AS id, {_RUNTIME} FROM {_NEWEST}",
)
