"""The inputs of the jobs, derived from the given tables.

Each input is one SELECT that Spark and the comparison engine both understand, over
whole tables. ``{name}`` stands for a given table or another input.
"""

from __future__ import annotations

from functools import lru_cache
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from fieldloom.functions import codes

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# abbreviations, names, mixed case, three spellings of one place, two without a zone
_STATES = (
    "IL|california|NY|Texas|AZ|HI|AK|CO|D.C.|washington dc|PR|FL|iowa|PA|nv|NH|SC|WA|OR|MN|MI|GA|OH|WI|"
)


def _pick(texts: str, number: str, size: int) -> str:
    quoted = texts.replace("'", "''")
    return f"split_part('{quoted}', '|', CAST({number} % {size} + 1 AS INT))"


def st(number: str) -> str:
    return _pick(_STATES, number, 25)


_ANSWERS = "|".join(
    [*codes.FIRST_CHOICE_ANSWERS, "No Answer", "Volunteer Yes", "Volunteer Maybe", "Volunteer No", "Unlisted"]
)
_SUPPORT = "|".join([*codes.SUPPORT_ANSWERS, "Refused", "0 - Wrong number"])

_W1 = "split_part(p_name, ' ', 1)"
_W2 = "split_part(p_name, ' ', 2)"

INPUTS = {
    # contacts and their survey answers
    "contact": f"""
        SELECT event_id AS contactcontact_id,
               CASE event_type WHEN 'click' THEN 'getthru_dialer' WHEN 'view' THEN 'spoke'
                    WHEN 'signup' THEN 'bern_app_door_canvass' WHEN 'purchase' THEN 'bern_app_relational'
                    WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'bern_app_crowd_canvass' ELSE 'myc_phone' END
                    ELSE 'myc_phone' END AS contacttype,
               CASE WHEN value >= 10 THEN {st('user_id')} || '-' || CAST(user_id AS STRING) END AS st_myv_van_id,
               ts AS contacttimestamp
        FROM {{events}}""",
    "response": """
        SELECT event_id AS contactcontact_id, event_id % 5 AS surveyquestionid,
               CAST(floor(event_id / 5) AS BIGINT) % 30 AS surveyresponseid
        FROM {events}""",
    "question": """
        SELECT CAST(r_regionkey AS BIGINT) AS surveyquestionid,
               CASE r_name WHEN 'AMERICA' THEN 'Candidate Interest First Choice'
                    WHEN 'AFRICA' THEN 'q7: candidate interest FIRST choice?'
                    WHEN 'ASIA' THEN 'Candidate Interest Second Choice'
                    WHEN 'EUROPE' THEN 'CANDIDATE INTEREST SECOND CHOICE (2)'
                    ELSE r_name END AS surveyquestiontext
        FROM {region}""",
    "answer": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS surveyresponseid, {_pick(_ANSWERS, 'n_nationkey', 30)} AS surveyresponsetext
        FROM {{nation}}
        UNION ALL
        SELECT CAST(r_regionkey + 25 AS BIGINT), {_pick(_ANSWERS, '(r_regionkey + 25)', 30)} FROM {{region}}""",
    "joined_contact": f"""
        SELECT c.st_myv_van_id, {st('(e.user_id + 3)')} || '-' || CAST(e.user_id + 1000 AS STRING) AS st_myc_van_id,
               {_pick(_SUPPORT, "CAST(regexp_extract(e.props, '[0-9]+', 0) AS INT)", 9)} AS support_response_text,
               CASE e.event_type WHEN 'error' THEN 'quickbase' ELSE c.contacttype END AS contacttype,
               c.contacttimestamp
        FROM {{contact}} c JOIN {{events}} e ON e.event_id = c.contactcontact_id""",
    # people and what is known of them
    "signup": f"""
        SELECT upper({st('o_custkey')}) AS state_code, o_custkey AS myc_van_id,
               CASE WHEN o_orderstatus = 'O' THEN {codes.COMMITTEE_ID} ELSE 1 END AS created_by_committee_id
        FROM {{orders}}""",
    "person_record": f"""
        SELECT upper({st('c_custkey')}) AS state_code, c_custkey AS myc_van_id,
               lower(c_mktsegment) AS first_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'M.' END AS middle_name,
               c_name AS last_name, c_custkey + 1000000 AS contacts_address_id, c_custkey + 2000000 AS email_id,
               c_custkey + 3000000 AS phone_id
        FROM {{customer}}""",
    "address": f"""
        SELECT c_custkey + 1000000 AS contacts_address_id,
               CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE {codes.COMMITTEE_ID} END AS person_committee_id,
               c_custkey AS myc_van_id, upper({st('c_custkey')}) AS state_code,
               CAST(c_custkey AS STRING) || ' ' || c_mktsegment || ' St' AS voting_address, c_mktsegment AS city,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE upper({st('c_nationkey')}) END AS state,
               lpad(CAST(c_custkey % 500 AS STRING), 5, '0') AS zip
        FROM {{customer}}
        UNION ALL
        SELECT o_custkey + 1000000, {codes.COMMITTEE_ID}, o_custkey, upper({st('o_custkey')}),
               o_orderpriority || ' Ave', NULL, upper({st('length(o_orderpriority)')}), NULL
        FROM {{orders}}""",
    "email": f"""
        SELECT c_custkey + 2000000 AS contacts_email_id,
               CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE {codes.COMMITTEE_ID} END AS committee_id,
               c_custkey AS myc_van_id, upper({st('c_custkey')}) AS state_code,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE c_mktsegment || CAST(c_custkey % 40 AS STRING) || '@x.org' END AS email,
               c_acctbal > 5000 AS is_preferred_email
        FROM {{customer}}
        UNION ALL
        SELECT s_suppkey + 5000000, 1, s_suppkey + 4000000, upper({st('s_nationkey')}),
               'building' || CAST(s_suppkey % 40 AS STRING) || '@X.org', false
        FROM {{supplier}}""",
    "phone": f"""
        SELECT c_custkey + 3000000 AS contacts_phone_id,
               CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE {codes.COMMITTEE_ID} END AS committee_id,
               c_custkey AS myc_van_id, upper({st('c_custkey')}) AS state_code,
               '555' || lpad(CAST(c_custkey AS STRING), 7, '0') AS phone_number, c_acctbal > 1000 AS is_preferred_phone
        FROM {{customer}}""",
    # notes
    "donor": """
        SELECT o_custkey AS actionkit_id, substr(o_orderpriority, 3) AS occupation_clean,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS employer_clean, o_orderdate AS paidat
        FROM {orders}""",
    "crosswalk": f"""
        SELECT c_custkey AS actionkit_id, {st('c_nationkey')} || '-' || CAST(c_custkey AS STRING) AS st_myc_van_id
        FROM {{customer}}""",
    "polling": f"""
        SELECT c_custkey AS myv_van_id, 'Polling place: ' || n_name AS place, {st('c_nationkey')} AS state
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    # person matching
    "match_source": f"""
        SELECT p_partkey AS pk,
               CASE p_partkey % 10 WHEN 0 THEN {_W1} || ' and ' || {_W2} WHEN 1 THEN p_name WHEN 2 THEN NULL
                    ELSE {_W1} END AS fname,
               CASE p_partkey % 10 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE {_W2} END AS lname,
               CASE WHEN p_partkey % 6 = 5 THEN NULL
                    ELSE {_W1} || '.' || {_W2} || CAST(p_partkey % 300 AS STRING) || '@x.org' END AS email,
               CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN '+1 ' ELSE '' END || '(555) 01' || CAST(p_partkey % 10 AS STRING) || '-'
                    || lpad(CAST(p_partkey % 700 AS STRING), 4, '0') END AS phone,
               CAST(p_partkey % 900 AS STRING) || ' ' || {_W1} || {_pick(' Street| Ave.| blvd| north  Road| lane', 'p_size', 5)}
                    || CASE p_size % 3 WHEN 0 THEN ', apt ' || CAST(p_size AS STRING) WHEN 1 THEN ' #' || CAST(p_size AS STRING)
                       ELSE '' END AS addr,
               p_type AS city, {st('p_size')} AS state,
               lpad(CAST(p_partkey % 500 AS STRING), 5, '0') || '-' || CAST(p_size + 1000 AS STRING) AS zip
        FROM {{part}}""",
    "person_file": f"""
        SELECT CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'P' || CAST(p_partkey AS STRING) END AS person_id,
               'V' || lpad(CAST(p_partkey AS STRING), 10, '0') AS voterbase_id,
               CASE WHEN p_partkey % 3 = 0 THEN left({_W1}, 3) || 'x' ELSE {_W1} END AS first_name,
               CASE WHEN p_partkey % 8 = 3 THEN left({_W2}, length({_W2}) - 1) ELSE {_W2} END AS last_name,
               upper({_W1} || '.' || {_W2} || CAST(p_partkey % 250 AS STRING) || '@x.org') AS email,
               '555' || lpad(CAST(p_partkey % 7000 AS STRING), 7, '0') AS phone,
               CAST(p_partkey % 900 AS STRING) || ' ' || upper({_W1}) || {_pick(' ST| AVE| BLVD| N RD| LN', 'p_size', 5)}
                    AS full_address,
               lower(p_type) AS city, upper({st('p_size')}) AS state_code,
               lpad(CAST(p_partkey % 450 AS STRING), 5, '0') AS zip
        FROM {{part}}""",
    "born_source": f"""
        SELECT p_partkey AS pk, upper({_W1}) AS fname, {_W2} AS lname,
               CASE WHEN p_partkey % 11 > 0 THEN CAST('1950-01-01' AS DATE) + CAST(p_size * 31 + p_partkey % 3 AS INT) END AS born
        FROM {{part}}""",
    "born_person": f"""
        SELECT 'P' || CAST(p_partkey AS STRING) AS person_id, 'V' || lpad(CAST(p_partkey AS STRING), 10, '0') AS voterbase_id,
               {_W1} AS first_name, upper({_W2}) AS last_name,
               CAST('1950-01-01' AS DATE) + CAST(p_size * 31 + p_partkey % 2 AS INT) AS birth_date
        FROM {{part}}""",
    # an earlier output of the matching job, and rows cleaned by it
    "earlier_match": """
        SELECT 'P0' AS person_id, 'V' || lpad(CAST(l_partkey AS STRING), 10, '0') AS voterbase_id,
               max(l_discount) * 10 AS score, CAST(max(l_shipdate) AS DATE) AS matched_date, l_partkey AS pk
        FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity < 8 GROUP BY l_partkey""",
    "earlier_cleaned": "SELECT DISTINCT l_partkey AS pk FROM {lineitem} WHERE l_returnflag = 'A' AND l_quantity > 45",
    # workflows and jobs; nested parts come flat and are put together in the query
    "workflow_flat": """
        SELECT c_custkey AS id, 'workflow ' || c_name AS name,
               CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'succeeded' END AS state,
               'user ' || c_mktsegment AS user_name, c_mktsegment <> 'FURNITURE' AS scheduled,
               'version: 2' || chr(10) || 'tasks:' || chr(10) || '  job_id: ' || CAST(c_custkey % 37 AS STRING) || chr(10)
                 || '  on-success: x' || chr(10) || '  job_id: None' || chr(10)
                 || '  job_id: ' || CAST(c_nationkey * 5 - 20 AS STRING) || chr(10)
                 || CASE WHEN c_acctbal > 9000 THEN '' ELSE '  job_id: ' || CAST(c_custkey AS STRING) END AS definition
        FROM {customer}""",
    "run_flat": """
        SELECT event_id, user_id,
               CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'succeeded' END AS run_state,
               ts AS start_ts,
               CASE event_type WHEN 'click' THEN ts + INTERVAL '7' MINUTE WHEN 'signup' THEN ts + INTERVAL '25' HOUR
                    WHEN 'error' THEN ts + INTERVAL '23' HOUR WHEN 'view' THEN ts END AS end_ts
        FROM {events}""",
    "run": """
        SELECT event_id, user_id, run_state, replace(CAST(start_ts AS STRING), ' ', 'T') || 'Z' AS started_at,
               replace(CAST(end_ts AS STRING), ' ', 'T') || 'Z' AS finished_at
        FROM {run_flat}""",
    "job_flat": """
        SELECT DISTINCT user_id AS id, 'job ' || CAST(user_id AS STRING) AS name, 'container' AS type,
               CASE user_id % 7 WHEN 0 THEN 'failed' ELSE 'succeeded' END AS state
        FROM {events}""",
}


def _parts(name: str) -> list[str]:
    return list(dict.fromkeys(field for _, field, _, _ in Formatter().parse(INPUTS[name]) if field))


@lru_cache
def _table(spark: SparkSession, path: str) -> DataFrame:
    """A given table; its schema is read once per session."""
    return spark.read.parquet(path)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived input as a DataFrame."""
    if name in TABLES:
        return _table(spark, f"{sf_dir}/{name}.parquet")
    return spark.sql(INPUTS[name], **{p: frame(spark, sf_dir, p) for p in _parts(name)})


def with_inputs(names: list[str], body: str, /, **extra: str) -> str:
    """``body`` with the inputs it uses, and further named selects, as a WITH clause."""
    steps: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TABLES or name in steps:
            return
        for part in _parts(name):
            add(part)
        steps[name] = INPUTS[name].format(**{p: p for p in _parts(name)})

    for name in names:
        add(name)
    steps |= extra
    head = ",\n".join(f"{n} AS ({s})" for n, s in steps.items())
    return f"WITH {head}\n{body}" if steps else body
