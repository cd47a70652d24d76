"""The registered queries. Every one reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import frame
from fieldloom import session
from fieldloom.functions import codes, dates, hashing, lists, runs, text, zones
from fieldloom.operators import joins, sets, windows
from fieldloom.plans import audit, load, matching, notes, people, similarity, survey
from fieldloom.sources import sinks, tables
from fieldloom.sources.versions import VersionedTable
from fieldloom.streaming.load_stream import load_stream as start_load_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RUN_DATE = date(2024, 2, 1)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- scans, sinks, catalog ------------------------------------------------------


@query
def src_scan(spark, sf):
    return tables.scan(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def src_param_sql(spark, sf):
    tables.named_view(frame(spark, sf, "orders"), "param_sql_orders")
    return tables.query(
        spark,
        "SELECT o_orderkey, o_custkey FROM identifier(:t) WHERE o_orderstatus = :status AND o_totalprice > :price",
        t="param_sql_orders",
        status="O",
        price=100000.0,
    )


@query
def sink_replace(spark, sf):
    table = VersionedTable(spark, session.new_name("replaced"))
    table.publish(frame(spark, sf, "customer"))
    # the second version reads the one that it replaces, and has other columns
    return table.publish(table.read().where("c_acctbal >= 0").select("c_custkey", "c_name"))


@query
def ctas_keyed_layout(spark, sf):
    """Orders laid out by customer, made whole, then replaced by themselves with what follows."""
    df = frame(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    table = VersionedTable(spark, session.new_name("keyed_orders"), key="o_custkey", buckets=8)
    table.publish(df.where("o_custkey % 2 = 0"))
    table.append(df.where("o_custkey % 2 = 1"))
    return table.publish(table.read())


@query
def join_keyed(spark, sf):
    """Customers without a large order, against orders bucketed by customer."""
    orders = VersionedTable(spark, session.new_name("orders_by_customer"), key="o_custkey", buckets=8)
    orders.publish(frame(spark, sf, "orders").where("o_totalprice > 250000").select("o_custkey", "o_orderkey"))
    customers = frame(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.without_keys(customers, "o_custkey", orders.read())


@query
def sink_csv(spark, sf):
    df = frame(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = session.new_path(spark, "csv")
    sinks.write_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(path)


@query
def catalog_exists(spark, sf):
    """Rows of those of a list of tables that exist; names are compared in lower case."""
    for name in ("orders", "customer"):
        tables.named_view(frame(spark, sf, name), f"catalog_{name}")
    wanted = ["CATALOG_Orders", "catalog_customer", "catalog_missing"]
    found = [n.lower() for n in wanted if tables.table_exists(spark, n)]
    return sets.union_all(
        spark.table(n).agg(F.count("*").alias("table_rows")).withColumn("table_name", F.lit(n)) for n in found
    )


@query
def union_nonempty(spark, sf):
    """Partial outputs found by name."""
    line = frame(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    for flag in ("A", "N", "R", "X"):
        tables.named_view(line.where(F.col("l_returnflag") == flag), f"lines_part_{flag.lower()}")
    # a part without rows adds none, so none has to be counted
    parts = sorted(t.name for t in spark.catalog.listTables(pattern="lines_part_*"))
    return sets.union_or_empty(spark, [spark.table(n) for n in parts], line.schema)


@query
def filled_tables(spark, sf):
    """Tables of a schema, of which the catalog knows the size of two; one is empty."""
    line = frame(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    schema = session.new_name("lines")
    spark.sql(f"CREATE SCHEMA {schema}")
    for flag in ("A", "N", "R", "X"):
        line.where(F.col("l_returnflag") == flag).write.saveAsTable(f"{schema}.lines_of_{flag.lower()}")
    for flag in ("a", "n"):
        spark.sql(f"ANALYZE TABLE {schema}.lines_of_{flag} COMPUTE STATISTICS")
    return tables.filled_tables(spark, "^lines_of_.$", schema)


@query
def agg_count_diff(spark, sf):
    return sets.count_difference(frame(spark, sf, "lineitem"), frame(spark, sf, "orders"))


@query
def export_queue(spark, sf):
    """Survey records written to one queue per state, read back."""
    sink = _queues(spark, load.survey_format())
    sink(view_survey(spark, sf), "1")
    return spark.read.parquet(sink.path).drop("run")


@query
def export_queue_runs(spark, sf):
    """Loads of two states over the same queues, and one that finds nothing new."""
    form = load.survey_format()
    sink, job = _queues(spark, form), load.IncrementalLoad(_log(spark, "queue_log", form))
    records = view_survey(spark, sf)
    for run, states in (("a", ["IL"]), ("b", ["IL", "NY"]), ("c", ["NY"])):
        job.run(records.where(F.col("state_code").isin(states)), sink, run)
    return spark.read.parquet(sink.path)


# --- column functions -----------------------------------------------------------


@query
def fn_string(spark, sf):
    c = F.col("o_orderpriority")
    return frame(spark, sf, "orders").select(
        "o_orderkey",
        F.split_part(c, F.lit("-"), F.lit(2)).alias("part_2"),
        F.split_part(c, F.lit("-"), F.lit(3)).alias("part_3"),
        F.lower(c).alias("low"),
        F.upper(F.left(c, F.lit(3))).alias("head"),
        F.substr(c, F.lit(3)).alias("tail"),
        F.length(c).alias("len"),
        F.locate("O", c).alias("first_o"),
        text.fits(c, 5).alias("cut"),
        text.none_if_empty(F.split_part(c, F.lit("-"), F.lit(3))).alias("no_part"),
    )


@query
def fn_initcap(spark, sf):
    name = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit(" o'"), F.lower("p_type"))
    return frame(spark, sf, "part").select("p_partkey", text.initcap_words(name).alias("title"))


@query
def fn_regex(spark, sf):
    c = F.col("c_name")
    return frame(spark, sf, "customer").select(
        "c_custkey",
        F.regexp_replace(F.lower(c), "[a-z#]|0{2}", "").alias("stripped"),
        F.regexp_extract(c, "[1-9][0-9]*$", 0).alias("number"),
        text.none_if_empty(F.regexp_extract(c, "^[0-9]+", 0)).alias("leading"),
    )


@query
def fn_lists(spark, sf):
    joined = F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    listed = F.when(F.col("o_orderstatus") == "P", "").otherwise(joined)
    return frame(spark, sf, "orders").select(
        "o_orderkey",
        F.size(lists.text_to_list(listed)).cast("bigint").alias("items"),
        F.aggregate(lists.text_to_list(listed, "bigint"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        lists.list_to_text(lists.text_to_list(listed, "bigint")).alias("again"),
        lists.is_true_text(
            F.when(F.col("o_orderstatus") == "O", "true").when(F.col("o_orderstatus") == "F", "True")
        ).alias("flag"),
    )


@query
def fn_date_formats(spark, sf):
    return (
        frame(spark, sf, "events").select("event_id", dates.date_formats(F.col("ts")).alias("d")).select("event_id", "d.*")
    )


@query
def fn_local_date(spark, sf):
    ts = F.col("ts")
    return frame(spark, sf, "events").select(
        "event_id",
        *[dates.datetime_in(ts, z).alias(f"datetime_{z}") for z in dates.REPORT_ZONES],
        *[dates.date_in(ts, z).alias(f"date_{z}") for z in dates.REPORT_ZONES],
    )


@query
def fn_duration_text(spark, sf):
    secs = (F.col("event_id") * 397) % 400000
    odd = F.floor(F.col("value") * 100) / 4
    return frame(spark, sf, "events").select(
        "event_id",
        text.seconds_to_text(secs).alias("words"),
        text.seconds_to_text(secs, as_clock=True).alias("clock"),
        text.seconds_to_text(odd).alias("odd_words"),
        text.seconds_to_text(odd, as_clock=True).alias("odd_clock"),
    )


@query
def filter_hhmm(spark, sf):
    return frame(spark, sf, "events").where(dates.hhmm_between(F.col("ts"), 600, 1330)).select("event_id", "ts")


@query
def filter_local_hhmm(spark, sf):
    return frame(spark, sf, "events").where(dates.local_hhmm_between(F.col("ts"), 600, 1330)).select("event_id", "ts")


@query
def tz_local_time(spark, sf):
    state = F.split_part("st_myv_van_id", F.lit("-"), F.lit(1))
    return frame(spark, sf, "contact").select(
        "contactcontact_id",
        state.alias("state"),
        zones.zone_of(state).alias("zone"),
        zones.local_time(state, F.col("contacttimestamp")).alias("local_time"),
    )


@query
def hash_strict(spark, sf):
    return frame(spark, sf, "contact").select(
        "contactcontact_id",
        hashing.hash_strict(F.col("st_myv_van_id"), F.col("contacttimestamp"), F.col("contacttype")).alias("record_hash"),
    )


@query
def hash_coalesced(spark, sf):
    return frame(spark, sf, "contact").select(
        "contactcontact_id",
        hashing.hash_coalesced(F.col("st_myv_van_id"), F.col("contacttype"), F.lit("IL")).alias("record_hash"),
    )


@query
def cast_project(spark, sf):
    return frame(spark, sf, "orders").select(
        F.split_part(F.concat(F.lit("IL-"), F.col("o_custkey")), F.lit("-"), F.lit(2)).cast("bigint").alias("van_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").cast("string").cast("timestamp_ntz").alias("stamp"),
        text.fits(F.concat_ws("/", "o_orderpriority", "o_orderstatus"), 10).alias("cut"),
    )


@query
def pii_project(spark, sf):
    config = replace(MATCH, pii={**MATCH.pii, "middle_name": None, "phone": None})
    return matching.mapped_columns(config, frame(spark, sf, "match_source"))


# --- survey records ---------------------------------------------------------------


@query
def value_map(spark, sf):
    return frame(spark, sf, "joined_contact").select(
        "support_response_text",
        "contacttype",
        codes.lookup(F.col("support_response_text"), codes.SUPPORT_ANSWERS).alias("survey_response_id"),
        codes.lookup(F.col("contacttype"), codes.SUPPORT_CONTACT_TYPES).alias("contact_type_id"),
    )


@query
def filter_ilike(spark, sf):
    return frame(spark, sf, "part").where(F.col("p_name").ilike("%ED W%")).select("p_partkey", "p_name")


@query
def filter_inlist(spark, sf):
    kept = F.col("support_response_text").isin(list(codes.SUPPORT_ANSWERS))
    return frame(spark, sf, "joined_contact").where(kept).select("st_myc_van_id", "support_response_text")


@query
def join_inner_chain(spark, sf):
    return (
        frame(spark, sf, "contact")
        .join(frame(spark, sf, "response"), "contactcontact_id")
        .join(frame(spark, sf, "question"), "surveyquestionid")
        .join(frame(spark, sf, "answer"), "surveyresponseid")
        .select("contactcontact_id", "contacttype", "surveyquestiontext", "surveyresponsetext")
    )


def _survey(spark, sf, spec):
    contacts, responses, questions, answers = (frame(spark, sf, n) for n in ("contact", "response", "question", "answer"))
    return survey.survey_view(contacts, responses, questions, answers, spec)


@query
def view_survey(spark, sf):
    return _survey(spark, sf, survey.FIRST_CHOICE)


@query
def view_survey_second(spark, sf):
    return _survey(spark, sf, survey.SECOND_CHOICE)


@query
def view_volunteer(spark, sf):
    return _survey(spark, sf, survey.VOLUNTEER)


@query
def view_support(spark, sf):
    return survey.support_view(frame(spark, sf, "joined_contact"))


@query
def view_myc_only(spark, sf):
    return survey.support_view(frame(spark, sf, "joined_contact"), survey.CAMPAIGN_SUPPORT)


# --- loads ----------------------------------------------------------------------------

LOADED_BEFORE = "2024-01-12 00:00:00"
TRIED_BEFORE = "2024-01-20 00:00:00"


def _survey_log(records):
    """The log after earlier runs: old records loaded, later ones tried, the rest unknown."""
    stamp = F.col("contacttimestamp")
    flag = F.when(stamp < LOADED_BEFORE, F.lit(True)).when(F.col("survey_response_id") % 2 == 0, F.lit(False))
    return load.survey_format().pending(records.where(stamp < TRIED_BEFORE)).withColumn("loaded", flag)


def _log_and_new(spark, sf):
    """The log, and the records that it does not know as loaded, as a run stages them."""
    records = view_support(spark, sf)
    log = _survey_log(records)
    return log, session.stage_table(joins.without_loaded(records, log, "sq_hash"), "new")


@query
def load_survey_new(spark, sf):
    records = view_support(spark, sf)
    return joins.without_loaded(records, _survey_log(records), "sq_hash")


@query
def load_log_pending(spark, sf):
    log, new = _log_and_new(spark, sf)
    return sets.union_all([log, load.survey_format().pending(new)])


@query
def load_log_mark(spark, sf):
    log, new = _log_and_new(spark, sf)
    pending = sets.union_all([log, load.survey_format().pending(new)])
    return joins.mark_loaded(pending, new, "sq_hash")


@query
def load_semi_attempts(spark, sf):
    """Earlier failed attempts of the records that are about to be loaded."""
    log, new = _log_and_new(spark, sf)
    return joins.with_keys(log, "sq_hash", new)


def _queues(spark, form):
    return sinks.QueueSink(session.new_path(spark, "queues"), form.export_cols, form.state_col, form.queue)


def _log(spark, name, form):
    return load.LoadLog(spark, session.new_name(name), form, buckets=8)


@query
def load_cycle_second_run(spark, sf):
    """The log after a run on the older contacts and one on all of them.

    The second run takes only what the first has not loaded.
    """
    form = load.survey_format()
    log = _log(spark, "survey_log", form)
    job = load.IncrementalLoad(log)
    records = view_support(spark, sf)
    job.run(records.where(F.col("contacttimestamp") < LOADED_BEFORE), _queues(spark, form), "1")
    job.run(records, _queues(spark, form), "2")
    return log.rows()


@query
def load_compacted(spark, sf):
    """The same log, compacted after each run."""
    form = load.survey_format()
    log = _log(spark, "compact_log", form)
    job, sink = load.IncrementalLoad(log), _queues(spark, form)
    records = view_support(spark, sf)
    for run, seen in (("1", records.where(F.col("contacttimestamp") < LOADED_BEFORE)), ("2", records)):
        job.run(seen, sink, run)
        log.compact()
    return log.rows()


ANSWERING = ["CALIFORNIA", "FL", "IL", "NY", "TEXAS", "WA"]


def _three_runs(spark, sf, name):
    """Three runs over one path; all queues of the first are answered, and some of the second.

    What the second has sent elsewhere is still to be fetched when the third runs.
    """
    form = load.survey_format()
    log, sink = _log(spark, name, form), _queues(spark, form)
    answers = session.new_path(spark, "answers")
    job = load.IncrementalLoad(log, sinks.answers_in(spark, answers))

    def receive(run, states=None):
        """What a receiver does: take a queue in, then write its answer."""
        for queue in log.in_state("sent"):
            if queue["run_id"] == run and (states is None or queue["queue"].split("_")[0] in states):
                taken = spark.read.parquet(f"{sink.path}/queue={queue['queue']}/run=run_{run}")
                taken.write.parquet(f"{answers}/{queue['response_table']}/run=run_{run}")

    records = view_support(spark, sf)
    job.run(records.where(F.col("contacttimestamp") < LOADED_BEFORE), sink, "1")
    receive("1")
    job.run(records.where(F.col("contacttimestamp") < TRIED_BEFORE), sink, "2")
    receive("2", ANSWERING)
    job.run(records, sink, "3")
    return log, sink


@query
def load_receipts(spark, sf):
    """The log after three runs: loaded is what its receiver has answered to."""
    log, _ = _three_runs(spark, sf, "receipt_log")
    return log.rows()


@query
def export_receipts(spark, sf):
    """The queues after the same runs: every record in one run, whether fetched or not."""
    _, sink = _three_runs(spark, sf, "receipt_queue_log")
    return spark.read.parquet(sink.path)


@query
def export_manifest(spark, sf):
    """The manifest after the same runs."""
    log, _ = _three_runs(spark, sf, "receipt_manifest_log")
    return log.runs()


@query
def load_people_log(spark, sf):
    form = load.people_format()
    log = _log(spark, "people_log", form)
    load.IncrementalLoad(log).run(people_oos(spark, sf), _queues(spark, form), "1")
    return log.rows().drop("run_id")


@query
def load_notes_log(spark, sf):
    """A run whose export fails, and the run after it: both attempts end up loaded."""
    form = load.notes_format()
    log = _log(spark, "notes_log", form)
    job = load.IncrementalLoad(log)

    def broken(df, run_id):
        raise ConnectionError("export failed")

    try:
        job.run(notes_donor(spark, sf), broken, "1")
    except ConnectionError:
        job.run(notes_donor(spark, sf), _queues(spark, form), "2")
    return log.rows()


@query
def load_stream(spark, sf):
    """The survey load fed by a stream of contacts; the log at its end."""
    form = load.survey_format()
    log = _log(spark, "stream_log", form)
    joined = frame(spark, sf, "joined_contact")
    path = session.new_path(spark, "arrivals")
    joined.write.parquet(path)
    arrivals = spark.readStream.schema(joined.schema).option("maxFilesPerTrigger", 4).parquet(path)
    run = start_load_stream(
        arrivals, survey.support_view, load.IncrementalLoad(log), _queues(spark, form), session.new_path(spark, "stream_checkpoint")
    )
    run.awaitTermination()
    return log.rows().drop("run_id")


# --- people ------------------------------------------------------------------------------

_PEOPLE = ("signup", "person_record", "address", "email", "phone")


def _located(spark, sf):
    signups, records, addresses, emails, phones = (frame(spark, sf, n) for n in _PEOPLE)
    found = people.signed_up_people(signups, records, codes.COMMITTEE_ID)
    return people.with_contact_details(found, addresses, emails, phones, codes.COMMITTEE_ID)


@query
def join_left_on_const(spark, sf):
    """People with the email that the committee has of them, if it has one."""
    own = frame(spark, sf, "email").where(F.col("committee_id") == codes.COMMITTEE_ID)
    return (
        frame(spark, sf, "person_record")
        .join(own.select("state_code", "myc_van_id", "email"), ["state_code", "myc_van_id"], "left")
        .select("state_code", "myc_van_id", "email")
    )


@query
def join_theta_residual(spark, sf):
    return _located(spark, sf).where(F.col("state_code") != F.col("state_or_province")).select(
        "state_code", "state_or_province", "myc_van_id", "address_line_1"
    )


@query
def anti_email_home(spark, sf):
    located = _located(spark, sf).select("myc_van_id", "email", "state_or_province", "address_line_1")
    return people.unknown_at_home(located, frame(spark, sf, "email"))


@query
def dedupe_person(spark, sf):
    ordered = [F.col(c).asc_nulls_last() for c in ("state", "voting_address", "city", "zip")]
    return windows.best_per_key(
        frame(spark, sf, "address").select("state_code", "myc_van_id", "state", "voting_address", "city", "zip"),
        ["state_code", "myc_van_id"],
        ordered,
    )


@query
def people_oos(spark, sf):
    return people.people_view(*(frame(spark, sf, n) for n in _PEOPLE))


@query
def people_oos_limit(spark, sf):
    return people.people_view(*(frame(spark, sf, n) for n in _PEOPLE), max_records=5)


@query
def people_oos_state(spark, sf):
    return people.people_view(*(frame(spark, sf, n) for n in _PEOPLE), state="NY")


# --- notes ---------------------------------------------------------------------------------


@query
def distinct_rows(spark, sf):
    return frame(spark, sf, "donor").select("actionkit_id", "occupation_clean", "employer_clean").distinct()


@query
def notes_donor(spark, sf):
    return notes.donor_notes(frame(spark, sf, "donor"), frame(spark, sf, "crosswalk"))


@query
def notes_donor_deduped(spark, sf):
    return notes.donor_notes(frame(spark, sf, "donor"), frame(spark, sf, "crosswalk"), dedupe_batch=True)


POLLING_CATEGORIES = {"NY": 1, "iowa": 2, "D.C.": 3}


@query
def notes_generic(spark, sf):
    return notes.notes_view(
        frame(spark, sf, "polling"),
        van_id=F.col("myv_van_id"),
        text=F.col("place"),
        state_code=F.col("state"),
        categories=POLLING_CATEGORIES,
    )


@query
def notes_category(spark, sf):
    """Categories that each customer's state has, over all notes."""
    states = frame(spark, sf, "polling").select(F.col("myv_van_id"), F.upper("state").alias("state_code"))
    # the category table is fixed and has 16 rows
    return states.join(F.broadcast(notes.category_table(spark)), "state_code").select(
        "myv_van_id", "state_code", "note", "note_category_id"
    )


# --- person matching -------------------------------------------------------------------------

_PII = {
    "primary_key": "pk",
    "first_name": "fname",
    "last_name": "lname",
    "phone": "phone",
    "email": "email",
    "full_address": "addr",
    "city": "city",
    "state_code": "state",
    "zip": "zip",
}
_PERSON = {f: f for f in _PII if f != "primary_key"}
MATCH = matching.MatchConfig(pii=_PII, person=_PERSON)


def _match_inputs(spark, sf):
    return frame(spark, sf, "match_source"), frame(spark, sf, "person_file")


@query
def chunk_assign(spark, sf):
    return frame(spark, sf, "customer").where(F.col("c_custkey").isNotNull()).select(
        "c_custkey", windows.chunk_of(F.col("c_custkey"), 3).alias("chunk")
    )


@query
def chunk_tiles(spark, sf):
    """Customers by balance in seven tiles that differ by one row at most."""
    customers = frame(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return windows.equal_tiles(customers, [F.desc("c_acctbal"), F.col("c_custkey")], 7, session.stage_table)


@query
def rematch_universe(spark, sf):
    return matching.rematch_universe(
        MATCH, frame(spark, sf, "match_source").select("pk", "fname", "lname"), frame(spark, sf, "earlier_match"), 3
    )


@query
def match_candidates(spark, sf):
    source, person = _match_inputs(spark, sf)
    return matching.match_candidates(MATCH, source, _index(person))


@query
def match_birth_date(spark, sf):
    """People of the same name and birth date."""
    config = matching.MatchConfig(
        pii={"primary_key": "pk", "first_name": "fname", "last_name": "lname", "birth_date": "born"},
        person={f: f for f in ("first_name", "last_name", "birth_date")},
    )
    index = session.stage_table(matching.person_index(config, frame(spark, sf, "born_person")), "born_index")
    return matching.match_candidates(config, frame(spark, sf, "born_source"), index)


@query
def match_similar(spark, sf):
    """The people most alike among those whose names are at most two letters apart."""
    source, person = _match_inputs(spark, sf)
    return similarity.similar_candidates(MATCH, source, person, session.Staging(spark, "similar"))


def _index(person):
    return session.stage_table(matching.person_index(MATCH, person), "person_index")


def _found(spark, sf, carry=True):
    source, person = _match_inputs(spark, sf)
    return matching.match_candidates(MATCH, source, _index(person), keep_unmatched=False, carry=carry)


@query
def match_best(spark, sf):
    return matching.best_match(MATCH, _found(spark, sf), frame(spark, sf, "match_source"), run_date=RUN_DATE)


@query
def match_best_plain(spark, sf):
    """Without the tie-out: score and cutoff alone decide. People are looked up by their voter id."""
    source, person = _match_inputs(spark, sf)
    config = replace(MATCH, use_extra_match=False, cutoff_threshold=0.8)
    return matching.best_match(config, _found(spark, sf, carry=False), source, person, RUN_DATE)


@query
def anti_two_tables(spark, sf):
    source = frame(spark, sf, "match_source")
    return matching.cleaning_universe(
        MATCH, source, frame(spark, sf, "earlier_match"), frame(spark, sf, "earlier_cleaned")
    ).select("pk", "fname", "lname")


@query
def dedupe_nulls_last(spark, sf):
    """One source row per state: the one with the lowest email."""
    source = frame(spark, sf, "match_source").select("state", "email", "pk")
    return windows.best_per_key(source, ["state"], [F.col("email").asc_nulls_last(), F.col("pk")])


@query
def name_guess(spark, sf):
    return matching.infer_names(MATCH, frame(spark, sf, "match_source"))


@query
def address_standardise(spark, sf):
    tidy = matching.standardise_addresses(MATCH, frame(spark, sf, "match_source"))
    return tidy.select("pk", "std_priadr", "std_secadr", "std_city", "std_state", "std_zip")


def _coalesced(spark, sf):
    source = frame(spark, sf, "match_source")
    return matching.coalesce_cleaned(
        MATCH, matching.standardise_addresses(MATCH, source), matching.infer_names(MATCH, source)
    )


@query
def cass_coalesce(spark, sf):
    return _coalesced(spark, sf)


@query
def cass_history(spark, sf):
    """The cleaning history after two runs, the second on what the first had not cleaned."""
    path = session.new_path(spark, "stage_cass")
    rows = _coalesced(spark, sf)
    before = frame(spark, sf, "earlier_cleaned")
    sinks.append_or_create(matching.cleaning_history(joins.with_keys(rows, "pk", before), RUN_DATE), path)
    rest = joins.without_keys(rows, "pk", tables.scan(spark, path))
    sinks.append_or_create(matching.cleaning_history(rest, date(2024, 3, 1)), path)
    return tables.scan(spark, path)


@query
def match_merge(spark, sf):
    source = frame(spark, sf, "match_source")
    earlier = frame(spark, sf, "earlier_match").join(source, "pk")
    return matching.merge_matches(MATCH, match_best(spark, sf), earlier)


@query
def match_run(spark, sf):
    """The whole job: two rounds over the rows to rematch, merged with the earlier output."""
    source, person = _match_inputs(spark, sf)
    earlier = frame(spark, sf, "earlier_match").join(source, "pk")
    cleaned = frame(spark, sf, "earlier_cleaned")
    return matching.match(MATCH, source, person, earlier, cleaned, RUN_DATE).matches


@query
def match_run_first(spark, sf):
    """The whole job on its first run: no earlier output, nothing cleaned yet."""
    return matching.match(MATCH, *_match_inputs(spark, sf), run_date=RUN_DATE).matches


@query
def match_run_plain(spark, sf):
    """The whole job with cleaning and tie-out switched off: one round."""
    config = replace(MATCH, enable_cleaning=False, use_extra_match=False)
    return matching.match(config, *_match_inputs(spark, sf), run_date=RUN_DATE).matches


@query
def match_pipeline(spark, sf):
    """The whole matching job, by the name the survey gives it."""
    return match_job(spark, sf)


@query
def match_job(spark, sf):
    """Two runs of the recurring job, the second over its own output; the published table."""
    output = VersionedTable(spark, session.new_name("matched"), key="pk", buckets=8)
    history = VersionedTable(spark, session.new_name("cleaned"), key="pk", buckets=8)
    source, person = _match_inputs(spark, sf)
    index = _index(person)
    matching.match_job(MATCH, source, person, output, history, RUN_DATE, index)
    return matching.match_job(MATCH, source, person, output, history, date(2024, 3, 1), index)


# --- audit ------------------------------------------------------------------------------------


def _workflows(spark, sf):
    return frame(spark, sf, "workflow_flat").select(
        "id",
        "name",
        "state",
        F.struct(F.col("user_name").alias("name")).alias("user"),
        F.struct("scheduled").alias("schedule"),
        "definition",
    )


def _one_run():
    return F.array(F.struct(F.col("run_state").alias("state"), "started_at", "finished_at"))


ALLOWED = [3, 5, 8, 13, 21]


@query
def audit_workflows(spark, sf):
    listed = audit.workflow_audit(_workflows(spark, sf), ALLOWED)
    return listed.withColumn("job_ids", lists.list_to_text(F.col("job_ids")))


@query
def audit_job_ids(spark, sf):
    """Ids read back from the text form of the lists."""
    listed = audit.workflow_audit(_workflows(spark, sf))
    as_text = F.concat(F.lit("['"), F.array_join("job_ids", "', '"), F.lit("', None]"))
    return audit.workflow_job_ids(listed.withColumn("job_ids", as_text))


@query
def audit_runtime(spark, sf):
    shown = frame(spark, sf, "run").select("event_id", _one_run().alias("runs"))
    return shown.select(
        "event_id",
        runs.latest_runtime(F.col("runs")).alias("latest_runtime"),
        runs.runtime_seconds(F.col("runs")).alias("runtime_seconds"),
    )


def _all_runs(spark, sf):
    return frame(spark, sf, "run").select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("job_id"), F.col("run_state").alias("state"),
        "started_at", "finished_at",
    )


@query
def audit_newest_run(spark, sf):
    """The newest run of each job, out of all runs."""
    found = audit.newest_runs(_all_runs(spark, sf))
    return found.select(
        "job_id", "run.state", runs.runtime_text(F.col("run")).alias("latest_runtime"),
        runs.run_seconds(F.col("run")).alias("runtime_seconds"),
    )


@query
def audit_jobs(spark, sf):
    jobs = frame(spark, sf, "job_flat")
    return audit.job_audit(audit.workflow_audit(_workflows(spark, sf), ALLOWED), jobs, _all_runs(spark, sf))
