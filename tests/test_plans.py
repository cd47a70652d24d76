"""What the planner makes of the queries: no Python, no global windows, limits before shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from checks.inputs import frame
from checks.queries import MATCH, QUERIES
from fieldloom import session
from fieldloom.functions import zones
from fieldloom.operators import joins, windows
from fieldloom.plans import load, matching
from fieldloom.sources.versions import VersionedTable

SF = "/root/testdata/sf0.001"

# queries that stage, load or stream would run to be planned; their parts are here
PLANNED = [
    "view_survey", "view_survey_second", "view_volunteer", "view_support", "view_myc_only", "load_survey_new",
    "people_oos", "people_oos_limit", "notes_donor", "notes_donor_deduped", "notes_generic", "notes_category",
    "anti_two_tables", "dedupe_person", "dedupe_nulls_last", "name_guess", "address_standardise", "cass_coalesce",
    "rematch_universe", "audit_workflows", "audit_job_ids", "audit_jobs", "audit_runtime", "tz_local_time",
    "fn_duration_text", "fn_initcap", "fn_date_formats", "agg_count_diff", "chunk_assign",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_pair_loops(spark, no_broadcast, name):
    shown = plan(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert node not in shown
    # the only single partitions are those of ungrouped counts
    if name != "agg_count_diff":
        assert "SinglePartition" not in shown


@pytest.mark.parametrize("name", ["people_oos", "dedupe_person", "dedupe_nulls_last", "notes_donor_deduped", "name_guess"])
def test_best_row_is_chosen_before_the_shuffle(spark, no_broadcast, name):
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan(QUERIES[name](spark, SF)))


def test_person_index_is_cut_before_the_shuffle(spark):
    shown = plan(matching.person_index(MATCH, frame(spark, SF, "person_file")))
    assert re.search(r"Exchange hashpartitioning\(key.*\n.*WindowGroupLimit.*dense_rank.*Partial", shown)


def test_merge_is_cut_before_the_shuffle(spark):
    source = frame(spark, SF, "match_source")
    one_round = source.selectExpr(
        "'P' as person_id", "email as voterbase_id", "0.5D as score", "date '2024-01-01' as matched_date", "*"
    )
    assert re.search(r"WindowGroupLimit.*Partial", plan(matching.merge_matches(MATCH, one_round, one_round)))


def test_anti_joins_are_plain(spark, no_broadcast, rows):
    records, log = rows("sq_hash string", ("a",)), rows("sq_hash string, loaded boolean", ("a", True))
    shown = plan(joins.without_loaded(records, log, "sq_hash"))
    assert "LeftAnti" in shown and "isnull" not in shown


def test_signups_are_reduced_before_they_are_joined(spark, no_broadcast):
    shown = plan(QUERIES["people_oos"](spark, SF))
    scan = shown.index("orders.parquet")
    # partial aggregation sits between the scan of signups and their first exchange
    above = shown[:scan]
    assert above.rindex("HashAggregate") > above.rindex("Exchange")


def test_contacts_are_pruned_at_the_scan(spark):
    shown = plan(QUERIES["src_scan"](spark, SF))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>", shown)
    shown = plan(QUERIES["src_param_sql"](spark, SF))
    assert re.search(r"PushedFilters: \[.*EqualTo\(o_orderstatus,O\).*GreaterThan\(o_totalprice", shown)


def test_local_time_is_generated_code(spark):
    df = frame(spark, SF, "events").select(zones.local_time(F.col("event_type"), F.col("ts")).alias("t"))
    shown = plan(df)
    assert "Join" not in shown and re.search(r"\*\(1\) Project", shown)


def test_skewed_best_per_key_sends_one_row_per_task(spark):
    """A key with a third of the rows arrives as at most one row of each map task."""
    df = spark.range(0, 90000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"), "id")
    best = windows.best_per_key(df, ["k"], [F.desc("id")])
    rows = best.collect()
    assert len(rows) == 51 and max(r.id for r in rows) == 89999
    shown = plan(best)
    assert re.search(r"WindowGroupLimit.*Partial", shown)


@pytest.fixture
def tiny_skew(spark, no_broadcast):
    """Settings under which a few kilobytes are a skewed partition."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


PEOPLE = matching.MatchConfig(
    pii={"primary_key": "id", "first_name": "f", "last_name": "l", "zip": "z"},
    person={"first_name": "f", "last_name": "l", "zip": "z"},
    rules=[matching.MatchRule(0.9, {"first_name": "exact", "last_name": "exact", "zip": "exact"})],
)


def many(spark, hot_id=False):
    """60,000 rows of which a third share their names and zip, or their id."""
    hot = F.col("id") % 3 == 0
    own = F.md5(F.col("id").cast("string"))
    rows = spark.range(60000).select(
        F.when(hot, 0).otherwise(F.col("id")).alias("id") if hot_id else F.col("id"),
        F.lit("ann").alias("f"),
        own.alias("l") if hot_id else F.when(hot, "li").otherwise(own).alias("l"),
        F.lit("10001").alias("z"),
    )
    return session.stage_table(rows.repartition(8), "many")


def test_hot_match_key_is_split(spark, tiny_skew):
    """The adaptive planner splits a key that a third of the sources share."""
    people = many(spark)
    index = matching.person_index(PEOPLE, people.withColumn("voterbase_id", F.format_string("V%06d", "id")))
    found = matching.match_candidates(PEOPLE, people, session.stage_table(index, "index"), keep_unmatched=False)
    total = found.agg(F.count("*").alias("n"), F.max("matched_id").alias("m"))
    (row,) = total.collect()
    # the third finds the three lowest ids among themselves, the rest only their own
    assert row.n == 20000 * 3 + 40000
    assert "skew=true" in plan(total)


def test_hot_source_id_is_split(spark, tiny_skew, rows):
    """So with an id that a third of the source rows carry, when the best match is chosen."""
    source = many(spark, hot_id=True)
    ids = source.select("id").distinct()
    found = ids.selectExpr("id as source_id", "'V1' as matched_id", "0.9D as score")
    people = rows("person_id string, voterbase_id string, f string, l string, z string", ("P1", "V1", "a", "b", "1"))
    best = matching.best_match(PEOPLE, session.stage_table(found, "found"), source, people)
    shared = F.when(F.col("id") == 0, F.col("l"))
    total = best.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.max(shared).alias("l"))
    (row,) = total.collect()
    assert row.n == row.ids == 40001
    # of the rows with the shared id the first one in order counts
    assert row.l == source.where("id = 0").agg(F.min("l")).first()[0]
    assert "skew=true" in plan(total)


# -- joins that use a layout


def by_key(spark, df, key, buckets=4):
    table = VersionedTable(spark, session.new_name("laid_out"), key=key, buckets=buckets)
    table.publish(df)
    return table


def exchanges(shown):
    return len(re.findall(r"Exchange (?:hash|range|Single)", shown))


def test_joins_with_keyed_tables_shuffle_one_side(spark, no_broadcast):
    """The later run of the matching job: neither output nor history is shuffled."""
    source = frame(spark, SF, "match_source")
    earlier = by_key(spark, frame(spark, SF, "earlier_match").join(source, "pk"), "pk")
    cleaned = by_key(spark, frame(spark, SF, "earlier_cleaned"), "pk")
    shown = plan(matching.rematch_universe(MATCH, source, earlier.read()))
    assert "SortMergeJoin" in shown and exchanges(shown) == 1
    shown = plan(matching.cleaning_universe(MATCH, source, earlier.read(), cleaned.read()))
    assert shown.count("SortMergeJoin") == 2 and exchanges(shown) == 1
    # two tables laid out alike are joined where they lie
    assert exchanges(plan(earlier.read().join(cleaned.read(), "pk"))) == 0
    assert exchanges(plan(earlier.read().groupBy("pk").count())) == 0


def test_a_run_does_not_shuffle_the_loaded_hashes(spark, no_broadcast):
    form = load.survey_format()
    log = load.LoadLog(spark, session.new_name("plan_log"), form, buckets=4)
    records = QUERIES["view_support"](spark, SF)
    load.IncrementalLoad(log).run(records.limit(50), lambda df, run_id: None, "1")
    log.compact()
    shown = plan(log.new(session.stage_table(records, "records")))
    # the records, and the marks made since (none)
    assert shown.count("SortMergeJoin LeftAnti") + shown.count("LeftAnti") >= 2 and exchanges(shown) == 2
    assert re.search(r"FileScan parquet \S*plan_log\S*loaded\S*\[sq_hash.*Bucketed: true", shown)
    log.drop()


def test_best_match_shuffles_five_times(spark, no_broadcast):
    """Keys of sources and index, pairs, candidates and sources by id; the person file is not read again."""
    source = frame(spark, SF, "match_source")
    index = session.stage_table(matching.person_index(MATCH, frame(spark, SF, "person_file")), "index")
    found = matching.match_candidates(MATCH, source, index, keep_unmatched=False, carry=True)
    shown = plan(matching.best_match(MATCH, found, source))
    assert exchanges(shown) == 5 and shown.count("part.parquet") == 2
