"""Person matching: candidates against brute force, the choice of a match, the whole job."""

import random
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.plans import matching
from fieldloom.plans.matching import MatchConfig, MatchRule
from fieldloom.sources.versions import VersionedTable

DAY = date(2024, 2, 1)
FIELDS = ["first_name", "last_name", "state_code", "zip", "email"]
CONFIG = MatchConfig(pii={"primary_key": "pk", **{f: f for f in FIELDS}}, person={f: f for f in FIELDS})
SOURCE = "pk bigint, first_name string, last_name string, state_code string, zip string, email string"
PERSON = (
    "person_id string, voterbase_id string, first_name string, last_name string, state_code string, zip string,"
    " email string"
)


def near(a, b):
    less = lambda s: {s} | ({s[:i] + s[i + 1:] for i in range(len(s))} if len(s) > 1 else set())
    return bool(less(a) & less(b))


def agree(how, a, b):
    if a is None or b is None:
        return False
    if how == "near":
        return near(a, b)
    return a[:3] == b[:3] if how == "prefix3" else a == b


def brute_force(config, sources, persons, k):
    found = {}
    for pk, *values in sources:
        s = dict(zip(FIELDS, values))
        scores = {}
        for _, vid, *theirs in persons:
            p = dict(zip(FIELDS, theirs))
            for rule in config.rules:
                if set(rule.fields) <= set(FIELDS) and all(agree(how, s[f], p[f]) for f, how in rule.fields.items()):
                    scores[vid] = max(scores.get(vid, 0), rule.score)
        for vid, score in sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]:
            found[pk, vid] = score
    return found


def made_up(seed, n):
    """Sources and persons of which a third share all names, state and zip."""
    rng = random.Random(seed)
    firsts = ["anna", "ann", "ana", "bob", "bobby", "c", None]
    lasts = ["smith", "smit", "smyth", "li", "l", None]

    def fields(i):
        if i % 3 == 0:
            return ("anna", "smith", "ny", "10001", rng.choice([None, "hot@x.org"]))
        return (
            rng.choice(firsts), rng.choice(lasts), rng.choice(["ny", "il", None]), rng.choice(["10001", "60601", None]),
            rng.choice([None, "hot@x.org", f"{rng.randrange(n)}@x.org"]),
        )

    sources = [(i, *fields(i)) for i in range(n)]
    persons = [(None if i % 10 == 0 else f"P{i}", f"V{rng.randrange(n):04d}", *fields(i)) for i in range(n)]
    return sources, persons


@pytest.mark.parametrize("seed, k", [(1, 3), (2, 1), (3, 5)])
def test_candidates_against_brute_force(rows, seed, k):
    sources, persons = made_up(seed, 90)
    config = replace(CONFIG, matches_per_id=k)
    index = session.stage_table(matching.person_index(config, rows(PERSON, *persons)), "index")
    # no key of the index holds more than k ids, however many people share it
    assert index.groupBy("key").agg(F.countDistinct("matched_id").alias("n")).agg(F.max("n")).first()[0] <= k
    got = matching.match_candidates(config, rows(SOURCE, *sources), index).collect()
    found = {(r.source_id, r.matched_id): r.score for r in got if r.matched_id is not None}
    assert found == brute_force(config, sources, persons, k)
    # a source without candidates is there once
    assert {r.source_id for r in got} == {s[0] for s in sources}
    assert len(got) == len({(r.source_id, r.matched_id) for r in got})


def test_no_key_no_candidate(rows):
    index = matching.person_index(CONFIG, rows(PERSON, ("P", "V", None, "", " ", None, None)))
    got = matching.match_candidates(CONFIG, rows(SOURCE, (1, None, "", " ", None, None), (None, "a", "b", "c", "1", "e")), index)
    assert [tuple(r) for r in got.collect()] == [(1, None, None)]


def test_rules_need_mapped_fields():
    config = replace(CONFIG, pii={"primary_key": "pk", "email": "email", "zip": None})
    assert [r.score for _, r in config.rules_in_use()] == [0.5]
    with pytest.raises(ValueError):
        replace(CONFIG, pii={"email": "email"}).key  # noqa: B018
    with pytest.raises(ValueError):
        replace(CONFIG, pii={"primary_key": "pk", "shoe_size": "x"}).mapped  # noqa: B018


CAND = "source_id bigint, matched_id string, score double"


def best(rows, candidates, persons, sources=((1, "Ann", "Li", "ny", "1", None),), config=CONFIG):
    df = matching.best_match(config, rows(CAND, *candidates), rows(SOURCE, *sources), rows(PERSON, *persons), DAY)
    return df.collect()


TIE = ("P1", "V1", "ANNABEL", "li", "NY", None, None)
OTHER = ("P2", "V2", "Joe", "Doe", "NY", None, None)


def test_tie_out_beats_score(rows):
    (r,) = best(rows, [(1, "V1", 0.2), (1, "V2", 0.9)], [TIE, OTHER])
    assert (r.voterbase_id, r.score, r.matched_date, r.pk) == ("V1", 0.2, DAY, 1)
    (r,) = best(rows, [(1, "V1", 0.2), (1, "V2", 0.9)], [TIE, OTHER], config=replace(CONFIG, use_extra_match=False))
    assert r.voterbase_id == "V2"


def test_ranked_first_then_filtered(rows):
    # the best has no person id: the second best is not tried
    nobody = (None, "V1", "x", "y", "NY", None, None)
    assert best(rows, [(1, "V1", 0.9), (1, "V2", 0.8)], [nobody, OTHER]) == []
    # nor if the person file does not know it
    assert best(rows, [(1, "V9", 0.9), (1, "V2", 0.8)], [OTHER]) == []


@pytest.mark.parametrize("score, person, kept", [(0.4, OTHER, 1), (0.39, OTHER, 0), (0.39, TIE, 1)])
def test_cutoff(rows, score, person, kept):
    assert len(best(rows, [(1, person[1], score)], [person])) == kept


def test_null_state_is_no_tie_out(rows):
    nowhere = ("P1", "V1", "ann", "li", None, None, None)
    assert best(rows, [(1, "V1", 0.1)], [nowhere], [(1, "Ann", "Li", None, "1", None)]) == []
    # a wildcard in the data is not a pattern
    assert best(rows, [(1, "V1", 0.1)], [("P1", "V1", "ann", "%", "NY", None, None)]) == []


def test_unmatched_candidates_are_ignored(rows):
    assert best(rows, [(1, None, None)], [OTHER]) == []


def test_rematch_universe(rows):
    source = rows("pk bigint", (1,), (2,), (3,), (4,))
    previous = rows("pk bigint, score double", (1, 0.59), (2, 0.6), (3, None))
    got = matching.rematch_universe(CONFIG, source, previous, 2)
    assert sorted(r.pk for r in got.collect()) == [1, 3, 4]
    first = matching.rematch_universe(CONFIG, source)
    assert first.schema == got.schema and first.count() == 4


def test_merge_is_idempotent(rows):
    schema = "person_id string, voterbase_id string, score double, matched_date date, " + SOURCE
    row = lambda pk, v, s, d: ("P", v, s, date(2024, 1, d), pk, None, None, None, None, None)
    new = rows(schema, row(1, "V1", 0.5, 2), row(2, "V2", 0.5, 2), row(3, "V5", 0.5, 1))
    old = rows(schema, row(1, "V9", 0.9, 1), row(2, "V3", 0.5, 1), row(3, "V4", 0.5, 1))
    merged = matching.merge_matches(CONFIG, new, None, old)
    assert sorted((r.pk, r.voterbase_id) for r in merged.collect()) == [(1, "V9"), (2, "V2"), (3, "V4")]
    again = matching.merge_matches(CONFIG, merged, merged)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)


def test_coalesce_falls_back_to_raw_values(rows):
    pii = {"primary_key": "pk", "first_name": "first_name", "full_address": "addr", "zip": "zip"}
    config = MatchConfig(pii=pii)
    df = rows("pk bigint, first_name string, addr string, zip string, other int",
              (1, "ann marie", "1 Main Street", "12", 0), (None, "x", "y", "z", 0), (2, None, None, "x" * 300, 0))
    tidy = matching.coalesce_cleaned(config, matching.standardise_addresses(config, df), matching.infer_names(config, df))
    got = {r.pk: tuple(r) for r in tidy.collect()}
    assert got == {1: (1, "Ann ", "1 MAIN ST", "12"), 2: (2, None, None, "x" * 300)}


def test_names_of_unmapped_columns(rows):
    config = MatchConfig(pii={"primary_key": "pk", "zip": "zip"})
    df = rows("pk bigint, zip string", (1, "1"), (1, "2"), (2, "3"))
    assert sorted(map(tuple, matching.infer_names(config, df).collect())) == [(1, None, None), (2, None, None)]


def test_names_prefer_the_row_with_an_email(rows):
    df = rows(SOURCE, (1, "zoe", "x", None, None, None), (1, "amy", "x", None, None, "b@x.org"))
    (r,) = matching.infer_names(CONFIG, df).collect()
    assert r.first_name_guess == "Amy"


def test_cleaning_universe(rows):
    universe = rows("pk bigint", (1,), (2,), (3,), (None,))
    found, cleaned = rows("pk bigint", (1,)), rows("pk bigint", (2,), (2,))
    assert sorted((r.pk for r in matching.cleaning_universe(CONFIG, universe, found, cleaned).collect()), key=str) == [3, None]
    assert matching.cleaning_universe(CONFIG, universe, found).count() == 3


PEOPLE = [
    ("P1", "V1", "Ann", "Li", "NY", "10001", "ann@x.org"),
    ("P2", "V2", "Bob", "Stone", "IL", "60601", None),
]


def test_whole_job(spark, rows):
    source = rows(
        SOURCE,
        (1, "Ann", "Li", "ny", "10001", None), (1, "Ann", "Li", "ny", "10001", None),
        (2, "bob stone", None, "illinois", "60601-11", None),
        (3, "No", "Body", "ny", "1", None), (None, "Ann", "Li", "ny", "10001", None),
    )
    output, history = (VersionedTable(spark, session.new_name(n), key="pk", buckets=4) for n in ("out", "history"))
    first = matching.match_job(CONFIG, source, rows(PERSON, *PEOPLE), output, history, DAY)
    got = {r.pk: (r.voterbase_id, r.score, r.last_name, r.state_code) for r in first.collect()}
    # the second is found only after its name was split and its address cleaned
    assert got == {1: ("V1", 0.85, "Li", "ny"), 2: ("V2", 0.85, "Stone", "IL")}
    cleaned = history.read()
    assert sorted((r.pk, r.cass_date) for r in cleaned.collect()) == [(2, DAY), (3, DAY)]
    # another run changes nothing: both scores are above the threshold, the third row was cleaned before
    again = matching.match_job(CONFIG, source, rows(PERSON, *PEOPLE), output, history, date(2024, 3, 1))
    assert {r.pk: r.matched_date for r in again.collect()} == {1: DAY, 2: DAY}
    assert history.read().count() == 2


def test_custom_rules(rows):
    config = replace(CONFIG, rules=[MatchRule(0.9, {"zip": "prefix2"})])
    index = matching.person_index(config, rows(PERSON, *PEOPLE))
    got = matching.match_candidates(config, rows(SOURCE, (1, None, None, None, "10999", None)), index)
    assert [tuple(r) for r in got.collect()] == [(1, "V1", 0.9)]
    with pytest.raises(ValueError):
        matching.person_index(replace(CONFIG, rules=[MatchRule(0.9, {"zip": "sounds"})]), rows(PERSON, *PEOPLE))


def test_index_of_a_repeated_id_and_a_long_name(spark, rows):
    import pyspark.sql.functions as F

    repeated = spark.range(5000).select(
        F.lit("P").alias("person_id"), F.lit("V1").alias("voterbase_id"), F.lit("ann").alias("first_name"),
        F.lit("lee").alias("last_name"), F.lit("il").alias("state_code"), F.lit("1").alias("zip"),
        F.format_string("%d@x.org", "id").alias("email"),
    )
    config = MatchConfig(
        pii={"primary_key": "pk", "first_name": "f", "last_name": "l", "state_code": "s", "zip": "z", "email": "e"},
        person={f: f for f in ("first_name", "last_name", "state_code", "zip", "email")},
    )
    index = matching.person_index(config, repeated)
    assert index.groupBy("key").count().agg({"count": "max"}).first()[0] == 1
    long = repeated.limit(1).withColumn("last_name", F.repeat(F.lit("abcd"), 500))
    made = matching.person_index(config, long).select(F.length("key").alias("n")).agg({"n": "sum", "*": "count"}).first()
    assert made["sum(n)"] == 16 * made["count(1)"] and made["count(1)"] < 2100


def test_phones_are_compared_whole(rows):
    import pyspark.sql.functions as F

    from fieldloom.functions import matchkeys

    numbers = ["+1 (555) 123-4567", "5551234567", "1-555-123-4567", "+44 20 5551 234567", "15551234567890", "1234567", "", None]
    df = rows("p string", *[(n,) for n in numbers]).select(matchkeys.normal("phone", F.col("p")).alias("n"))
    assert [r.n for r in df.collect()] == ["5551234567"] * 3 + ["44205551234567", "15551234567890", "1234567", None, None]


def test_repeated_id_stands_with_its_lowest_person(spark, rows):
    """All rows of an id are found; what is carried is one row's, the same under every key."""
    people = rows(
        PERSON,
        ("P9", "V1", "Ann", "Li", "NY", "10001", None), ("P3", "V1", "Anna", "Lee", "CA", "90001", "a@x.org"),
        (None, "V1", "Ann", "Li", "NY", "10001", "b@x.org"), ("P5", None, "Ann", "Li", "NY", "10001", None),
    )
    index = session.stage_table(matching.person_index(CONFIG, people), "index")
    assert {tuple(r)[2:] for r in index.collect()} == {("P3", "CA", "Ann", "Lee")}
    assert index.count() == index.select("key").distinct().count()
    source = rows(SOURCE, (1, "Ann", "Li", "ny", "10001", None), (2, "x", "y", "ca", None, "A@x.org"))
    found = matching.match_candidates(CONFIG, source, index, keep_unmatched=False, carry=True)
    assert sorted((r.source_id, r.matched_id, r.score, r.person_id) for r in found.collect()) == [
        (1, "V1", 0.85, "P3"), (2, "V1", 0.5, "P3"),
    ]
    assert sorted(r.pk for r in matching.best_match(CONFIG, found, source, run_date=DAY).collect()) == [1, 2]


def test_rules_form_blocks_by_their_fields():
    fields = ["phone", "email", "full_address", "city", "birth_date"]
    config = MatchConfig(
        pii={**CONFIG.pii, **{f: f for f in fields}}, person={**CONFIG.person, **{f: f for f in fields}}
    )
    blocks = {fields: [r.score for _, r in rules] for fields, rules in config.blocks()}
    assert blocks == {
        ("email", "last_name"): [0.98, 0.5], ("last_name", "phone"): [0.96, 0.45],
        ("birth_date", "first_name", "last_name"): [0.95], ("first_name", "full_address", "last_name", "zip"): [0.92],
        ("first_name", "last_name", "zip"): [0.85, 0.75, 0.7, 0.65],
        ("city", "first_name", "last_name", "state_code"): [0.55, 0.35, 0.25],
    }
    assert MatchConfig(pii={"primary_key": "pk"}, person={}).blocks() == []


def test_keys_are_made_once_of_equal_values(spark, rows, monkeypatch):
    """900 sources and 900 people of three names: keys are made of their names, not of each record."""
    made = []
    keyed = matching._keyed

    def counted(config, frame, *more, **named):
        made.append(frame.count())
        return keyed(config, frame, *more, **named)

    monkeypatch.setattr(matching, "_keyed", counted)
    names = [("Ann", "Li"), ("Bob", "Ray"), ("Cy", "Dee")]
    people = rows(PERSON, *[(f"P{i}", f"V{i:04d}", *names[i % 3], "NY", "10001", None) for i in range(900)])
    source = rows(SOURCE, *[(i, *names[i % 3], "ny", "10001", None) for i in range(900)])
    index = session.stage_table(matching.person_index(CONFIG, people), "index")
    found = matching.match_candidates(CONFIG, source, index, keep_unmatched=False).collect()
    # two blocks of each name, and the three lowest people of each
    assert made == [3 * 2 * 3, 3 * 2]
    assert sorted(map(tuple, found)) == [(i, f"V{i % 3 + 3 * k:04d}", 0.85) for i in range(900) for k in range(3)]


def test_records_without_a_usable_rule(spark, rows):
    config = MatchConfig(pii={"primary_key": "pk", "email": "email"}, person={"zip": "zip"})
    index = session.stage_table(matching.person_index(config, rows(PERSON, ("P1", "V1", "a", "b", "NY", "1", "e"))), "index")
    found = matching.match_candidates(config, rows(SOURCE, (1, "a", "b", "NY", "1", "e")), index)
    assert [tuple(r) for r in found.collect()] == [(1, None, None)]


def test_both_runs_of_the_job_share_one_index(spark, monkeypatch):
    from checks.queries import QUERIES

    made = []
    person_index = matching.person_index
    monkeypatch.setattr(matching, "person_index", lambda *a, **k: made.append(a) or person_index(*a, **k))
    assert QUERIES["match_job"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 1
