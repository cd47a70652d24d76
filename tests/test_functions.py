"""Column functions on hand-made values."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import address, codes, dates, hashing, lists, matchkeys, names, runs, text, zones


def value(spark, column, **columns):
    """The value of an expression over one row."""
    kinds = {str: "string", int: "bigint", float: "double", datetime: "timestamp_ntz", type(None): "string"}
    schema = ", ".join(f"{n} {kinds[type(v)]}" for n, v in columns.items()) or "x int"
    return spark.createDataFrame([tuple(columns.values()) or (1,)], schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("mary-jane o'neil", "Mary-Jane O'Neil"),
        ("3rd ave a1b", "3rd Ave A1b"),
        ("éLAN vItal", "Élan Vital"),
        ("  two  spaces ", "  Two  Spaces "),
        ("a.b_c", "A.B_C"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap(spark, given, wanted):
    assert value(spark, text.initcap_words(F.col("s")), s=given) == wanted


@pytest.mark.parametrize(
    "seconds, words, clock",
    [
        (3661, "1 hour, 1 minute, 1.0000 second", "01:01:1.0000"),
        (86400, "1 day", "1 day:00:00"),
        (2 * 86400 + 59.5, "2 days, 59.5000 seconds", "2 days:00:59.5000"),
        (0, "", "00:00"),
        (7200, "2 hours", "02:00:00"),
    ],
)
def test_duration(spark, seconds, words, clock):
    assert value(spark, text.seconds_to_text(F.col("s")), s=float(seconds)) == words
    assert value(spark, text.seconds_to_text(F.col("s"), as_clock=True), s=float(seconds)) == clock


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "state, ts, wanted",
    [
        ("D.C.", datetime(2024, 7, 1, 3), datetime(2024, 6, 30, 23)),
        ("washington dc", datetime(2024, 1, 1, 3), datetime(2023, 12, 31, 22)),
        ("district of columbia", datetime(2024, 7, 1, 3), None),
        ("PR", datetime(2024, 7, 1, 3), None),
        ("az", datetime(2024, 7, 1, 3), datetime(2024, 6, 30, 21)),
        ("Hawaii", datetime(2024, 7, 1, 3), datetime(2024, 6, 30, 17)),
        ("Alaska", datetime(2024, 3, 10, 10, 30), datetime(2024, 3, 10, 1, 30)),
        (None, datetime(2024, 7, 1, 3), None),
    ],
)
def test_local_time(spark, session_zone, state, ts, wanted):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        assert value(spark, zones.local_time(F.col("s"), F.col("t")), s=state, t=ts) == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_every_state_has_a_zone(spark):
    spellings = [s for code, name, _ in zones.STATES for s in (code, name)]
    df = spark.createDataFrame([(s,) for s in spellings], "s string")
    assert len(spellings) == 102
    assert df.where(zones.zone_of(F.lower("s")).isNull()).count() == 0


def test_date_formats_keep_wall_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist on that day in that zone
        ts = datetime(2024, 3, 10, 2, 30, 5, 250000)
        got = value(spark, dates.date_formats(F.col("t")), t=ts)
        assert tuple(got) == ("2024-03-10", "2024-03-10 02:30:05", "20240310", "20240310_023005", ts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hhmm_window(spark):
    inside = lambda h, m: value(spark, dates.hhmm_between(F.col("t"), 0, 100), t=datetime(2024, 7, 1, h, m))
    assert [inside(3, 59), inside(4, 0), inside(5, 0), inside(5, 1)] == [False, True, True, False]
    local = dates.local_hhmm_between(F.col("t"), 2300, 2359)
    assert value(spark, local, t=datetime(2024, 7, 1, 3, 30)) and not value(spark, local, t=datetime(2024, 1, 1, 3, 30))


def test_date_in_zone(spark):
    got = [value(spark, dates.date_in(F.col("t"), z), t=datetime(2024, 1, 1, 5, 30)) for z in ("utc", "est", "cst", "pst")]
    assert got == [date(2024, 1, 1), date(2024, 1, 1), date(2023, 12, 31), date(2023, 12, 31)]


def test_hashes(spark):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert value(spark, hashing.hash_strict(F.col("a"), F.col("b")), a="x", b=7) == md5("x7")
    assert value(spark, hashing.hash_strict(F.col("a"), F.col("b")), a="x", b=None) is None
    assert value(spark, hashing.hash_coalesced(F.col("a"), F.col("b")), a=None, b="IL") == md5("missingIL")
    # without separators on purpose
    assert md5("abc") == value(spark, hashing.hash_strict(F.col("a"), F.col("b")), a="ab", b="c")


def test_lists(spark):
    split = lambda s, cast=None: value(spark, lists.text_to_list(F.col("s"), cast), s=s)
    assert (split("a,b"), split(""), split(None), split("1,2", "int")) == (["a", "b"], [], [], [1, 2])
    joined = lists.list_to_text(F.array(F.lit(1), F.lit(None), F.lit(3)))
    assert value(spark, joined) == "1,None,3"
    flags = [value(spark, lists.is_true_text(F.col("s")), s=s) for s in ("true", "True", None)]
    assert flags == [True, False, False]


@pytest.mark.parametrize(
    "definition, wanted",
    [
        ("version: 2\n  job_id: 12\n  x: y\n  job_id: None\n", ["12", "None"]),
        ("job_id: job_id: 5\n", ["", "5"]),
        ("job_id: 7", ["7"]),
        ("nothing", []),
    ],
)
def test_job_ids_in_definition(spark, definition, wanted):
    assert value(spark, lists.job_ids_in(F.col("s")), s=definition) == wanted


def test_usable_ids(spark):
    ids = spark.createDataFrame([("['1', 'None', None, '-3', '7', 'x']",)], "s string")
    got = ids.select(F.explode(lists.id_texts(F.col("s"))).alias("i")).select(lists.usable_id(F.col("i")).alias("i"))
    assert [r.i for r in got.where("i is not null").collect()] == [1, 7]


@pytest.mark.parametrize(
    "state, start, end, shown, seconds",
    [
        ("succeeded", "2024-01-01T23:59:30.000Z", "2024-01-02T00:00:30.000Z", "-1 day, 0:01:00", 60),
        ("failed", "2024-01-01T08:00:00Z", "2024-01-01T19:05:09Z", "11:05:09", 39909),
        ("succeeded", "2024-01-01T08:00:00Z", "2024-01-01T08:00:00Z", "0:00:00", 0),
        ("running", "2024-01-01T08:00:00Z", "2024-01-01T08:00:01Z", None, None),
        ("succeeded", "2024-01-01T08:00:00Z", None, None, None),
        ("succeeded", "2024-01-01T25:00:00Z", "2024-01-01T08:00:01Z", None, None),
        (None, "2024-01-01T08:00:00Z", "2024-01-01T08:00:01Z", "0:00:01", 1),
    ],
)
def test_runtime(spark, state, start, end, shown, seconds):
    schema = "runs array<struct<state:string,started_at:string,finished_at:string>>"
    older = ("succeeded", "2020-01-01T00:00:00Z", "2020-01-01T09:00:00Z")
    df = spark.createDataFrame([([(state, start, end), older],)], schema)
    got = df.select(runs.latest_runtime(F.col("runs")).alias("t"), runs.runtime_seconds(F.col("runs")).alias("s")).first()
    assert tuple(got) == (shown, seconds)


def test_no_runs(spark):
    schema = "runs array<struct<state:string,started_at:string,finished_at:string>>"
    got = spark.createDataFrame([([],), (None,)], schema).select(runs.latest_runtime(F.col("runs")).alias("t")).collect()
    assert [r.t for r in got] == [None, None]


@pytest.mark.parametrize(
    "first, last, email, wanted",
    [
        ("mary and john", "smith", None, ("Mary", "Smith")),
        ("mary & john", None, None, ("Mary", "& John")),
        ("mary ann", None, None, ("Mary ", "Ann")),
        ("Mary", None, None, ("Mary", None)),
        ("mary", None, None, ("Mary", "Mary")),
        (None, None, "a.b@x.org", ("A", "B")),
        (None, None, "ab@x.org", (None, "Ab")),
        (None, None, "no mail", (None, None)),
        (None, None, "@x.org", (None, None)),
        (None, "li", "ann_li.2@x.org", (None, "Li")),
        (None, None, "j.r.tolkien99@x.org", ("J", "Tolkien")),
        ("", "x", None, ("", "X")),
        ("mary-jane", "o'neil", "z@x.org", ("Mary-Jane", "O'Neil")),
    ],
)
def test_name_guesses(spark, first, last, email, wanted):
    df = spark.createDataFrame([(first, last, email)], "f string, l string, e string")
    got = df.select(*names.name_guesses(F.col("f"), F.col("l"), F.col("e"))).first()
    assert tuple(got) == wanted


@pytest.mark.parametrize(
    "line, unit, wanted",
    [
        ("12 north Main Street, Apt. 4b", None, ("12 N MAIN ST", "APT 4B")),
        ("12 main st #7", None, ("12 MAIN ST", "# 7")),
        ("12 main st", "suite 9", ("12 MAIN ST", "STE 9")),
        ("12  Main   Ave.", "", ("12 MAIN AVE", None)),
        (None, None, (None, None)),
        ("", None, (None, None)),
    ],
)
def test_street_and_unit(spark, line, unit, wanted):
    df = spark.createDataFrame([(line, unit)], "a string, u string")
    got = df.select(address.standard_street(F.col("a")), address.standard_unit(F.col("a"), F.col("u"))).first()
    assert tuple(got) == wanted


def test_state_and_zip(spark):
    state = [value(spark, address.standard_state(F.col("s")), s=s) for s in (" new york", "d.c.", "tx", "Ontario", None)]
    assert state == ["NY", "DC", "TX", "ONTARIO", None]
    zips = [value(spark, address.standard_zip(F.col("s")), s=s) for s in ("02139-1234", " 60601", "123", None)]
    assert zips == ["02139", "60601", None, None]


def test_one_letter_less(spark):
    assert set(value(spark, matchkeys.one_letter_less(F.col("s")), s="anna")) == {"ana", "ann", "anna", "nna"}
    assert value(spark, matchkeys.one_letter_less(F.col("s")), s=None) is None
    assert value(spark, matchkeys.one_letter_less(F.col("s")), s="a") == ["a"]


def test_normal_forms(spark):
    got = [value(spark, matchkeys.normal(f, F.col("s")), s=s) for f, s in [
        ("phone", "+1 (555) 010-2030"), ("zip", "02139-1"), ("email", " A@x.org "), ("last_name", "O'Neil Jr."),
        ("city", "--"), ("full_address", "1 Main St., #2"),
    ]]
    assert got == ["5550102030", "02139", "a@x.org", "oneiljr", None, "1 main st 2"]


def test_lookup(spark):
    got = [value(spark, codes.lookup(F.col("s"), codes.SUPPORT_ANSWERS), s=s) for s in ("3 - Undecided", "3", None)]
    assert got == [1439134, None, None]
    sizes = (codes.FIRST_CHOICE_ANSWERS, codes.SECOND_CHOICE_ANSWERS, codes.SUPPORT_ANSWERS, codes.VOLUNTEER_ANSWERS)
    assert [len(x) for x in sizes] == [24, 24, 7, 3]
