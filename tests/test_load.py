"""Delivery logs: nothing twice, nothing lost."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldloom import session
from fieldloom.operators import joins
from fieldloom.plans import load, notes, people
from fieldloom.sources import sinks
from fieldloom.streaming.load_stream import load_stream

T = datetime(2024, 7, 1, 3)
RECORD = (
    "van_id string, survey_question_id int, survey_response_id int, input_type_id int, contact_type_id int,"
    " date_canvassed timestamp_ntz, contacttimestamp timestamp_ntz, state_code string, sq_hash string"
)


def record(i, state="IL"):
    return (str(i), 1, 2, 11, 37, T, T, state, f"h{i}")


@pytest.fixture
def log(spark):
    made = load.LoadLog(spark, session.new_name("log"), load.survey_format(), buckets=4)
    yield made
    made.drop()


class Collected:
    """A sink that remembers what it was given."""

    def __init__(self):
        self.batches = []

    def __call__(self, df, run_id):
        self.batches.append(sorted(r.van_id for r in df.collect()))


def test_second_run_exports_nothing(rows, log):
    sink, job = Collected(), load.IncrementalLoad(log)
    records = rows(RECORD, record(1), record(2))
    assert job.run(records, sink, "1").exported == 2
    assert job.run(records, sink, "2").exported == 0
    assert job.run(records.union(rows(RECORD, record(3))), sink, "3").exported == 1
    assert sink.batches == [["1", "2"], [], ["3"]]
    assert sorted((r.sq_hash, r.loaded, r.run_id) for r in log.rows().collect()) == [
        ("h1", True, "1"), ("h2", True, "1"), ("h3", True, "3"),
    ]


def test_failed_export_is_taken_up_again(rows, log):
    sink, job = Collected(), load.IncrementalLoad(log)
    records = rows(RECORD, record(1), record(2))

    def broken(df, run_id):
        raise OSError("no connection")

    with pytest.raises(OSError):
        job.run(records, broken, "1")
    assert [r.loaded for r in log.rows().collect()] == [False, False]
    assert job.run(records, sink, "2").exported == 2
    assert sink.batches == [["1", "2"]]
    # both attempts of a record end up loaded
    assert [r.loaded for r in log.rows().collect()] == [True] * 4


def test_repeated_hash_in_one_batch_goes_out_whole(rows, log):
    sink = Collected()
    load.IncrementalLoad(log).run(rows(RECORD, record(1), record(1)), sink, "1")
    assert sink.batches == [["1", "1"]]
    assert log.loaded().count() == 1 and log.rows().count() == 2


def test_log_types(rows, log):
    load.IncrementalLoad(log).run(rows(RECORD, record(1)), Collected(), "1")
    assert log.rows().drop("run_id").schema == log.format.schema


def test_staged_batch_is_dropped(spark, rows, log, tmp_path):
    import os

    before = sorted(os.listdir(f"{session.shared_dir(spark)}/fieldloom"))
    load.IncrementalLoad(log).run(rows(RECORD, record(1)), Collected(), "1")
    left = [
        f for d in set(os.listdir(f"{session.shared_dir(spark)}/fieldloom")) - set(before)
        for f in os.listdir(f"{session.shared_dir(spark)}/fieldloom/{d}")
    ]
    assert "load_1" not in left


def test_flags_of_a_given_log(rows):
    log = rows("sq_hash string, loaded boolean", ("a", True), ("b", False), ("c", None), (None, True), ("b", None))
    records = rows("sq_hash string, x int", ("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5))
    kept = joins.without_loaded(records, log, "sq_hash")
    assert sorted(r.x for r in kept.collect()) == [2, 3, 4, 5]
    marked = joins.mark_loaded(log, rows("sq_hash string", ("b",), ("b",), (None,)), "sq_hash")
    got = sorted(((r.sq_hash, r.loaded) for r in marked.collect()), key=str)
    assert got == [("a", True), ("b", True), ("b", True), ("c", None), (None, True)]


def test_queues_per_state(spark, rows, log):
    path = session.new_path(spark, "queues")
    form = log.format
    sink = sinks.QueueSink(path, form.export_cols, form.state_col, form.queue)
    load.IncrementalLoad(log).run(rows(RECORD, record(1), record(2, "D.C."), record(3, "")), sink, "1")
    got = spark.read.parquet(path)
    assert got.columns == [*form.export_cols, "response_table", "queue", "run"]
    assert {(r.queue, r.response_table, r.van_id) for r in got.collect()} == {
        (f"{s}_sqs_current_load", f"{s}_sqs_current_load_r", v) for s, v in (("IL", "1"), ("D.C.", "2"), ("", "3"))
    }
    assert spark.read.parquet(f"{path}/queue=IL_sqs_current_load").count() == 1


def test_csv_queue(spark, rows):
    path = session.new_path(spark, "csv_queue")
    df = rows("van_id string, state_code string", ("1", "IL"), ("2", "NY"))
    sinks.QueueSink(path, ["van_id"], "state_code", "q", format="csv")(df, "1")
    got = spark.read.option("header", True).csv(f"{path}/queue=IL_q")
    assert [tuple(r) for r in got.collect()] == [("1", "IL_q_r", "run_1")]


def test_queues_of_other_states_and_runs_stay(spark, rows):
    path = session.new_path(spark, "state_queues")
    for format in ("parquet", "csv"):  # noqa: A001
        for run, values in (("1", [("1", "IL")]), ("2", [("2", "NY")]), ("3", []), ("4", [("4", "IL")]), ("4", [("5", "IL")])):
            df = rows("van_id string, state_code string", *values)
            sinks.QueueSink(f"{path}/{format}", ["van_id"], "state_code", "q", format=format)(df, run)
        got = spark.read.option("header", True).format(format).load(f"{path}/{format}")
        assert sorted((str(r.van_id), r.queue, r.run) for r in got.collect()) == [
            ("1", "IL_q", "run_1"), ("2", "NY_q", "run_2"), ("5", "IL_q", "run_4")
        ]


def test_notes_log_keeps_whole_text(spark, rows):
    form = load.notes_format()
    df = rows(
        "van_id string, text string, is_view_restricted boolean, note_category_id int, date_canvassed timestamp_ntz,"
        " contacttimestamp timestamp_ntz, state_code string, note_hash string",
        ("1", "x" * 300, False, 1, T, T, "IL", "h"),
    )
    log = load.LoadLog(spark, session.new_name("notes"), form, buckets=2)
    got = []
    load.IncrementalLoad(log).run(df, lambda d, run_id: got.extend(d.collect()), "1")
    assert len(got[0].text) == 300 and len(log.rows().first().text) == 300


def test_people_export_has_all_columns(rows):
    assert len(load.people_format().export_cols) == len(people.EXPORT) == 32
    assert load.notes_format().export_cols == [c for c in notes.RECORD[:5]]


def test_stream(spark, rows, log):
    src, queues = session.new_path(spark, "src"), session.new_path(spark, "queues")
    checkpoint = session.new_path(spark, "checkpoint")
    job, form = load.IncrementalLoad(log), log.format

    def run():
        stream = spark.readStream.schema(RECORD).parquet(src)
        sink = sinks.QueueSink(queues, form.export_cols, form.state_col, form.queue)
        load_stream(stream, lambda df: df.where(F.col("sq_hash").isNotNull()), job, sink, checkpoint).awaitTermination()

    rows(RECORD, record(1), record(2)).write.parquet(src)
    run()
    rows(RECORD, record(2), record(3)).write.mode("append").parquet(src)
    run()
    assert sorted(r.sq_hash for r in log.rows().where("loaded").collect()) == ["h1", "h2", "h3"]
    assert sorted(r.van_id for r in spark.read.parquet(queues).collect()) == ["1", "2", "3"]


# -- receipts


class Receiver:
    """Takes queues in when told to, and answers."""

    def __init__(self, spark, log, sink):
        self.spark, self.log, self.sink = spark, log, sink
        self.path = session.new_path(spark, "answers")
        self.taken = []

    def fetch(self, run_id, *queues):
        for q in self.log.in_state("sent"):
            if q["run_id"] == run_id and q["queue"].split("_")[0] in queues:
                df = self.spark.read.parquet(f"{self.sink.path}/queue={q['queue']}/run=run_{run_id}")
                assert df.count() == q["rows"]
                self.taken += [r.van_id for r in df.collect()]
                df.write.parquet(f"{self.path}/{q['response_table']}/run=run_{run_id}")


@pytest.fixture
def delivery(spark, log):
    form = log.format
    sink = sinks.QueueSink(session.new_path(spark, "queues"), form.export_cols, form.state_col, form.queue)
    receiver = Receiver(spark, log, sink)
    return load.IncrementalLoad(log, sinks.answers_in(spark, receiver.path)), sink, receiver


def flags(log):
    return {(r.sq_hash, r.run_id): r.loaded for r in log.rows().collect()}


def test_sent_is_not_loaded_and_not_sent_twice(rows, log, delivery):
    job, sink, receiver = delivery
    records = rows(RECORD, record(1), record(2, "NY"), record(3))
    assert job.run(records, sink, "a").exported == 3
    assert set(flags(log).values()) == {False}
    # nothing was fetched: a later run sends what is new, and nothing of the first
    assert job.run(records.union(rows(RECORD, record(4, "NY"))), sink, "b").exported == 1
    receiver.fetch("a", "NY")
    receiver.fetch("b", "NY")
    assert job.settle() == 2 and job.settle() == 0
    assert flags(log) == {("h1", "a"): False, ("h2", "a"): True, ("h3", "a"): False, ("h4", "b"): True}
    assert job.run(records, sink, "c").exported == 0
    receiver.fetch("a", "IL")
    assert job.run(records, sink, "d").exported == 0 and set(flags(log).values()) == {True}
    assert sorted(receiver.taken) == ["1", "2", "3", "4"]
    assert {(r.run_id, r.queue, r.rows, r.state) for r in log.runs().collect()} == {
        ("a", "IL_sqs_current_load", 2, "answered"), ("a", "NY_sqs_current_load", 1, "answered"),
        ("b", "NY_sqs_current_load", 1, "answered"),
    }


def test_withdrawn_run_is_sent_again(spark, rows, log, delivery):
    job, sink, receiver = delivery
    records = rows(RECORD, record(1), record(2, "NY"))
    job.run(records, sink, "a")
    receiver.fetch("a", "NY")
    job.settle()
    assert log.withdraw("a") == 1
    sink.discard(spark, "a")
    assert job.run(records, sink, "b").exported == 1
    receiver.fetch("b", "IL")
    job.settle()
    # the first attempt of a record is loaded by the second
    assert flags(log) == {("h1", "a"): True, ("h2", "a"): True, ("h1", "b"): True}
    assert sorted(receiver.taken) == ["1", "2"]


def test_broken_run_leaves_nothing_to_fetch(spark, rows, log, delivery):
    job, sink, receiver = delivery

    class Breaks(sinks.QueueSink):
        def __call__(self, df, run_id):
            super().__call__(df, run_id)
            raise OSError("after the queues were written")

    records = rows(RECORD, record(1), record(2, "NY"))
    with pytest.raises(OSError):
        job.run(records, Breaks(sink.path, sink.columns, sink.state_col, sink.suffix), "a")
    assert {q["state"] for q in log.runs().collect()} == {"prepared"}
    receiver.fetch("a", "IL", "NY")
    assert receiver.taken == []
    assert job.run(records, sink, "b").exported == 2
    got = spark.read.parquet(sink.path).collect()
    assert sorted((r.van_id, r.run) for r in got) == [("1", "run_b"), ("2", "run_b")]
    assert {(q["run_id"], q["state"]) for q in log.runs().collect()} == {("a", "withdrawn"), ("b", "sent")}


def test_run_id_is_not_used_twice(rows, log, delivery):
    job, sink, _ = delivery
    job.run(rows(RECORD, record(1)), sink, "a")
    # the run again, as a stream replays a batch: nothing new, so nothing to do
    assert job.run(rows(RECORD, record(1)), sink, "a").exported == 0
    with pytest.raises(ValueError, match="was used"):
        job.run(rows(RECORD, record(2)), sink, "a")


# -- compaction


def test_compaction_changes_nothing_seen(rows, log, delivery):
    job, sink, receiver = delivery
    records = rows(RECORD, record(1), record(2, "NY"), record(2, "NY"), record(3))
    job.run(records, sink, "a")
    receiver.fetch("a", "NY")
    job.settle()
    seen = sorted(map(tuple, log.rows().collect()))
    open_ = {(r.run_id, r.queue) for r in log.in_state("sent")}
    for _ in range(2):
        log.compact()
        assert sorted(map(tuple, log.rows().collect())) == seen
        assert {(r.run_id, r.queue) for r in log.in_state("sent")} == open_
        assert log.loaded().count() == 1
    # what was on its way still is, and is settled by its answer
    assert job.run(records, sink, "b").exported == 0
    receiver.fetch("a", "IL")
    job.settle()
    assert all(r.loaded for r in log.rows().collect())
    assert log.rows().drop("run_id").schema == log.format.schema


def test_a_run_reads_as_much_after_six_as_after_one(rows, log):
    job = load.IncrementalLoad(log)

    def read_by_a_run():
        new = log.new(rows(RECORD, record(1)))
        still_open = log.attempts().where(~F.col("loaded"))
        return len(new.inputFiles()), still_open.count()

    sizes = []
    for k in range(6):
        # the same two records come again each time, with a new one
        job.run(rows(RECORD, record(0), record(1), record(10 + k)), Collected(), str(k))
        log.compact()
        sizes.append(read_by_a_run())
    # a file per bucket, and one of the marks since, which may be empty
    assert all(files <= 5 and still_open == 0 for files, still_open in sizes)
    assert log.rows().where("loaded").count() == 8 and log.runs().count() == 0


def test_compaction_may_break_in_between(rows, log, monkeypatch):
    load.IncrementalLoad(log).run(rows(RECORD, record(1), record(2)), Collected(), "a")
    seen = sorted(map(tuple, log.rows().collect()))
    for step in ("_attempts", "_marks", "_runs"):
        table = getattr(log, step)

        class Broken:
            def __getattr__(self, name):
                if name == "publish":
                    raise OSError("no space")
                return getattr(table, name)  # noqa: B023

        monkeypatch.setattr(log, step, Broken())
        with pytest.raises(OSError):
            log.compact()
        monkeypatch.setattr(log, step, table)
        assert sorted(map(tuple, log.rows().collect())) == seen
        assert log.new(rows(RECORD, record(1), record(3))).count() == 1
    log.compact()
    assert sorted(map(tuple, log.rows().collect())) == seen
