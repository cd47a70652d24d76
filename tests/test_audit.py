"""Audit tables from JSON descriptions."""

import json

import pytest

from fieldloom.plans import audit
from fieldloom.sources import tables


def run(state, start, end):
    return {"state": state, "started_at": start, "finished_at": end}


@pytest.fixture
def described(spark, tmp_path):
    workflows = [
        dict(id=1, name="nightly", state="ok", user=dict(name="amy"), schedule=dict(scheduled=True, scheduled_hours=[3]),
             definition="a:\n  job_id: 11\n  job_id: 12\n  job_id: None\n  job_id: 11\n"),
        dict(id=2, name="by hand", state="ok", user=dict(name="bo"), schedule=dict(scheduled=False), definition="job_id: 11"),
        dict(id=3, name="listed", state="ok", user=dict(name="cy"), schedule=dict(scheduled=False), definition="job_id: 13\n"),
        dict(id=4, name="none", state="ok", user=None, schedule=None, definition=None),
    ]
    jobs = [
        dict(id=11, name="load", type="sql", state="ok", schedule={},
             runs=[run("succeeded", "2024-01-01T01:00:00Z", "2024-01-01T01:30:05Z"), run("failed", None, None)]),
        dict(id=13, name="match", type="r", state="ok", schedule={}, runs=[run("running", "2024-01-01T01:00:00Z", None)]),
        dict(id=14, name="unused", type="r", state="ok", schedule={}, runs=[]),
    ]
    for name, items in (("workflows", workflows), ("jobs", jobs)):
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, items)))
    return tables.read_workflows(spark, f"{tmp_path}/workflows.json"), tables.read_jobs(spark, f"{tmp_path}/jobs.json")


def test_workflows(described):
    got = audit.workflow_audit(described[0], [3, 99])
    assert got.columns == ["id", "name", "state", "user", "job_ids", "scheduled", "scheduled_days", "scheduled_hours"]
    assert sorted((r.id, r.user, r.job_ids) for r in got.collect()) == [
        (1, "amy", ["11", "12", "None", "11"]), (3, "cy", ["13"]),
    ]
    assert [r.id for r in audit.workflow_audit(described[0]).collect()] == [1]


def test_jobs(described):
    workflows, jobs = described
    got = audit.job_audit(audit.workflow_audit(workflows, [3]), jobs)
    assert "runs" not in got.columns and "schedule" not in got.columns
    # used twice, listed twice; an id without a description is left out
    assert sorted((r.workflow, r.id, r.latest_runtime, r.runtime_seconds) for r in got.collect()) == [
        ("listed", 13, None, None), ("nightly", 11, "0:30:05", 1805), ("nightly", 11, "0:30:05", 1805),
    ]


def test_ids_kept_as_text(described, rows):
    listed = rows("name string, job_ids string", ("w", "['11', 'None', None, '-3', '0', '13']"), ("v", "[]"))
    got = audit.job_audit(listed, described[1])
    assert sorted((r.workflow, r.id) for r in got.collect()) == [("w", 11), ("w", 13)]


RUNS = "run_id long, job_id long, state string, started_at string, finished_at string"


def test_newest_of_many_runs_in_any_order(described, rows):
    workflows, jobs = described
    runs = rows(
        RUNS,
        (3, 11, "succeeded", "2024-01-02T23:00:00Z", "2024-01-03T01:00:00Z"),
        (1, 11, "running", "2024-01-01T00:00:00Z", None),
        # the same second, written with and without its parts
        (5, 11, "failed", "2024-01-03T10:00:00Z", "2024-01-03T10:00:09Z"),
        (4, 11, "succeeded", "2024-01-03T10:00:00.500Z", "2024-01-03T10:05:00Z"),
        (9, 11, "queued", None, None), (10, 11, "odd", "soon", None), (2, None, "succeeded", "2025-01-01T00:00:00Z", None),
        # equal starts: the higher id
        (7, 13, "failed", "2024-01-01T00:00:00Z", "2024-01-01T00:00:07Z"),
        (8, 13, "succeeded", "2024-01-01T00:00:00Z", "2024-01-01T00:00:08Z"),
        (6, 99, "succeeded", "2024-01-01T00:00:00Z", "2024-01-01T00:00:08Z"),
    )
    newest = {r.job_id: r.run.state for r in audit.newest_runs(runs).collect()}
    assert newest == {11: "succeeded", 13: "succeeded", 99: "succeeded"}
    got = audit.job_audit(audit.workflow_audit(workflows, [3]), jobs, runs)
    assert got.columns == audit.job_audit(audit.workflow_audit(workflows, [3]), jobs).columns
    assert sorted((r.workflow, r.id, r.latest_runtime, r.runtime_seconds) for r in got.collect()) == [
        ("listed", 13, "0:00:08", 8), ("nightly", 11, "0:05:00", 300), ("nightly", 11, "0:05:00", 300),
    ]


def test_jobs_without_a_run(described, rows):
    workflows, jobs = described
    got = audit.job_audit(audit.workflow_audit(workflows, [3]), jobs, rows(RUNS))
    assert {(r.id, r.latest_runtime, r.runtime_seconds) for r in got.collect()} == {(11, None, None), (13, None, None)}


def test_runs_of_a_hot_job_are_reduced_before_the_shuffle(spark):
    """A job with a third of all runs sends one row per task, and no list of runs is made."""
    from pyspark.sql import functions as F

    minute = F.lpad((F.col("id") / 60 % 60).cast("int").cast("string"), 2, "0")
    runs = spark.range(0, 90000, 1, 6).select(
        F.col("id").alias("run_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("job_id"),
        F.lit("succeeded").alias("state"),
        F.concat(F.lit("2024-01-01T00:"), minute, F.lit(":00Z")).alias("started_at"),
        F.lit(None).cast("string").alias("finished_at"),
    )
    newest = audit.newest_runs(runs)
    assert newest.count() == 1000
    shown = newest._jdf.queryExecution().executedPlan().toString()
    assert "collect" not in shown.replace("CollectMetrics", "") and "partial_max_by" in shown
    assert shown.index("functions=[max_by") < shown.index("Exchange hashpartitioning(job_id") < shown.index("partial_max_by")
