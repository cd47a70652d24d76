"""Audit tables of scheduled workflows and of the jobs they run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.lists import id_texts, job_ids_in, usable_id
from fieldloom.functions.runs import newest, run_seconds, runtime_text


def workflow_audit(workflows: DataFrame, allow_ids: Sequence[int] = ()) -> DataFrame:
    """Scheduled workflows, and unscheduled ones on the list, flat, with their job ids."""
    monitored = F.coalesce(F.col("schedule.scheduled"), F.lit(False))
    if allow_ids:
        monitored = monitored | F.col("id").isin(list(allow_ids))
    return (
        workflows.where(monitored)
        .withColumn("job_ids", job_ids_in(F.col("definition")))
        .withColumn("user", F.col("user.name"))
        .select("*", "schedule.*")
        .drop("schedule", "definition")
    )


def workflow_job_ids(workflows: DataFrame) -> DataFrame:
    """(workflow, job_id): one row per usable job id of each workflow.

    ``job_ids`` may be an array or the text of a list.
    """
    ids = F.col("job_ids")
    if dict(workflows.dtypes)["job_ids"] == "string":
        ids = id_texts(ids)
    return (
        workflows.select(F.col("name").alias("workflow"), F.explode(ids).alias("id_text"))
        .withColumn("job_id", usable_id(F.col("id_text")))
        .where(F.col("job_id").isNotNull())
        .select("workflow", "job_id")
    )


def newest_runs(runs: DataFrame) -> DataFrame:
    """(job_id, run): the newest of each job's ``run_id, job_id, state, started_at, finished_at``."""
    columns = [F.col(c) for c in ("run_id", "state", "started_at", "finished_at")]
    return runs.where(F.col("job_id").isNotNull()).groupBy("job_id").agg(newest(*columns).alias("run"))


def job_audit(workflows: DataFrame, jobs: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Jobs of the audited workflows with the runtime of their latest run.

    Jobs have their runs as a list, newest first, or ``runs`` has one row per run of any
    job, in any order. A job used twice is listed twice; an id that no job has is left out.
    """
    if runs is None:
        described, run = jobs, F.get("runs", F.lit(0))
    else:
        newest_of = newest_runs(runs).withColumnRenamed("job_id", "_job").withColumnRenamed("run", "_run")
        described, run = jobs.join(newest_of, jobs["id"] == F.col("_job"), "left"), F.col("_run")
    described = (
        described.withColumn("latest_runtime", runtime_text(run))
        .withColumn("runtime_seconds", run_seconds(run))
        .drop("runs", "schedule", "_job", "_run")
    )
    ids = workflow_job_ids(workflows)
    return described.join(ids, described["id"] == ids["job_id"]).drop("job_id")
