"""Runtime of a run, and of a job's latest one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def _epoch(stamp: Column) -> Column:
    """Seconds since 1970 of a UTC stamp; NULL if unreadable."""
    return F.concat(stamp, F.lit("+00:00")).try_cast("timestamp").cast("long")


def _seconds_of_day(stamp: Column) -> Column:
    """Seconds of the time of day in characters 12 to 19 of an ISO stamp; NULL if unreadable."""
    clock = F.substring(stamp, 12, 8)
    only_digits = F.translate(clock, "0123456789", "") == "::"
    return F.when(only_digits, _epoch(F.concat(F.lit("1970-01-01 "), clock)))


def _clock_text(seconds: Column) -> Column:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    minutes = F.pmod(F.floor(seconds / 60), F.lit(60))
    return F.concat_ws(":", F.floor(seconds / 3600).cast("string"), two(minutes), two(F.pmod(seconds, F.lit(60))))


def _finished(run: Column) -> tuple[Column, Column]:
    running = run["state"].eqNullSafe("running")
    return F.when(~running, run["started_at"]), F.when(~running, run["finished_at"])


def runtime_text(run: Column) -> Column:
    """End minus start of a run, by time of day, as ``H:MM:SS``.

    A run over midnight reads ``-1 day, H:MM:SS``, as in the audit tables this
    replaces; ``run_seconds`` has the true length.
    """
    started, finished = _finished(run)
    seconds = _seconds_of_day(finished) - _seconds_of_day(started)
    return (
        F.when(seconds < 0, F.concat(F.lit("-1 day, "), _clock_text(seconds + DAY)))
        .when(seconds >= 0, _clock_text(seconds))
    )


def run_seconds(run: Column) -> Column:
    """Length of a run from its full stamps; NULL while running or unreadable."""
    started, finished = _finished(run)
    return _epoch(F.left(finished, F.lit(19))) - _epoch(F.left(started, F.lit(19)))


def latest_runtime(runs: Column) -> Column:
    """``runtime_text`` of the first of a job's runs, which come newest first."""
    return runtime_text(F.get(runs, F.lit(0)))


def runtime_seconds(runs: Column) -> Column:
    """``run_seconds`` of the first of a job's runs."""
    return run_seconds(F.get(runs, F.lit(0)))


def newest(run_id: Column, state: Column, started_at: Column, finished_at: Column) -> Column:
    """The run that started last, as an aggregate over runs in any order.

    A maximum: it is taken within each task first, so a job with very many runs sends
    one per task. A start that is missing or cannot be read comes before all others;
    among equal starts the higher run id is newer.
    """
    order = F.struct(started_at.try_cast("timestamp"), run_id)
    return F.max_by(F.struct(state.alias("state"), started_at.alias("started_at"), finished_at.alias("finished_at")), order)
