"""Loading each record once.

A log is four catalog tables. ``attempts`` has every record ever queued; ``marks`` the
hashes whose export went through since the log was compacted, and ``loaded`` those from
before, each once, bucketed by hash; ``runs`` is the manifest: what each run has put in
which queue, and how far that has come.

Within a run nothing is rewritten: marks and states are appended, so a lost executor or
a failed run leaves the log readable. ``LoadLog.compact`` folds the marks into a new
version of ``loaded`` and closes the attempts of loaded hashes. A run reads the buckets
of loaded hashes, the marks since, and open attempts; none of these grows with the number
of runs.

States of a queue of a run: ``prepared`` before the sink is called, ``sent`` when it has
returned, ``answered`` when the receiver has taken the queue in, ``withdrawn`` if that is
not waited for any longer. ``sent`` is the state from which on a receiver may fetch the
queue: what a broken run has left behind stays ``prepared`` and is removed by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fieldloom import schemas
from fieldloom.operators import joins
from fieldloom.plans import notes, people
from fieldloom.session import Staging
from fieldloom.sources.sinks import QueueSink, Sink, keyed_layout, queue_name, response_table
from fieldloom.sources.versions import BUCKETS, VersionedTable

_RUN_ID = StructField("run_id", StringType())
_RUNS = StructType(
    [
        _RUN_ID,
        *(StructField(name, StringType()) for name in ("queue", "response_table")),
        StructField("rows", LongType()),
        *(StructField(name, StringType()) for name in ("state", "recorded")),
    ]
)
#: Later states of a queue of a run, in the order they come in.
STATES = ("prepared", "sent", "answered", "withdrawn")


@dataclass(frozen=True)
class LogFormat:
    """How records of one kind are logged."""

    schema: StructType
    hash_col: str
    layout: Sequence[str]
    export_cols: Sequence[str]
    state_col: str
    queue: str
    computed: Mapping[str, Column] = field(default_factory=dict)

    def pending(self, records: DataFrame) -> DataFrame:
        """Records as log rows that are not loaded yet, cast to the types of the log."""
        columns = []
        for f in self.schema.fields:
            source = F.lit(False) if f.name == "loaded" else self.computed.get(f.name, F.col(f.name))
            columns.append(source.cast(f.dataType).alias(f.name))
        return records.select(*columns)


def survey_format() -> LogFormat:
    return LogFormat(
        schemas.SURVEY_LOG,
        "sq_hash",
        ["state_code", "sq_hash"],
        ["van_id", "survey_question_id", "survey_response_id", "input_type_id", "contact_type_id", "date_canvassed"],
        "state_code",
        "sqs_current_load",
        {"myv_van_id": F.col("van_id")},
    )


def people_format() -> LogFormat:
    return LogFormat(
        schemas.PEOPLE_LOG, "person_hash", ["person_hash"], people.EXPORT, "state_or_province", "people_current_load"
    )


def notes_format() -> LogFormat:
    return LogFormat(
        schemas.NOTES_LOG,
        "note_hash",
        ["state_code", "note_hash"],
        [c for c in notes.RECORD if c not in ("contacttimestamp", "state_code", "note_hash")],
        "state_code",
        "notes_current_load",
        {"myc_van_id": F.col("van_id")},
    )


class LoadLog:
    """The log of one kind of records, as catalog tables whose names start with ``name``."""

    def __init__(self, spark: SparkSession, name: str, format: LogFormat, buckets: int = BUCKETS):  # noqa: A002
        self.spark = spark
        self.name = name
        self.format = format
        self._attempts = VersionedTable(spark, f"{name}_attempts", partitions=["loaded"])
        self._marks = VersionedTable(spark, f"{name}_marks")
        self._loaded = VersionedTable(spark, f"{name}_loaded", key=format.hash_col, buckets=buckets)
        self._runs = VersionedTable(spark, f"{name}_runs")

    def _read(self, table: VersionedTable, schema: StructType) -> DataFrame:
        found = table.read()
        return self.spark.createDataFrame([], schema) if found is None else found.select(*schema.names)

    @property
    def _hashes(self) -> StructType:
        return StructType([StructField(self.format.hash_col, StringType()), _RUN_ID])

    def attempts(self) -> DataFrame:
        return self._read(self._attempts, StructType([*self.format.schema.fields, _RUN_ID]))

    def loaded(self) -> DataFrame:
        """Hashes known to be loaded, each at least once."""
        return self._read(self._loaded, self._hashes).unionAll(self._read(self._marks, self._hashes))

    def rows(self) -> DataFrame:
        """The log as one table: every attempt, with ``loaded`` as of now."""
        attempts = self.attempts()
        still_open = attempts.where(~F.col("loaded"))
        return attempts.where("loaded").unionAll(joins.mark_loaded(still_open, self.loaded(), self.format.hash_col))

    def runs(self) -> DataFrame:
        """The manifest: ``run_id, queue, response_table, rows, state``, one row per run and queue."""
        rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))
        last = F.max_by("state", F.struct("recorded", rank)).alias("state")
        events = self._read(self._runs, _RUNS)
        return events.groupBy("run_id", "queue", "response_table").agg(F.max("rows").alias("rows"), last).select(
            "run_id", "queue", "response_table", "rows", "state"
        )

    def in_state(self, *states: str) -> list[Row]:
        """Queues of runs in one of the states. Their number is that of the queues not settled yet."""
        return self.runs().where(F.col("state").isin(*states)).collect()

    def _of(self, queues: Sequence[Row]) -> DataFrame:
        """Open attempts of some queues of some runs."""
        attempts = self.attempts().where(~F.col("loaded") & F.col("run_id").isin(sorted({q["run_id"] for q in queues})))
        by_run = attempts.withColumn("queue", queue_name(F.col(self.format.state_col), self.format.queue))
        wanted = self.spark.createDataFrame([(q["run_id"], q["queue"]) for q in queues], "run_id string, queue string")
        return by_run.join(wanted, ["run_id", "queue"], "left_semi")

    def new(self, records: DataFrame) -> DataFrame:
        """Records that were never loaded and are not on their way to a receiver."""
        hash_col = self.format.hash_col
        # side by side, since a union would lose the layout of the first
        for known in (self._read(self._loaded, self._hashes), self._read(self._marks, self._hashes)):
            records = records.join(known.select(hash_col), hash_col, "left_anti")
        waiting = self.in_state("sent")
        return records.join(self._of(waiting).select(hash_col), hash_col, "left_anti") if waiting else records

    def _laid_out(self, attempts: DataFrame) -> DataFrame:
        return keyed_layout(attempts, self.format.layout[0]).sortWithinPartitions("loaded", *self.format.layout)

    def append_pending(self, records: DataFrame, run_id: str) -> None:
        rows = self.format.pending(records).withColumn("run_id", F.lit(run_id))
        self._attempts.append(self._laid_out(rows))

    def append_loaded(self, records: DataFrame, run_id: Column | str) -> None:
        run = F.lit(run_id) if isinstance(run_id, str) else run_id
        hashes = records.groupBy(self.format.hash_col).agg(F.max(run).alias("run_id"))
        self._marks.append(hashes.sortWithinPartitions(self.format.hash_col))

    def record(self, queues: DataFrame, state: str) -> None:
        """Note that queues of runs (``run_id, queue, response_table, rows``) have come to ``state``."""
        now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        events = queues.select("run_id", "queue", "response_table", "rows")
        self._runs.append(events.withColumn("state", F.lit(state)).withColumn("recorded", F.lit(now)).coalesce(1))

    def queues_of(self, records: DataFrame, run_id: str) -> DataFrame:
        queue = queue_name(F.col(self.format.state_col), self.format.queue)
        counts = records.groupBy(queue.alias("queue")).agg(F.count("*").alias("rows"))
        return counts.select(F.lit(run_id).alias("run_id"), "queue", response_table(F.col("queue")).alias("response_table"), "rows")

    def note(self, queues: Sequence[Row], state: str) -> None:
        if queues:
            rows = [(q["run_id"], q["queue"], q["response_table"], q["rows"]) for q in queues]
            self.record(self.spark.createDataFrame(rows, _RUNS[:4]), state)

    def settle(self, answered: Callable[[str, str], bool]) -> int:
        """Mark as loaded what receivers have answered to since; the number of such queues."""
        done = [q for q in self.in_state("sent") if answered(q["run_id"], q["response_table"])]
        if done:
            self.append_loaded(self._of(done), F.col("run_id"))
            self.note(done, "answered")
        return len(done)

    def withdraw(self, run_id: str) -> int:
        """Wait no longer for the answers to a run: its open records are new again."""
        gone = [q for q in self.in_state("prepared", "sent") if q["run_id"] == run_id]
        self.note(gone, "withdrawn")
        return len(gone)

    def compact(self) -> None:
        """Fold marks into the loaded hashes, close the attempts of loaded hashes, drop settled runs.

        Each step is a whole new version of one table, and the log means the same before
        and after each: a run that breaks in between can be repeated.
        """
        if not self._marks.exists():
            return
        hash_col = self.format.hash_col
        known = self.loaded().where(F.col(hash_col).isNotNull())
        self._loaded.publish(known.groupBy(hash_col).agg(F.max("run_id").alias("run_id")))
        self._attempts.publish(self._laid_out(self.rows()))
        marks, loaded = self._read(self._marks, self._hashes), self._read(self._loaded, self._hashes)
        self._marks.publish(marks.join(loaded, hash_col, "left_anti"))
        kept = self.runs().where(F.col("state").isin("prepared", "sent"))
        self._runs.publish(kept.withColumn("recorded", F.lit("")).select(*_RUNS.names).coalesce(1))

    def drop(self) -> None:
        for table in (self._attempts, self._marks, self._loaded, self._runs):
            table.drop()


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    exported: int


class IncrementalLoad:
    """New records out, once.

    ``run`` stages the records that are new, logs them as pending, and hands the export
    columns to the sink. Without ``answered``, the sink's return is the receipt and the
    records are loaded. With it, a queue's records are loaded once ``answered(run id,
    response table)`` says that its receiver has taken it in, which each run and
    ``settle`` ask; until then they are neither loaded nor sent again.

    A sink that raises leaves its records pending, and the next run takes them up, after
    removing what the broken run has put in the queues.
    """

    def __init__(self, log: LoadLog, answered: Callable[[str, str], bool] | None = None):
        self.log = log
        self.answered = answered

    def settle(self) -> int:
        return 0 if self.answered is None else self.log.settle(self.answered)

    def run(self, records: DataFrame, sink: Sink, run_id: str) -> LoadResult:
        format, log = self.log.format, self.log  # noqa: A001
        self.settle()
        self._clean_up(sink)
        with Staging(log.spark, f"load_{run_id}") as staging:
            new = staging.table(log.new(records), "new")
            queues = staging.table(log.queues_of(new, run_id), "queues")
            exported = queues.agg(F.sum("rows")).first()[0] or 0
            if exported and any(q["run_id"] == run_id for q in log.in_state("sent", "answered")):
                raise ValueError(f"run id {run_id} was used, and there are new records")
            if exported:
                log.append_pending(new, run_id)
                log.record(queues, "prepared")
            sink(new.select(*dict.fromkeys([*format.export_cols, format.state_col])), run_id)
            if exported and self.answered is None:
                log.append_loaded(new, run_id)
            if exported:
                log.record(queues, "answered" if self.answered is None else "sent")
            return LoadResult(run_id, exported)

    def _clean_up(self, sink: Sink) -> None:
        broken = self.log.in_state("prepared")
        for run_id in sorted({q["run_id"] for q in broken}):
            if isinstance(sink, QueueSink):
                sink.discard(self.log.spark, run_id)
        self.log.note(broken, "withdrawn")
