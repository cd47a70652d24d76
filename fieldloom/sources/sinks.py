"""Writing results.

Keyed writes ask for a rebalanced shuffle: rows of a key are brought together, but
a key with too many rows is spread over several files instead of one huge task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Takes the rows of a run and the run's id.
Sink = Callable[[DataFrame, str], None]


def keyed_layout(df: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows of a key close together and sorted, so that readers skip by file statistics."""
    return df.hint("rebalance", key).sortWithinPartitions(key, *more)


def write_keyed(df: DataFrame, path: str, key: str, *more: str, mode: str = "errorifexists") -> DataFrame:
    """Create a table laid out by ``key`` and return a scan of it."""
    keyed_layout(df, key, *more).write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_or_create(df: DataFrame, path: str) -> None:
    """Append to the table at ``path``, which comes into being on the first call."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def queue_name(state: Column, suffix: str) -> Column:
    return F.concat(F.coalesce(state, F.lit("")), F.lit(f"_{suffix}"))


def response_table(queue: Column) -> Column:
    """The table that the receiver of a queue answers to."""
    return F.concat(queue, F.lit("_r"))


@dataclass(frozen=True)
class QueueSink:
    """A sink writing ``columns`` to one queue per state, e.g. ``queue=IL_sqs_current_load``.

    Each run has a folder of its own in every queue that it has rows for. A run written
    again replaces its own folders; the queues of other states and what other runs left
    to be fetched stay. A run without rows writes nothing.
    """

    path: str
    columns: Sequence[str]
    state_col: str
    suffix: str
    format: str = "parquet"

    def __call__(self, df: DataFrame, run_id: str) -> None:
        queue = queue_name(F.col(self.state_col), self.suffix)
        queues = df.withColumn("queue", queue).withColumn("response_table", response_table(queue))
        queues = queues.select(*self.columns, "response_table", "queue").withColumn("run", F.lit(_run_folder(run_id)))
        writer = queues.hint("rebalance", "queue").write.mode("overwrite").partitionBy("queue", "run")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        (writer.option("header", True) if self.format == "csv" else writer).format(self.format).save(self.path)

    def discard(self, spark: SparkSession, run_id: str) -> None:
        """Remove what a run has put in the queues."""
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/queue=*/run={_run_folder(run_id)}")
        files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(pattern) or ():
            files.delete(found.getPath(), True)


def _run_folder(run_id: str) -> str:
    return f"run_{run_id}"


def answers_in(spark: SparkSession, path: str) -> Callable[[str, str], bool]:
    """Tells for a run and a response table whether the receiver has written its answer.

    An answer is a finished write (``_SUCCESS``) to ``<path>/<response table>/run=run_<run id>``.
    """

    def answered(run_id: str, response_table: str) -> bool:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{response_table}/run={_run_folder(run_id)}/_SUCCESS")
        return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)

    return answered
