"""An incremental load per micro-batch.

The delivery log already makes a load repeatable, so a stream adds no state of its
own: a batch that is replayed after a failure finds its records in the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fieldloom.plans.load import IncrementalLoad
from fieldloom.sources.sinks import QueueSink, Sink


def load_stream(
    stream: DataFrame,
    view: Callable[[DataFrame], DataFrame],
    load: IncrementalLoad,
    sink: Sink,
    checkpoint: str,
    name: str = "load",
) -> StreamingQuery:
    """Take in what has arrived since the last start, batch by batch, and stop.

    ``view`` turns a batch of the stream into records. The run id of a batch is ``name`` and
    its number, so a replayed batch writes to the same place. ``sink`` is not called
    without records: a replay of a batch already loaded must not empty its export.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        def export(df: DataFrame, run_id: str) -> None:
            if not df.isEmpty():
                sink(df, run_id)

        # a queue sink writes nothing without rows by itself
        load.run(view(batch), sink if isinstance(sink, QueueSink) else export, f"{name}_{number}")

    return (
        stream.writeStream.queryName(name)
        .foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
