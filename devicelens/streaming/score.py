"""Scoring of a stream of feature rows with the functions that score a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_batch(scored: DataFrame, batch_id: int, sink: str) -> None:
    """Replace the partition of this batch: a replayed batch leaves no duplicates, others are kept."""
    (
        scored.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(sink)
    )


def score_stream(
    stream: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    trigger: str | None = "available_now",
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that scores each micro-batch on the executors and writes it to ``sink``.

    ``trigger`` is 'available_now' (take what is there and stop), None (run on and on) or an
    interval such as '10 seconds'. Progress is kept in ``checkpoint``: a restarted query goes
    on where the last one stopped.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: write_batch(scorer(batch), batch_id, sink)
    )
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def drain(query: StreamingQuery, timeout: float = 3600.0) -> None:
    """Wait for the end; stop the query and raise when it takes longer than the timeout (seconds)."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} seconds")
