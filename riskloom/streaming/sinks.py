"""Append-only file sinks with checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "json",
    available_now: bool = False,
    processing_time: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Start a query that appends finished rows to files, each exactly once.

    Restarting with the same checkpoint goes on where the last run stopped. ``available_now``
    takes in what is there, in as many micro-batches as the source is split into, and ends;
    otherwise the query runs until it is stopped and the caller awaits it. ``partition_by`` names
    columns that become folders, so that readers can pass over those they do not need.
    """
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
