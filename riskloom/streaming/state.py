"""What a stream holds between its micro-batches, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.windows import Measures
from riskloom.session import stream_session


def open_windows(spark: SparkSession, checkpoint: str, measures: Measures) -> DataFrame:
    """The windows that have rows and have not come out, with their count, means and rates so far.

    The checkpoint may be that of a running stream or of one that has ended; the last committed batch
    counts. The first of the stream's aggregates holds a row for each window and, with categories,
    category and value; the second is empty between batches.
    """
    reader = stream_session(spark).read.format("statestore")
    held = reader.option("operatorId", 1 if measures.modes else 0).load(checkpoint)
    names = measures.averaged
    # Spark names the buffers by their functions, so that names repeat; a cast goes by place.
    sums, counts = [f"_sum_{n}" for n in names], [f"_count_{n}" for n in names]
    kinds = ["_rows bigint", *[f"`{s}` double" for s in sums], *[f"`{c}` bigint" for c in counts]]
    buffers = F.col("value").cast(f"struct<{', '.join(kinds)}>").alias("buffers")
    flat = held.select("key.*", buffers).select("*", "buffers.*")
    if measures.modes:
        flat = flat.where("_slot = 0")
    of = flat.groupBy("window").agg(*[F.sum(c).alias(c) for c in ("_rows", *sums, *counts)])
    return of.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("_rows").alias(measures.count),
        *[F.try_divide(f"_sum_{n}", f"_count_{n}").alias(n) for n in names],
    )
