"""What a stream reads, drops and leaves unscored, from metrics that ride along with its rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.windows import EventWindow, missing_input

READ = "riskloom_read"
SCORED = "riskloom_scored"


def counting_rows(rows: DataFrame, window: EventWindow, time: str) -> DataFrame:
    """The same rows; each micro-batch tells how many they are, how many have a time, and in how many
    windows those are together."""
    timed = F.col(time).isNotNull()
    return rows.observe(
        READ,
        F.count("*").alias("rows"),
        F.count_if(timed).alias("timed"),
        F.coalesce(F.sum(F.when(timed, window.windows_of(F.col(time)))), F.lit(0)).alias("in_windows"),
    )


def counting_windows(features: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """The same windows; each micro-batch tells how many come out and how many of them a model will not
    score, since an input is missing."""
    return features.observe(
        SCORED, F.count("*").alias("windows"), F.count_if(missing_input(inputs)).alias("unscored")
    )


@dataclass
class StreamCounts:
    """Sums over the micro-batches of one query or of several that went on from one checkpoint.

    Spark keeps the progress of a query's last batches only (a setting, 100 by default): take it in
    from time to time while the query runs, and once more when it has ended.
    """

    _batches: dict[tuple[str, str, int], dict[str, int]] = field(default_factory=dict)

    def take(self, query: StreamingQuery) -> StreamCounts:
        for progress in query.recentProgress:
            for name, row in progress.observedMetrics.items():
                self._batches[str(progress.runId), name, progress.batchId] = row.asDict()
        return self

    def total(self, name: str, metric: str) -> int:
        return sum(values[metric] or 0 for (_, of, _), values in self._batches.items() if of == name)

    @property
    def rows(self) -> int:
        return self.total(READ, "rows")

    @property
    def timeless_rows(self) -> int:
        """Rows without an event time, which are in no window."""
        return self.rows - self.total(READ, "timed")

    @property
    def windows(self) -> int:
        return self.total(SCORED, "windows")

    @property
    def unscored_windows(self) -> int:
        return self.total(SCORED, "unscored")

    def late_rows(self, emitted: int, open_rows: int) -> int:
        """Rows dropped as late: what was read, less the rows in the windows that came out and in those
        still open. A row of several windows counts for each that no longer took it."""
        return self.total(READ, "in_windows") - emitted - open_rows
