"""Event-time window features: means, flag rates, most frequent categories and a count.

One call serves tables and streams, by the same aggregates. A stream sets a watermark and keeps
its open windows as state. A table's sliding windows are put together from panes, so that its
rows are aggregated once instead of once per window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import schema
from riskloom.functions.intervals import micros


# With this setting false, Spark lets the second of two aggregates take all rows for late.
CHAINED = "spark.sql.streaming.statefulOperator.allowMultiple"


@dataclass(frozen=True)
class EventWindow:
    """A tumbling window of one duration, or a sliding one with a slide as well."""

    duration: str
    slide: str | None = None

    @classmethod
    def of(cls, kind: str, duration: str, slide: str | None = None) -> EventWindow:
        kind = kind.lower()
        if kind == "tumbling":
            return cls(duration)
        if kind == "sliding":
            if not slide:
                raise ValueError("a sliding window needs a slide duration")
            return cls(duration, slide)
        raise ValueError(f"window kind must be 'tumbling' or 'sliding', not {kind!r}")

    def over(self, time: str | Column) -> Column:
        return F.window(time, self.duration, self.slide)

    def rest(self) -> int | None:
        """What the slide leaves over of the duration, in microseconds; None for a window that does
        not slide and for lengths that Spark has to judge."""
        slide, duration = (micros(x) if x else None for x in (self.slide, self.duration))
        return duration % slide if slide and duration else None

    def pane(self, slide_start: Column, time: Column) -> Column:
        """Start of the pane that holds a time of the slide that begins at ``slide_start``.

        Windows begin with slides and end where a slide begins or, if the slide does not divide the
        duration, the rest of the division later. So each slide is one pane, or two that meet there,
        and every window is a whole number of panes.
        """
        second = slide_start + F.expr(f"INTERVAL {self.rest()} MICROSECONDS")
        return F.when(time >= second, second).otherwise(slide_start) if self.rest() else slide_start


    def windows_of(self, time: Column) -> Column:
        """In how many windows a time is."""
        duration, slide = micros(self.duration), micros(self.slide or self.duration)
        if not duration or not slide:
            raise ValueError(f"lengths of {self} are not known in microseconds")
        within = F.pmod(F.unix_micros(time), F.lit(slide)) < duration % slide
        return F.lit(duration // slide) + F.when(within, 1).otherwise(0)


@dataclass(frozen=True)
class Measures:
    """What to compute per window; names are input columns and output columns alike."""

    means: Sequence[str] = field(default_factory=list)
    rates: Sequence[str] = field(default_factory=list)
    modes: Sequence[str] = field(default_factory=list)
    count: str = schema.COUNT_COLUMN

    @property
    def averaged(self) -> list[str]:
        return [*self.means, *self.rates]


ACCIDENT_MEASURES = Measures(
    means=schema.MEAN_COLUMNS, rates=schema.RATE_COLUMNS, modes=schema.CATEGORY_COLUMNS
)


def window_features(
    df: DataFrame,
    window: EventWindow,
    measures: Measures = ACCIDENT_MEASURES,
    time: str = schema.EVENT_TIME,
    delay: str | None = None,
) -> DataFrame:
    """One row per event-time window. Rows without an event time are in no window.

    The most frequent category skips nulls and takes the lowest value on a tie. ``delay`` is the
    watermark delay of a stream, by default the window duration.
    """
    # Drop what is not measured before the shuffle; a parsed message carries every field.
    rows = df.select(
        time,
        *[F.col(name).cast("double").alias(name) for name in measures.averaged],
        *[F.col(name).cast("string").alias(name) for name in measures.modes],
    )
    if df.isStreaming:
        # Late rows are judged by their windows, so they go into windows at once and not by pane.
        if measures.modes and df.sparkSession.conf.get(CHAINED, "true").lower() == "false":
            raise ValueError(f"categories over a stream need {CHAINED} to be true")
        rows = rows.withWatermark(time, delay or window.duration)
    windows = _aggregate(rows, window, measures, time)
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        measures.count,
        *measures.averaged,
        *measures.modes,
    )


def _aggregate(rows: DataFrame, window: EventWindow, measures: Measures, time: str) -> DataFrame:
    """Count the values of each category per window, then reduce each window to one row.

    Every row is repeated once per category, and its measures count in the first copy only
    (``_slot`` 0), so one scan feeds all aggregates. Grouping by category value too means that no
    buffer holds a window's whole set of categories, and a window with most of the rows is spread
    over as many groups as it has values, after partial aggregation on the map side. In a stream
    both steps are stateful, and a closed window passes through them in one micro-batch.

    A table's sliding windows overlap. There the first step is by pane, so that a row is aggregated
    once, and its results are rolled up to windows.
    """
    names = measures.averaged
    panes = window.rest() is not None and not rows.isStreaming
    keys = []
    if measures.modes:
        slots = [
            F.struct(F.lit(slot).alias("_slot"), F.col(name).alias("_value"))
            for slot, name in enumerate(measures.modes)
        ]
        rows = rows.select(time, *names, F.inline(F.array(*slots)))
        keys = ["_slot", "_value"]

    first = "FILTER (WHERE _slot = 0)" if keys else ""
    if panes:
        rows = rows.withColumn("_slide", F.window(time, window.slide))
        grouping = window.pane(F.col("_slide.start"), F.col(time)).alias("_pane")
    else:
        grouping = window.over(time).alias("window")
    parts = rows.groupBy(grouping, *keys).agg(
        F.expr("count(*) AS _rows"),
        *[F.expr(f"sum(`{name}`) {first} AS `_sum_{name}`") for name in names],
        *[F.expr(f"count(`{name}`) {first} AS `_count_{name}`") for name in names],
    )
    if panes:
        # All boundaries of the windows are pane boundaries, so a pane lies in the windows of its
        # start. Panes are few next to rows: the copies per window are made after the scan.
        totals = ["_rows", *[f"_{part}_{name}" for name in names for part in ("sum", "count")]]
        parts = parts.groupBy(window.over("_pane").alias("window"), *keys).agg(
            *[F.expr(f"sum(`{name}`) AS `{name}`") for name in totals]
        )
    if not keys:
        return parts.select(
            "window",
            F.expr(f"_rows AS `{measures.count}`"),
            *[F.expr(f"try_divide(`_sum_{name}`, `_count_{name}`) AS `{name}`") for name in names],
        )

    # The category with the most rows has the lowest negated count; the value decides on a tie.
    most_frequent = (
        "(min(struct(-_rows AS place, _value AS value))"
        " FILTER (WHERE _slot = {slot} AND _value IS NOT NULL)).value AS `{name}`"
    )
    return parts.groupBy("window").agg(
        F.expr(f"sum(_rows) {first} AS `{measures.count}`"),
        *[
            F.expr(f"try_divide(sum(`_sum_{name}`), sum(`_count_{name}`)) AS `{name}`")
            for name in names
        ],
        *[
            F.expr(most_frequent.format(slot=slot, name=name))
            for slot, name in enumerate(measures.modes)
        ],
    )


def closed_windows(windows: DataFrame, rows: DataFrame, time: str, delay: str) -> DataFrame:
    """The windows a stream over ``rows`` has emitted by its end in append mode.

    A window is out once the latest event time, in whole milliseconds, less the delay has reached
    the window's end. The bound is a scalar subquery: one row, never joined.
    """
    latest = rows.agg(F.date_trunc("millisecond", F.max(time)).alias("latest"))
    bound = latest.select(F.col("latest") - F.expr(f"INTERVAL '{delay}'")).scalar()
    return windows.where(F.col("window_end") <= bound)


def missing_input(inputs: Sequence[str]) -> Column:
    """Whether a row lacks an input of a model."""
    missing = F.lit(False)
    for name in inputs:
        missing = missing | F.col(name).isNull() | F.isnan(name)
    return missing


def incomplete_windows(windows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """How many windows a model skips because a measure is missing, next to all windows."""
    return windows.agg(
        F.count("*").alias("windows"), F.count_if(missing_input(inputs)).alias("skipped_windows")
    )
