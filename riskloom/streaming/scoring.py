"""Messages in, scored windows out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskloom import schema
from riskloom.operators.parsing import message_text, parse_csv
from riskloom.operators.windows import (
    ACCIDENT_MEASURES,
    EventWindow,
    Measures,
    window_features,
)
from riskloom.sources.predictions import with_day
from riskloom.streaming.counts import counting_rows, counting_windows
from riskloom.streaming.sinks import append_files


def message_features(
    messages: DataFrame,
    window: EventWindow,
    ddl: str = schema.ACCIDENT_DDL,
    measures: Measures = ACCIDENT_MEASURES,
    time: str = schema.EVENT_TIME,
    delay: str | None = None,
) -> DataFrame:
    """Window features of CSV messages, from a stream or from a table of messages."""
    rows = parse_csv(message_text(messages), ddl)
    if messages.isStreaming:
        rows = counting_rows(rows, window, time)
    return window_features(rows, window, measures, time, delay)


def score_messages(
    messages: DataFrame,
    model: PipelineModel,
    window: EventWindow,
    path: str,
    checkpoint: str,
    delay: str | None = None,
    by_day: bool = False,
    **trigger,
) -> StreamingQuery:
    """Start the scoring stream: parse, window, apply the model, append JSON lines.

    ``StreamCounts`` takes from the query what it has read and left unscored. ``by_day`` writes a
    folder for each day of the windows' starts.
    """
    inputs = ACCIDENT_MEASURES.averaged
    features = counting_windows(message_features(messages, window, delay=delay), inputs)
    scored = model.transform(features)
    if by_day:
        return append_files(with_day(scored), path, checkpoint, partition_by=[schema.DAY_COLUMN], **trigger)
    return append_files(scored, path, checkpoint, **trigger)
