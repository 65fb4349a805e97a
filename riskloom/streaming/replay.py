"""Replay of a table as messages."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from riskloom.operators.parsing import message_value, to_messages
from riskloom.sources.folders import Folder


ROWS_PER_FILE = 1_000_000


def replay_to_files(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    files: int | None = None,
    mode: str = "error",
    rows_per_file: int = ROWS_PER_FILE,
    run: str | None = None,
) -> None:
    """Write the table as text files of messages, each file one stretch of the given order and of
    at most ``rows_per_file`` messages, and let readers see them one after the other in that order.

    The table is cut into ``files`` stretches, or as Spark sizes them by the shuffle settings.
    Name the event time first and a key after it: the key splits a time that very many rows share.

    The files are written aside by all tasks and then moved into the folder in the order of the
    stretches, with rising times. A file source takes files by their time, so a stream that reads
    them one by one never meets a row earlier than those it has seen, whatever its delay.

    With a name for the ``run``, a replay that was cut short can be repeated under that name: what
    is written is not written again, what is visible stays, and the rest follows. A run that is
    through does nothing. ``mode`` is Spark's: ``error``, ``append`` or ``overwrite``.
    """
    folder = Folder(df.sparkSession, path)
    name = run or uuid.uuid4().hex
    staged, done = f"_staged-{name}", f"_published-{name}"
    if folder.has(done):
        return
    if not folder.has(f"{staged}/_READY"):
        if mode == "error" and folder.times():
            raise FileExistsError(f"{path} holds messages already")
        if mode == "overwrite":
            folder.remove()
        sliced = df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
        lines = sliced.select(message_value(df).alias("value"))
        lines.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(f"{path}/{staged}")
        folder.mark(f"{staged}/_READY")
    publish(folder, staged)
    if run:
        folder.mark(done)
    folder.remove(staged)


def publish(folder: Folder, staged: str) -> None:
    """Move what is staged into the folder in the order of the stretches, later than all that is
    there. Files that an earlier call has moved are not staged any more and precede the rest."""
    waiting = sorted(folder.times(staged), key=_place)
    first = max(round(time.time() * 1000), max(folder.times().values(), default=0) + 1)
    for place, file in enumerate(waiting):
        folder.set_time(f"{staged}/{file}", first + place)
        folder.move(f"{staged}/{file}", file)


def _place(file: str) -> tuple[int, int]:
    """Number of the stretch and of the file in it, from the name that Spark's writer gives."""
    stretch, part = re.match(r"part-(\d+)-.*-c(\d+)", file).groups()
    return int(stretch), int(part)


def replay_to_topic(df: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send the whole table to a topic as one job; every task sends its own partition."""
    (
        to_messages(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
