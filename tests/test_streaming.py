import datetime as dt
import glob
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskloom.functions.intervals import micros
from riskloom.operators.windows import EventWindow, Measures, closed_windows, window_features
from riskloom.session import fresh_folder, shared_folder, stream_session, utc_session
from riskloom.sources.messages import file_messages, kafka_messages
from riskloom.streaming.replay import replay_to_files, replay_to_topic
from riskloom.streaming.scoring import message_features
from riskloom.streaming.sinks import append_files

from helpers import at, plain_times, rows

DDL = "ts TIMESTAMP, v DOUBLE, c STRING"
MEASURES = Measures(means=["v"], modes=["c"], count="n")
HOUR = EventWindow("1 hour")


class Stream:
    """Message files in one folder, run to the end after each new file."""

    def __init__(self, spark, folder, window=HOUR, delay=None):
        self.spark, self.folder, self.count = spark, folder, 0
        self.source, self.target, self.checkpoint = (
            folder / name for name in ("in", "out", "checkpoint")
        )
        self.source.mkdir()
        self.window, self.delay = window, delay

    def send(self, *lines):
        self.count += 1
        (self.source / f"{self.count:03}.csv").write_text("".join(f"{line}\n" for line in lines))
        features = message_features(
            file_messages(stream_session(self.spark), str(self.source)),
            self.window, DDL, MEASURES, "ts", self.delay,
        )
        query = append_files(features, str(self.target), str(self.checkpoint), available_now=True)
        query.awaitTermination()
        return query

    def windows(self):
        """Emitted windows: start hour to count, value and category."""
        ddl = "window_start TIMESTAMP, window_end TIMESTAMP, n BIGINT, v DOUBLE, c STRING"
        out = plain_times(self.spark.read.schema(ddl).json(str(self.target)))
        found = [(row.window_start, row.n, row.v, row.c) for row in out.collect()]
        assert len({start for start, *_ in found}) == len(found)
        return {str(start)[11:16]: tuple(rest) for start, *rest in found}


def test_window_is_emitted_when_the_watermark_reaches_its_end(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send("2024-01-01 00:10:00,1.0,a", "2024-01-01 00:20:00,3.0,b")
    stream.send("2024-01-01 01:59:59,1.0,a")
    assert stream.windows() == {}
    stream.send("2024-01-01 02:00:00,1.0,a")
    assert stream.windows() == {"00:00": (2, 2.0, "a")}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send("2024-01-01 00:10:00,1.0,a")
    stream.send("2024-01-01 05:00:00,1.0,a")
    assert set(stream.windows()) == {"00:00"}
    query = stream.send("2024-01-01 00:30:00,9.0,z", "2024-01-01 05:10:00,1.0,a")
    dropped = [
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    ]
    assert sum(dropped) > 0
    stream.send("2024-01-01 09:00:00,1.0,a")
    assert stream.windows() == {"00:00": (1, 1.0, "a"), "05:00": (2, 1.0, "a")}


def test_rows_within_the_delay_count(spark, tmp_path):
    stream = Stream(spark, tmp_path, delay="3 hours")
    stream.send("2024-01-01 00:10:00,1.0,a", "2024-01-01 03:30:00,1.0,a")
    stream.send("2024-01-01 00:40:00,3.0,b")
    stream.send("2024-01-01 04:30:00,1.0,a")
    assert stream.windows() == {"00:00": (2, 2.0, "a")}


def test_restart_goes_on_without_repeats(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    for hour in range(6):
        # Every send is a run of its own from the same checkpoint.
        stream.send(f"2024-01-01 0{hour}:10:00,{hour}.0,a", f"2024-01-01 0{hour}:50:00,{hour}.0,b")
    # The latest time is 05:50, so ends up to 04:50 have been passed.
    assert stream.windows() == {f"0{hour}:00": (2, float(hour), "a") for hour in range(4)}


def test_unreadable_times_are_in_no_window(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send("", "soon,1.0,a", ",1.0,a", "2024-01-01 00:10:00,1.0,a")
    stream.send("2024-01-01 02:00:00,1.0,a")
    assert stream.windows() == {"00:00": (1, 1.0, "a")}


@pytest.mark.parametrize("window", [HOUR, EventWindow("2 hours", "30 minutes")], ids=str)
def test_stream_equals_table_on_closed_windows(spark, tables, tmp_path, window):
    events = spark.read.parquet(f"{tables}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.round(F.col("value") * 100).alias("v"),
        F.col("event_type").alias("c"),
    )
    source = str(tmp_path / "in")
    replay_to_files(events, source, ["ts"], 4)
    assert len(glob.glob(f"{source}/*.txt")) == 4
    features = message_features(
        file_messages(stream_session(spark), source), window, DDL, MEASURES, "ts"
    )
    target = str(tmp_path / "out")
    append_files(
        features, target, str(tmp_path / "checkpoint"), "parquet", available_now=True
    ).awaitTermination()
    table = window_features(events, window, MEASURES, "ts")
    expected = closed_windows(table, events, "ts", window.duration)
    assert rows(spark.read.parquet(target)) == rows(expected)


def test_file_sink_takes_finished_windows_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    features = message_features(
        file_messages(stream_session(spark), str(tmp_path / "in")), HOUR, DDL, MEASURES, "ts"
    )
    with pytest.raises(AnalysisException):
        features.writeStream.outputMode("update").format("json").option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        ).start(str(tmp_path / "out"))


def test_topics_need_their_connector(spark, tmp_path):
    """Without Spark's Kafka package both say which data source is missing."""
    table = spark.range(1)
    for call in (
        lambda: kafka_messages(spark, "localhost:9092", "topic", maxOffsetsPerTrigger="10"),
        lambda: replay_to_topic(table, "localhost:9092", "topic"),
    ):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            call()


def test_replay_splits_a_time_that_most_rows_share(spark, tmp_path):
    df = spark.range(9000).select(
        F.when(F.col("id") < 6000, F.lit("2024-01-01 00:00:00"))
        .otherwise(F.lit("2024-01-02 00:00:00"))
        .cast("timestamp")
        .alias("ts"),
        "id",
    )
    replay_to_files(df, str(tmp_path / "in"), ["ts", "id"], 6)
    sizes = [
        row["count"]
        for row in spark.read.text(str(tmp_path / "in"))
        .groupBy(F.input_file_name())
        .count()
        .collect()
    ]
    assert sum(sizes) == 9000 and max(sizes) < 3000


def test_stream_session_leaves_the_callers_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark)
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_shared_folder_follows_the_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert shared_folder(spark, "given") == "given"


def test_categories_need_chained_aggregates(spark, tmp_path):
    """With the setting false no window would ever come out."""
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    session = stream_session(spark)
    assert session.conf.get(key) == "true"
    session.conf.set(key, "false")
    messages = file_messages(session, str(tmp_path))
    with pytest.raises(ValueError, match="allowMultiple"):
        message_features(messages, HOUR, DDL, MEASURES, "ts")
    plain = Measures(means=["v"], count="n")
    assert message_features(messages, HOUR, DDL, plain, "ts").isStreaming


def test_queries_leave_the_callers_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        session = utc_session(spark)
        assert session.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_replay_bounds_the_rows_of_a_file(spark, tmp_path):
    replay_to_files(spark.range(5000), str(tmp_path / "in"), ["id"], rows_per_file=700)
    lines = spark.read.text(str(tmp_path / "in")).groupBy(F.input_file_name()).count()
    sizes = [row["count"] for row in lines.collect()]
    assert sum(sizes) == 5000 and max(sizes) <= 700


def test_rows_at_the_window_edge(spark):
    df = spark.createDataFrame([(at("2024-01-01 01:00:00"), 1.0, "a")], DDL)
    (row,) = plain_times(window_features(df, HOUR, MEASURES, "ts")).collect()
    assert row.window_start == at("2024-01-01 01:00:00")


def test_state_rows_stay_small_for_a_category_without_bound(spark, tmp_path):
    """A window's categories are state rows of their own; the reduced rows are not kept."""
    stream = Stream(spark, tmp_path)
    query = stream.send(*[f"2024-01-01 00:10:00,1.0,c{number:04}" for number in range(2000)])
    reduce, count = query.recentProgress[0]["stateOperators"]
    assert (reduce["numRowsTotal"], count["numRowsTotal"]) == (0, 2000)
    stream.send("2024-01-01 00:20:00,1.0,c0007", "2024-01-01 05:00:00,1.0,a")
    assert stream.windows() == {"00:00": (2001, 1.0, "c0007")}


def test_stream_without_categories_keeps_one_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("2024-01-01 00:10:00,1.0,a\n2024-01-01 05:00:00,1.0,a\n")
    features = message_features(
        file_messages(stream_session(spark), str(tmp_path / "in")),
        HOUR, DDL, Measures(means=["v"], count="n"), "ts",
    )
    query = append_files(
        features, str(tmp_path / "out"), str(tmp_path / "checkpoint"), available_now=True
    )
    query.awaitTermination()
    assert {len(progress["stateOperators"]) for progress in query.recentProgress} == {1}
    assert spark.read.json(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize("window", [HOUR, EventWindow("2 hours", "30 minutes")], ids=str)
def test_random_batches_follow_the_watermark(spark, tmp_path, window):
    """Against a plain count of what each batch may still add to and what it closes."""
    draw = random.Random(11)
    length = dt.timedelta(microseconds=micros(window.duration))
    step = dt.timedelta(microseconds=micros(window.slide or window.duration))
    delay = dt.timedelta(minutes=45)
    stream = Stream(spark, tmp_path, window, "45 minutes")
    start, watermark, latest = at("2024-01-01 00:00:00"), dt.datetime.min, dt.datetime.min
    counts, emitted = {}, {}
    for batch in range(5):
        minutes = [70 * batch + draw.randrange(-240, 90) for _ in range(30)]
        times = [start + dt.timedelta(minutes=m, seconds=draw.randrange(60)) for m in minutes]
        stream.send(*[f"{time},1.0,a" for time in times])
        for time in times:
            opening = time - (time - dt.datetime(1970, 1, 1)) % step
            while opening + length > time:
                if opening + length > watermark:
                    counts[opening] = counts.get(opening, 0) + 1
                opening -= step
        latest = max(latest, *times)
        watermark = latest - delay
        for opening in [opening for opening in counts if opening + length <= watermark]:
            emitted[opening] = counts.pop(opening)
    ddl = "window_start TIMESTAMP, n BIGINT"
    found = plain_times(spark.read.schema(ddl).json(str(stream.target))).collect()
    assert emitted and counts
    assert {row.window_start: row.n for row in found} == emitted
    assert len(found) == len(emitted)
