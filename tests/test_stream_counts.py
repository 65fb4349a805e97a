"""Order of a replay, what a stream counts, and what its checkpoint holds."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.windows import EventWindow, Measures, window_features
from riskloom.session import stream_session
from riskloom.sources.folders import Folder
from riskloom.sources.messages import file_messages
from riskloom.streaming import replay
from riskloom.streaming.counts import StreamCounts
from riskloom.streaming.replay import replay_to_files
from riskloom.streaming.scoring import message_features
from riskloom.streaming.sinks import append_files
from riskloom.streaming.state import open_windows

from helpers import at, plain_times, rows

DDL = "ts TIMESTAMP, v DOUBLE, c STRING"
START = dt.datetime(2024, 1, 1)


def sent(spark, count=400, seed=3):
    rng = random.Random(seed)
    made = [(START + dt.timedelta(minutes=rng.randint(0, 3000)), float(rng.randint(0, 9)), rng.choice("ab")) for _ in range(count)]
    return spark.createDataFrame(made, "ts TIMESTAMP_NTZ, v DOUBLE, c STRING")


def visible(path):
    """Files in the order in which a stream takes them."""
    names = [n for n in os.listdir(path) if not n.startswith(("_", "."))]
    times = {n: os.stat(f"{path}/{n}").st_mtime_ns for n in names}
    assert len(set(times.values())) == len(names)
    return sorted(names, key=times.get)


def lines_of(path):
    return [open(f"{path}/{n}").read().splitlines() for n in visible(path)]


def test_files_become_visible_in_order(spark, tmp_path):
    path = str(tmp_path / "m")
    replay_to_files(sent(spark), path, ["ts", "v", "c"], files=5, rows_per_file=30)
    files = lines_of(path)
    assert len(files) > 10 and sum(map(len, files)) == 400
    flat = [line for lines in files for line in lines]
    assert flat == sorted(flat)
    later = sent(spark, 100).withColumn("ts", F.col("ts") + F.expr("INTERVAL 9 DAYS"))
    replay_to_files(later, path, ["ts", "v", "c"], files=3, mode="append")
    flat = [line for lines in lines_of(path) for line in lines]
    assert flat == sorted(flat) and len(flat) == 500
    assert not [n for n in os.listdir(path) if n.startswith("_staged")]


def test_a_replay_cut_short_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    moves = []

    def failing(self, name, target, real=Folder.move):
        if len(moves) == 3:
            raise OSError("lost")
        moves.append(target)
        real(self, name, target)

    monkeypatch.setattr(Folder, "move", failing)
    with pytest.raises(OSError, match="lost"):
        replay_to_files(sent(spark), path, ["ts", "v", "c"], files=8, run="first")
    assert len(visible(path)) == 3
    monkeypatch.undo()
    monkeypatch.setattr(replay, "message_value", None)  # nothing is written anew
    replay_to_files(sent(spark), path, ["ts", "v", "c"], files=8, run="first")
    flat = [line for lines in lines_of(path) for line in lines]
    assert flat == sorted(flat) and len(flat) == 400
    replay_to_files(sent(spark), path, ["ts", "v", "c"], files=8, run="first")  # through: nothing happens
    assert sum(map(len, lines_of(path))) == 400


def test_modes_of_a_replay(spark, tmp_path):
    path = str(tmp_path / "m")
    replay_to_files(sent(spark), path, ["ts"], files=2)
    with pytest.raises(FileExistsError):
        replay_to_files(sent(spark), path, ["ts"], files=2)
    replay_to_files(sent(spark, 50), path, ["ts"], files=2, mode="overwrite")
    assert sum(map(len, lines_of(path))) == 50
    replay_to_files(sent(spark, 10).limit(0), str(tmp_path / "none"), ["ts"], files=2)
    assert sum(map(len, lines_of(tmp_path / "none"))) == 0


def streamed(spark, tmp_path, measures, window, delay, files=(), order=None):
    """A stream over files of lines, one a batch; (query, counts, emitted windows, checkpoint)."""
    source = tmp_path / "in"
    source.mkdir()
    for k, lines in enumerate(files):
        (source / f"{k}.csv").write_text("\n".join(lines) + "\n")
        os.utime(source / f"{k}.csv", (1000 + k, 1000 + k))
    messages = file_messages(stream_session(spark), str(source), 1)
    features = message_features(messages, window, DDL, measures, "ts", delay)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = append_files(features, out, checkpoint, "parquet", available_now=True)
    query.awaitTermination()
    return StreamCounts().take(query), spark.read.parquet(out), checkpoint


@pytest.mark.parametrize("window", [EventWindow("1 hour"), EventWindow("1 hour", "20 minutes"), EventWindow("50 minutes", "20 minutes")], ids=str)
@pytest.mark.parametrize("modes", [["c"], []])
def test_late_rows_and_open_windows(spark, tmp_path, window, modes):
    """Against the rule itself: a window takes no more rows once the watermark has reached its end."""
    rng = random.Random(len(modes))
    files, times = [], []
    for k in range(4):
        own = [START + dt.timedelta(hours=2 * k, minutes=rng.randint(-260, 100)) for _ in range(60)]
        files.append([f"{t},{rng.randint(0, 5)},a" for t in own] + [",1,a", "broken,1,b"])
        times.append(own)
    measures = Measures(means=["v"], modes=modes, count="n")
    counts, emitted, checkpoint = streamed(spark, tmp_path, measures, window, "30 minutes", files)
    df = spark.createDataFrame([(k, t) for k, own in enumerate(times) for t in own], "k INT, ts TIMESTAMP")
    placed = [tuple(r) for r in df.select("k", F.window("ts", window.duration, window.slide)["end"]).collect()]
    marks = [max(own) - dt.timedelta(minutes=30) for own in times]
    # Rows of a batch are judged by the watermark that the batch before it began with.
    late = sum(k > 1 and end <= max(marks[: k - 1]) for k, end in placed)
    held = sum(end > max(marks) for _, end in placed)
    still_open = open_windows(spark, checkpoint, measures)
    in_state = still_open.agg(F.sum("n")).first()[0] or 0
    put_out = emitted.agg(F.sum("n")).first()[0]
    assert counts.rows == 4 * 62 and counts.timeless_rows == 8
    assert in_state == held > 0
    assert counts.late_rows(put_out, in_state) == late > 0


def test_open_windows_hold_means_so_far(spark, tmp_path):
    lines = ["2024-01-01 10:05:00,1,a", "2024-01-01 10:15:00,4,b", "2024-01-01 11:10:00,,b"]
    measures = Measures(means=["v"], modes=["c"], count="n")
    _, emitted, checkpoint = streamed(spark, tmp_path, measures, EventWindow("1 hour"), "1 day", [lines])
    assert emitted.count() == 0
    found = rows(plain_times(open_windows(spark, checkpoint, measures)))
    assert [r[:2] for r in found] == [(1, None), (2, 2.5)]


def test_windows_of_a_time(spark):
    times = [at("2024-01-01 00:00"), at("2024-01-01 00:09:59.999999"), at("2024-01-01 00:10"), at("1969-12-31 23:55"), at("2024-03-03 03:19:59")]
    df = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP")
    for window in (EventWindow("1 hour"), EventWindow("50 minutes", "20 minutes"), EventWindow("1 day", "7 hours")):
        counted = df.select("t", window.windows_of(F.col("t")).alias("n")).collect()
        plain = {r.t: r["count"] for r in df.groupBy("t", window.over("t")).count().groupBy("t").count().collect()}
        assert {r.t: r.n for r in counted} == plain
    with pytest.raises(ValueError):
        EventWindow("1 month").windows_of(F.col("t"))


def test_table_features_have_no_metrics(spark):
    df = sent(spark, 20)
    assert window_features(df, EventWindow("1 hour"), Measures(means=["v"], count="n"), "ts").count() > 0
