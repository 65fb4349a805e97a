import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from riskloom.functions.intervals import micros
from riskloom.operators.windows import (
    EventWindow,
    Measures,
    closed_windows,
    incomplete_windows,
    window_features,
)

from helpers import at, final_plan, rows

MEASURES = Measures(means=["v"], rates=["flag"], modes=["c", "d"], count="n")
DDL = "ts TIMESTAMP_NTZ, v DOUBLE, flag BOOLEAN, c STRING, d STRING"


def table(spark, data):
    return spark.createDataFrame(data, DDL)


def random_table(spark, count=2000, seed=1):
    draw = random.Random(seed)
    start = at("2024-03-30 20:00:00")
    return table(
        spark,
        [
            (
                start + dt.timedelta(seconds=draw.randrange(36 * 3600)),
                draw.choice([None, float(draw.randrange(100))]),
                draw.choice([None, True, False]),
                draw.choice([None, "a", "b", "c"]),
                # A third of the rows and more share one value.
                draw.choice(["hot", "hot", str(draw.randrange(500))]),
            )
            for _ in range(count)
        ],
    )


def directly(df, window):
    """The same aggregates in one step, as a stream computes them."""
    return (
        df.groupBy(window.over("ts").alias("w"))
        .agg(
            F.count("*").alias("n"),
            F.avg("v").alias("v"),
            F.avg(F.col("flag").cast("double")).alias("flag"),
            F.mode("c", True).alias("c"),
            F.mode("d", True).alias("d"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n", "v", "flag", "c", "d",
        )
    )


@pytest.mark.parametrize(
    "window",
    [
        EventWindow("1 hour"),
        EventWindow("1 day"),
        EventWindow("1 hour", "15 minutes"),
        EventWindow("50 minutes", "20 minutes"),
        EventWindow("1 hour 30 minutes", "1 hour"),
        EventWindow("interval 2 hours", "interval 1 hour"),
        EventWindow("90 seconds", "60 seconds"),
    ],
    ids=str,
)
def test_panes_and_one_step_agree(spark, window):
    df = random_table(spark)
    assert rows(window_features(df, window, MEASURES, "ts")) == rows(directly(df, window))


def test_window_in_a_form_only_spark_reads(spark):
    window = EventWindow("1 hour", "interval '0:30' hour to minute")
    assert window.rest() is None
    df = random_table(spark, 200)
    assert rows(window_features(df, window, MEASURES, "ts")) == rows(
        window_features(df, EventWindow("1 hour", "30 minutes"), MEASURES, "ts")
    )


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_result_does_not_depend_on_partitions(spark, partitions):
    df, window = random_table(spark, 500), EventWindow("2 hours", "30 minutes")
    expected = rows(window_features(df, window, MEASURES, "ts"))
    assert rows(window_features(df.repartition(partitions), window, MEASURES, "ts")) == expected


def test_every_timed_row_is_in_duration_over_slide_windows(spark):
    df = random_table(spark, 777)
    counts = window_features(df, EventWindow("1 hour", "10 minutes"), MEASURES, "ts")
    assert counts.agg(F.sum("n")).first()[0] == 6 * 777


def test_null_time_is_in_no_window(spark):
    df = table(spark, [(None, 1.0, True, "a", "b"), (at("2024-01-01 00:10"), 2.0, None, "a", None)])
    for window in (EventWindow("1 hour"), EventWindow("1 hour", "30 minutes")):
        result = window_features(df, window, MEASURES, "ts")
        assert {row.n for row in result.collect()} == {1}


def test_mode_tie_nulls_and_empty_measures(spark):
    time = at("2024-01-01 00:10")
    df = table(
        spark,
        [
            (time, None, None, "b", None),
            (time, None, None, "a", None),
            (time, None, None, None, None),
            (time, None, None, None, None),
        ],
    )
    (row,) = window_features(df, EventWindow("1 hour"), MEASURES, "ts").collect()
    assert (row.n, row.v, row.flag, row.c, row.d) == (4, None, None, "a", None)


def test_nan_measure_makes_the_mean_nan(spark):
    time = at("2024-01-01 00:10")
    df = table(spark, [(time, float("nan"), True, "a", "b"), (time, 1.0, True, "a", "b")])
    (row,) = window_features(df, EventWindow("1 hour"), MEASURES, "ts").collect()
    assert row.v != row.v


def test_windows_start_before_the_first_row(spark):
    df = table(spark, [(at("2024-01-01 00:10"), 1.0, True, "a", "b")])
    starts = window_features(df, EventWindow("1 hour", "30 minutes"), MEASURES, "ts")
    assert [row.window_start for row in starts.orderBy("window_start").collect()] == [
        at("2023-12-31 23:30"),
        at("2024-01-01 00:00"),
    ]


def test_slide_longer_than_duration_is_refused(spark):
    df = random_table(spark, 5)
    with pytest.raises(AnalysisException):
        window_features(df, EventWindow("1 hour", "2 hours"), MEASURES, "ts").collect()


@pytest.mark.parametrize(
    "window", [EventWindow("1 month"), EventWindow("1 month", "1 day")], ids=str
)
def test_months_are_refused(spark, window):
    with pytest.raises(PySparkException, match="month"):
        window_features(random_table(spark, 5), window, MEASURES, "ts").collect()


def test_kinds():
    assert EventWindow.of("Tumbling", "1 hour", "1 hour") == EventWindow("1 hour")
    assert EventWindow.of("sliding", "1 hour", "5 minutes").slide == "5 minutes"
    with pytest.raises(ValueError):
        EventWindow.of("session", "1 hour")
    with pytest.raises(ValueError):
        EventWindow.of("sliding", "1 hour")


def test_intervals():
    assert micros("1 day 12 hours") == 36 * 3_600_000_000
    assert micros("interval 90 seconds") == 90_000_000
    assert micros("1 month") is None and micros("soon") is None
    assert EventWindow("1 hour", "15 minutes").rest() == 0
    assert EventWindow("1 hour", "59 minutes 59 seconds").rest() == 1_000_000
    assert EventWindow("1 hour").rest() is None
    assert EventWindow("1 month", "1 day").rest() is None


def test_panes_of_an_uneven_slide(spark):
    """Two panes a slide, which meet where windows end; times on an edge belong to the later one."""
    times = ["00:00", "00:09:59.999999", "00:10", "00:19:59", "00:20", "00:30", "23:59:59"]
    df = spark.createDataFrame([(at(f"1969-12-31 {t}"),) for t in times], "t TIMESTAMP_NTZ")
    window = EventWindow("50 minutes", "20 minutes")
    starts = df.select("t", F.window("t", window.slide).alias("s")).select(
        "t", window.pane(F.col("s.start"), F.col("t")).alias("p")
    )
    found = [(str(r.t.time()), str(r.p.time())) for r in starts.collect()]
    assert [p for _, p in found] == ["00:00:00", "00:00:00", "00:10:00", "00:10:00", "00:20:00", "00:30:00", "23:50:00"]


@pytest.mark.parametrize("seed", range(4))
def test_any_uneven_window(spark, seed):
    rng = random.Random(seed)
    slide = rng.randint(60, 4000)
    window = EventWindow(f"{slide * rng.randint(1, 5) + rng.randint(1, slide - 1)} seconds", f"{slide} seconds")
    df = random_table(spark, 300)
    assert rows(window_features(df, window, MEASURES, "ts")) == rows(directly(df, window))


def test_incomplete_windows(spark):
    df = table(
        spark,
        [
            (at("2024-01-01 00:10"), 1.0, True, "a", "b"),
            (at("2024-01-01 01:10"), None, True, "a", "b"),
            (at("2024-01-01 02:10"), float("nan"), True, "a", "b"),
        ],
    )
    features = window_features(df, EventWindow("1 hour"), MEASURES, "ts")
    assert tuple(incomplete_windows(features, ["v", "flag"]).first()) == (3, 2)


def test_closed_windows(spark):
    df = table(
        spark,
        [(at(f"2024-01-01 0{hour}:00:00"), 1.0, True, "a", "b") for hour in (0, 1, 2, 3)],
    )
    features = window_features(df, EventWindow("1 hour"), MEASURES, "ts")
    closed = closed_windows(features, df, "ts", "1 hour")
    assert sorted(row.window_end.hour for row in closed.collect()) == [1, 2]


@pytest.mark.parametrize("window", [EventWindow("6 hours", "1 hour"), EventWindow("50 minutes", "20 minutes")], ids=str)
def test_plan_is_one_scan_without_python_or_cross_join(spark, tables, window):
    from bindings.spark_queries import accidents

    df = accidents(spark, tables)
    plan = final_plan(window_features(df, window))
    assert plan.count("FileScan") == 1
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    # Rows are multiplied into windows only above the first, partial and final, aggregate.
    assert plan.index("Expand") < plan.index("partial_count")
    assert "props" not in plan.split("ReadSchema")[1]
