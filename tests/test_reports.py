import json

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, assume, given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom import schema
from riskloom.functions.columns import round_half_even
from riskloom.operators import reports
from riskloom.plans.reporting import report_tables, write_reports
from riskloom.sources.predictions import read_predictions

from helpers import at, final_plan

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def histogram(spark, values, bins=20):
    df = spark.createDataFrame([(value,) for value in values], "high_severity_prob DOUBLE")
    return reports.probability_histogram(df, bins=bins).orderBy("bin").collect()


@few
@given(
    st.lists(st.floats(0, 1) | st.sampled_from([0.05 * i for i in range(21)]), min_size=1),
    st.sampled_from([4, 20]),
)
def test_histogram_equals_numpy(spark, values, bins):
    assume(max(values) == min(values) or max(values) - min(values) > 1e-9)
    counts, edges = np.histogram(values, bins=bins)
    found = histogram(spark, values, bins)
    assert [row["count"] for row in found] == counts.tolist()
    assert [row.bin_start for row in found] + [found[-1].bin_end] == edges.tolist()


def test_histogram_of_equal_values_nulls_and_nothing(spark):
    found = histogram(spark, [0.5, 0.5, None, float("nan")], 4)
    assert [row["count"] for row in found] == [0, 0, 2, 0]
    assert (found[0].bin_start, found[-1].bin_end) == (0.0, 1.0)
    found = histogram(spark, [None], 4)
    assert [row["count"] for row in found] == [0, 0, 0, 0]


def test_histogram_plan(spark, tables):
    from bindings.spark_queries import prob_histogram

    df = prob_histogram(spark, tables)
    df.collect()
    plan = final_plan(df)
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "ReusedSubquery" in plan


@few
@given(st.lists(st.floats(0, 1) | st.integers(0, 2000).map(lambda i: i / 2000), min_size=1))
def test_rounding_equals_numpy(spark, values):
    df = spark.createDataFrame([(value,) for value in values], "x DOUBLE")
    found = [row[0] for row in df.select(round_half_even(F.col("x"), 3)).collect()]
    assert found == np.round(values, 3).tolist()


def predictions(spark, data):
    return spark.createDataFrame(
        data,
        "window_start TIMESTAMP_NTZ, Weather_Condition STRING, prediction DOUBLE, "
        "high_severity_prob DOUBLE, accident_count BIGINT",
    )


def test_category_report_equals_pandas(spark):
    data = [
        (at("2024-01-01 00:00:00"), "Fog", 1.0, 0.0625, 3),
        (at("2024-01-01 01:00:00"), "Rain", 0.0, 0.25, 4),
        (at("2024-01-01 02:00:00"), "Rain", 1.0, 0.75, 5),
        (at("2024-01-01 03:00:00"), "Clear", 1.0, 0.9, 6),
        (at("2024-01-01 04:00:00"), None, 1.0, 0.9, 7),
        (at("2024-01-01 05:00:00"), "Snow", 1.0, None, 8),
    ]
    df = predictions(spark, data)
    frame = pd.DataFrame(data, columns=df.columns)
    expected = (
        frame.groupby("Weather_Condition")
        .agg({"prediction": "mean", "high_severity_prob": "mean", "accident_count": "sum"})
        .round(3)
        .drop(index="Clear")
    )
    found = reports.category_report(df).toPandas().set_index("Weather_Condition").sort_index()
    np.testing.assert_array_equal(found.to_numpy(float), expected.to_numpy(float))
    assert found.loc["Fog", "Avg_Probability"] == 0.062


def test_top_is_ranked_by_the_rounded_value_then_name(spark):
    names = [f"k{number:02}" for number in range(20)]
    data = [
        (at("2024-01-01 00:00:00"), name, 1.0, 0.5 + 0.0001 * (number % 2), 1)
        for number, name in enumerate(names)
    ]
    found = reports.category_risk(predictions(spark, data)).collect()
    assert [row.Weather_Condition for row in found] == names[:15]
    assert not any(row.above_threshold for row in found)
    plan = final_plan(reports.category_risk(predictions(spark, data)))
    assert "TakeOrderedAndProject" in plan


def test_heatmap(spark):
    data = [
        (at("2024-01-01 05:10:00"), "Fog", 1.0, 0.25, 1),  # a Monday
        (at("2024-01-08 05:50:00"), "Fog", 1.0, 0.75, 1),
        (at("2024-01-07 06:00:00"), "Fog", 1.0, 0.5, 1),  # a Sunday
        (at("2024-01-03 07:00:00"), "Fog", 1.0, None, 1),
        (None, "Fog", 1.0, 0.5, 1),
    ]
    found = reports.hour_weekday_heatmap(predictions(spark, data)).orderBy("hour")
    assert found.columns == ["hour", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert [tuple(row) for row in found.collect()] == [
        (5, 0.5, None, None, None, None, None, None),
        (6, None, None, None, None, None, None, 0.5),
    ]


def test_threshold_is_exclusive(spark):
    data = [(at("2024-01-01 00:00:00"), "Fog", 1.0, p, 1) for p in (0.4, 0.5, 0.6, None)]
    (row,) = reports.threshold_split(predictions(spark, data)).collect()
    assert (row.above, row.up_to) == (1, 2)


def record(hour, probability):
    vector = {"type": 1, "values": [1 - probability, probability]}
    return json.dumps(
        {
            "window_start": f"2024-01-01T{hour:02}:00:00.000Z",
            "Weather_Condition": "Fog",
            "accident_count": 2,
            "probability": vector,
            "prediction": 1.0,
        }
    )


def test_read_back_skips_empty_files_and_broken_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(record(3, 0.75) + "\n" + record(1, 0.25) + "\n")
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text(record(2, 0.5) + "\n" + record(4, 0.5)[:60] + "\n")
    (tmp_path / "d.txt").write_text("not a prediction\n")
    found = reports.in_time_order(read_predictions(spark, str(tmp_path)))
    result = found.select("window_start", "high_severity_prob", "Wind_Direction").collect()
    assert [row.high_severity_prob for row in result] == [0.25, 0.5, 0.75]
    assert all(row.Wind_Direction is None for row in result)


@pytest.mark.parametrize("exists", [True, False])
def test_no_predictions_are_an_empty_table(spark, tmp_path, exists):
    folder = tmp_path / "none"
    if exists:
        folder.mkdir()
    found = read_predictions(spark, str(folder))
    assert found.count() == 0
    assert set(schema.CATEGORY_COLUMNS) < set(found.columns)
    tables = report_tables(found)
    assert tables["weather_risk"].count() == 0
    assert tables["hour_weekday_heatmap"].count() == 0
    write_reports(spark, str(folder), str(tmp_path / "reports"))
