import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom import schema
from riskloom.operators.cleaning import blank_missing, clean_accidents, coerce_times
from riskloom.operators.parsing import csv_record, message_text, parse_csv, to_messages
from riskloom.sources.tables import (
    read_accidents,
    read_csv,
    read_csv_inferred,
    read_raw_accidents,
    write_csv,
)

from helpers import at, plain_times, rows

DDL = "id INT, ts TIMESTAMP, text STRING, flag BOOLEAN, x DOUBLE, y STRING"


def parsed(spark, *lines, ddl=DDL, **more):
    df = spark.createDataFrame([(line,) for line in lines], "csv_line STRING")
    return parse_csv(df, ddl, **more)


def test_short_long_bad_and_empty_records(spark):
    long, short = "2,,b,True,1.5,y,extra", "1,2024-01-01 00:00:00,a"
    result = parsed(spark, short, long, "xx,,b", "2.0,,b", "")
    ids = [(row.id, row.text, row.y) for row in result.collect()]
    assert ids == [(1, "a", None), (2, "b", "y"), (None, "b", None), (None, "b", None), (None,) * 3]


def test_fraction_digits(spark):
    (row,) = plain_times(parsed(spark, "1,2016-02-08 05:46:00.000000000,a")).collect()
    assert row.ts == at("2016-02-08 05:46:00")


def test_doubled_quotes_and_commas(spark):
    ddl = "id INT, text STRING, flag BOOLEAN"
    (row,) = parsed(spark, '1,"say ""a, b"" ok",True', ddl=ddl).collect()
    assert tuple(row) == (1, 'say "a, b" ok', True)


def test_corrupt_column(spark):
    good, bad = parsed(
        spark, "1,a", "xx,b", ddl="id INT, text STRING", corrupt_column="bad"
    ).collect()
    assert (good.bad, bad.bad) == (None, "xx,b")


def test_record_is_one_line_and_parses_back(spark):
    text = 'a "quoted, one"\nsecond\r\nthird\rend'
    df = spark.createDataFrame([(1, text, None)], "id INT, text STRING, none STRING")
    (line,) = [row[0] for row in df.select(csv_record(df)).collect()]
    assert "\n" not in line and "\r" not in line
    (row,) = parsed(spark, line, ddl="id INT, text STRING, none STRING").collect()
    assert row.id == 1 and row.none is None
    assert row.text.split() == text.split()


few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TEXTS = st.text(st.sampled_from('ab",\\#\'; \t\n\ré|'), min_size=1, max_size=12)


@few
@given(st.lists(TEXTS, min_size=1, max_size=60))
def test_any_text_survives_a_message(spark, texts):
    data = [(number, text, number) for number, text in enumerate(texts)]
    df = spark.createDataFrame(data, "n INT, text STRING, after INT").coalesce(1)
    lines = df.select(csv_record(df).alias("csv_line"))
    found = parse_csv(lines, "n INT, text STRING, after INT").orderBy("n").collect()
    one_line = [re.sub(r"\r\n|\r|\n", " ", text) for text in texts]
    assert [(row.text, row.after) for row in found] == list(zip(one_line, range(len(texts))))


@few
@given(st.lists(TEXTS.filter(lambda text: "\r" not in text), min_size=1, max_size=60))
def test_any_text_survives_a_file(spark, tmp_path_factory, texts):
    path = str(tmp_path_factory.mktemp("texts") / "t.csv")
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, text STRING")
    write_csv(df, path)
    found = read_csv(spark, path, "n INT, text STRING").orderBy("n").collect()
    assert [row.text for row in found] == texts


def test_messages_have_unique_keys_and_bytes_parse(spark):
    df = spark.range(100).withColumn("t", F.lit("x"))
    messages = to_messages(df)
    assert messages.select("key").distinct().count() == 100
    binary = messages.select(F.col("value").cast("binary").alias("value"))
    assert rows(parse_csv(message_text(binary), "id BIGINT, t STRING")) == rows(df)


def test_schema_has_46_fields_in_order():
    assert len(schema.ACCIDENT_COLUMNS) == 46
    assert schema.ACCIDENT_COLUMNS[3] == "Start_Time"
    assert schema.ACCIDENT_COLUMNS[-1] == "Astronomical_Twilight"


def test_bad_times_become_null(spark):
    df = spark.createDataFrame(
        [("2016-02-08 05:46:00.000000000", "soon"), ("2016-02-08", None)],
        "Start_Time STRING, End_Time STRING",
    )
    first, second = plain_times(coerce_times(df)).collect()
    assert first.Start_Time == at("2016-02-08 05:46:00") and first.End_Time is None
    assert second.Start_Time == at("2016-02-08 00:00:00") and second.End_Time is None


def test_missing_texts(spark):
    data = [("N/A", 1), ("", 2), ("Clear", 3), (None, 4)]
    found = blank_missing(spark.createDataFrame(data, "`a(b)` STRING, n INT")).orderBy("n")
    assert [row[0] for row in found.collect()] == [None, None, "Clear", None]


@pytest.fixture
def raw_file(spark, tmp_path):
    """Two raw records: one with a quoted line break, one with a bad time and missing texts."""
    values = {name: "" for name in schema.ACCIDENT_COLUMNS}
    one = values | {
        "ID": "A-1", "Severity": "3", "Start_Time": "2016-02-08 05:46:00",
        "Description": '"He said ""stop"", then\nleft"', "Temperature_F": "36.9",
        "Junction": "True", "Weather_Condition": "Fog",
    }
    two = values | {
        "ID": "A-2", "Severity": "2", "Start_Time": "soon", "Weather_Condition": "N/A",
        "Junction": "False", "Humidity_percent": "91.0",
    }
    raw_names = {clean: raw for raw, clean in schema.UNIT_COLUMNS.items()}
    header = ",".join(raw_names.get(name, name) for name in schema.ACCIDENT_COLUMNS)
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([header, *[",".join(row.values()) for row in (one, two)]]) + "\n")
    return str(path)


def test_raw_to_cleaned_to_typed(spark, raw_file, tmp_path):
    raw = read_raw_accidents(spark, raw_file)
    assert raw.count() == 2 and "Temperature(F)" in raw.columns
    cleaned = clean_accidents(raw)
    assert cleaned.columns == schema.ACCIDENT_COLUMNS
    write_csv(cleaned, str(tmp_path / "cleaned"))
    typed = plain_times(read_accidents(spark, str(tmp_path / "cleaned")))
    first, second = typed.orderBy("ID").collect()
    assert first.Description == 'He said "stop", then\nleft'
    assert (first.Severity, first.Temperature_F, first.Junction) == (3, 36.9, True)
    assert first.Start_Time == at("2016-02-08 05:46:00")
    assert second.Start_Time is None and second.Weather_Condition is None
    assert (second.Humidity_percent, second.Junction) == (91.0, False)


def test_nulls_stay_unless_asked(spark, raw_file):
    raw = read_raw_accidents(spark, raw_file)
    assert clean_accidents(raw).count() == 2
    assert clean_accidents(raw, drop_nulls=True).count() == 0
    kept = clean_accidents(raw, drop_nulls=True, drop_subset=["Weather_Condition"])
    assert [row.ID for row in kept.collect()] == ["A-1"]


def test_header_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "wrong.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), "a INT, b INT").collect()


def test_raw_columns_are_found_by_name(spark, raw_file, tmp_path):
    raw = read_raw_accidents(spark, raw_file)
    other = tmp_path / "other.csv"
    write_csv(raw.select(F.lit(1).alias("More"), *[F.col(f"`{c}`") for c in raw.columns[::-1]]), str(other))
    assert rows(read_raw_accidents(spark, str(other))) == rows(raw)
    (tmp_path / "few.csv").write_text("ID,Severity\n1,2\n")
    with pytest.raises(ValueError, match="Start_Time"):
        read_raw_accidents(spark, str(tmp_path / "few.csv"))


def test_line_break_in_a_text_is_an_error_for_one_line_records(spark, raw_file):
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw_accidents(spark, raw_file, multi_line=False).select("ID").collect()


def test_large_csv_is_read_in_pieces(spark, tmp_path):
    path = str(tmp_path / "pieces")
    write_csv(spark.range(2_500_000).select("id", F.lit("text").alias("t")).coalesce(1), path)
    assert read_csv(spark, path, "id BIGINT, t STRING").rdd.getNumPartitions() > 1


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text('n,flag,time,text\n1,True,2016-02-08 05:46:00,"a ""b"", c"\n2,False,,\n')
    df = read_csv_inferred(spark, str(path))
    assert [kind for _, kind in df.dtypes] == ["int", "boolean", "timestamp", "string"]
    assert df.first().text == 'a "b", c'
