"""The whole way from a raw file to the reports, by the commands a user runs."""

import pytest

from bindings.spark_queries import _raw_accidents
from pyspark.sql import functions as F

from riskloom import schema
from riskloom.__main__ import arguments, run
from riskloom.sources.predictions import read_predictions
from riskloom.sources.tables import read_csv_inferred, write_csv

from helpers import plain_times, rows


def command(spark, *words):
    run(spark, arguments().parse_args([str(word) for word in words]))


@pytest.mark.parametrize("cleaned", ["cleaned.csv", "cleaned.parquet"])
def test_clean_replay_train_score_report(spark, tables, tmp_path, capsys, cleaned):
    raw, cleaned = tmp_path / "raw.csv", tmp_path / cleaned
    write_csv(_raw_accidents(spark, tables), str(raw))
    command(spark, "clean", "--source", raw, "--target", cleaned)
    command(spark, "train", "--source", cleaned, "--model", tmp_path / "model")
    assert "area under ROC" in capsys.readouterr().out
    sent, scored = tmp_path / "messages", tmp_path / "predictions"
    command(spark, "replay", "--source", cleaned, "--files", sent)
    command(
        spark, "score", "tumbling", "1 hour", "1 hour", "--files", sent,
        "--model", tmp_path / "model", "--target", scored,
        "--checkpoint", tmp_path / "checkpoint", "--available-now",
    )
    predictions = read_predictions(spark, str(scored))
    assert predictions.count() > 0
    assert predictions.where("prediction IS NULL OR high_severity_prob IS NULL").count() == 0
    command(spark, "report", "--source", scored, "--target", tmp_path / "reports")
    histogram = read_csv_inferred(spark, str(tmp_path / "reports" / "probability_histogram"))
    assert histogram.count() == 20
    counted = sum(row["count"] for row in histogram.collect())
    assert counted == predictions.count()


def test_cleaned_csv_and_parquet_hold_the_same(spark, tables, tmp_path):
    from riskloom.sources.tables import read_accidents

    raw = tmp_path / "raw.csv"
    untidy = F.array(*map(F.lit, ["yes", "1", " true", "t", "True", "FALSE", " 3", "3.0", "4 ", "x", "3"]))
    pick = F.get(untidy, (F.substring("ID", 3, 9).cast("int") % 11))
    given = _raw_accidents(spark, tables).withColumns({"Junction": pick, "Severity": pick, "Humidity(%)": pick, "Weather_Timestamp": F.concat(F.lit(" "), "Start_Time")})
    write_csv(given, str(raw))
    found = []
    for name in ("c.csv", "c.parquet"):
        command(spark, "clean", "--source", raw, "--target", tmp_path / name)
        table = read_accidents(spark, str(tmp_path / name))
        assert table.columns == schema.ACCIDENT_COLUMNS
        found.append(rows(plain_times(table)))
    assert found[0] == found[1]


def test_wrong_kind_of_window(spark):
    with pytest.raises(ValueError):
        command(spark, "score", "session", "1 hour")
