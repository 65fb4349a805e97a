"""The three report tables over a folder of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.reports import (
    category_risk,
    hour_weekday_heatmap,
    probability_histogram,
)
from riskloom.sources.predictions import read_predictions
from riskloom.sources.tables import write_table

REPORT_COLUMNS = [
    "window_start",
    "Weather_Condition",
    "accident_count",
    "prediction",
    "high_severity_prob",
]


def report_tables(predictions: DataFrame) -> dict[str, DataFrame]:
    return {
        "probability_histogram": probability_histogram(predictions),
        "weather_risk": category_risk(predictions),
        "hour_weekday_heatmap": hour_weekday_heatmap(predictions).orderBy("hour"),
    }


def write_reports(spark: SparkSession, source: str, target: str, **days) -> None:
    """Read the predictions of a folder and write each report beside the others. ``days`` are those of
    ``read_predictions``."""
    # The reports read five of the columns four times; the JSON text is parsed once.
    predictions = read_predictions(spark, source, **days).select(*REPORT_COLUMNS).persist()
    try:
        for name, table in report_tables(predictions).items():
            # A report has as many rows as it has bins, places or hours.
            write_table(table.coalesce(1), f"{target.rstrip('/')}/{name}", mode="overwrite")
    finally:
        predictions.unpersist()
