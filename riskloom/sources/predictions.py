"""Scored windows, read back from the folder that a stream writes."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom import schema
from riskloom.functions.columns import stored_vector_element


def with_day(scored: DataFrame, time: str = "window_start") -> DataFrame:
    """The day of each window, for a sink that keeps a folder for each day."""
    return scored.withColumn(schema.DAY_COLUMN, F.to_date(time))


def read_predictions(
    spark: SparkSession,
    path: str,
    ddl: str = schema.PREDICTION_DDL,
    by_day: bool = False,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """All committed predictions of the folder, with the probability of high severity.

    The schema is given, so an empty folder, or none yet, is an empty table. Empty files hold no
    rows, and a line that is no JSON record is dropped without its neighbours. ``first_day`` and
    ``last_day`` bound the days of the windows' starts; in a folder written ``by_day`` only the
    folders of those days are read.
    """
    held = f"{ddl}, {schema.DAY_COLUMN} DATE" if by_day else ddl
    try:
        stored = (
            spark.read.schema(held)
            .option("mode", "DROPMALFORMED")
            .option("pathGlobFilter", "*.json")
            .json(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], held)
    day = F.col(schema.DAY_COLUMN) if by_day else F.to_date("window_start")
    if first_day:
        stored = stored.where(day >= F.lit(first_day))
    if last_day:
        stored = stored.where(day <= F.lit(last_day))
    return stored.drop(schema.DAY_COLUMN).withColumn(
        "high_severity_prob", stored_vector_element(F.col("probability"), 1)
    )
