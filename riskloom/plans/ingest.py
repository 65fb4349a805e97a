"""Raw file to cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom import schema
from riskloom.operators.cleaning import clean_accidents
from riskloom.operators.parsing import parsed_fields
from riskloom.sources.tables import read_raw_accidents, write_table

#: Windows and replays over a stretch of time read the part of the cleaned table that holds it.
CLUSTER_COLUMNS = [schema.EVENT_TIME, "ID"]


def clean_file(
    spark: SparkSession,
    source: str,
    target: str,
    drop_nulls: bool = False,
    multi_line: bool = True,
    whole_files: bool = False,
    mode: str = "overwrite",
) -> None:
    """Read the raw accident file and write the cleaned table, as CSV or Parquet."""
    raw = read_raw_accidents(spark, source, multi_line, whole_files)
    cleaned = clean_accidents(raw, drop_nulls)
    if target.rstrip("/").endswith(".parquet"):
        write_table(typed(cleaned), target, mode, cluster_by=CLUSTER_COLUMNS)
    else:
        write_table(cleaned, target, mode)


def typed(cleaned: DataFrame) -> DataFrame:
    """The cleaned text columns under their types, as reading the cleaned CSV gives them."""
    return parsed_fields(cleaned, schema.ACCIDENT_FIELDS)
