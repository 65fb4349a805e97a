"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom import schema
from riskloom.operators.parsing import QUOTING, TIME_FORMATS, parsed_fields
from riskloom.session import fresh_folder, remove_folder, settings
from riskloom.sources import quoted

# Rows in a file of a CSV table.
ROWS_PER_FILE = 1_000_000


def read_csv(
    spark: SparkSession, path: str, ddl: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """A CSV table with a header under a given schema.

    The header is held against the schema, since everything after this reads by position.
    ``multi_line`` allows line breaks inside quoted texts, for which the records are put together
    first; files known to hold one record per line need no such step. ``whole_files`` reads each
    file by one task instead, which files with stray quotes need.
    """
    if multi_line and not whole_files:
        names = spark.createDataFrame([], ddl).columns
        return quoted.parsed_records(quoted.data_records(spark, path, names), ddl)
    return spark.read.csv(
        path,
        schema=ddl,
        header=True,
        enforceSchema=False,
        multiLine=multi_line,
        **QUOTING,
    )


def read_csv_inferred(
    spark: SparkSession, path: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """A CSV table with a header and the types Spark infers, which takes a second pass."""
    if multi_line and not whole_files:
        names = quoted.header_names(spark, path)
        records = quoted.data_records(spark, path, names)
        return quoted.parsed_records(records, quoted.inferred_ddl(records, names))
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=multi_line, **QUOTING)


def read_text_fields(
    spark: SparkSession, path: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """A CSV table with all fields as text under the header's own names.

    Without ``multi_line`` a record with another number of fields than the header is an error: it
    is a piece of one with a line break, whose fields would be out of place.
    """
    if multi_line and not whole_files:
        names = quoted.header_names(spark, path)
        ddl = ", ".join(f"`{name}` STRING" for name in names)
        return quoted.parsed_records(quoted.data_records(spark, path, names), ddl)
    strict = {} if multi_line else {"mode": "FAILFAST", "columnPruning": "false"}
    return spark.read.options(**strict).csv(path, header=True, multiLine=multi_line, **QUOTING)


def read_raw_accidents(
    spark: SparkSession, path: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """The raw accident fields as text under their unit-suffixed names, found by name; other
    columns, and the order of the columns, do not matter."""
    raw = read_text_fields(spark, path, multi_line, whole_files)
    suffixed = {clean: name for name, clean in schema.UNIT_COLUMNS.items()}
    wanted = {name: [suffixed.get(name, name), name] for name in schema.ACCIDENT_COLUMNS}
    found = {name: next((x for x in names if x in raw.columns), None) for name, names in wanted.items()}
    absent = [wanted[name][0] for name, held in found.items() if held is None]
    if absent:
        raise ValueError(f"columns that {path} lacks: {', '.join(absent)}")
    return raw.select(*[F.col(f"`{held}`").alias(wanted[name][0]) for name, held in found.items()])


def read_accidents(
    spark: SparkSession, path: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """The cleaned accident table, from Parquet if the path says so, else from CSV."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema.ACCIDENT_DDL).parquet(path)
    if multi_line:
        return read_csv(spark, path, schema.ACCIDENT_DDL, whole_files=whole_files)
    # As text first, so that a field that does not parse is told from a field out of place.
    fields = read_text_fields(spark, path, multi_line=False)
    return parsed_fields(fields, schema.ACCIDENT_FIELDS)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """A CSV table with a header in every part file, doubled quotes and bounded files."""
    writer = df.write.mode(mode).options(**QUOTING, **TIME_FORMATS, maxRecordsPerFile=ROWS_PER_FILE)
    writer.csv(path, header=True)


def write_table(
    df: DataFrame, path: str, mode: str = "error", cluster_by: Sequence[str] = ()
) -> None:
    """Parquet for a path that ends in .parquet, else CSV.

    ``cluster_by`` deals the rows by ranges of these columns and sorts each file, so that readers of a
    stretch of the first one pass over the other files and row groups of a Parquet table. Name a key
    after it: the key splits a value that very many rows share. The rows are written once before, as
    the pass that finds the ranges would else make them a second time.
    """
    # Spark's own form of a time, 96 bits wide, has no least and largest value in the file.
    with settings(df.sparkSession, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
        if cluster_by:
            made = fresh_folder(df.sparkSession, "unclustered")
            df.write.parquet(made)
            df = df.sparkSession.read.parquet(made).repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        if path.rstrip("/").endswith(".parquet"):
            df.write.mode(mode).parquet(path)
        else:
            write_csv(df, path, mode)
    if cluster_by:
        remove_folder(df.sparkSession, made)
