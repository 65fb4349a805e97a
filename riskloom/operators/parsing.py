"""Delimited messages: text to typed columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import schema

# Quotes inside a quoted field are doubled, which is what spreadsheets and pandas write. Spark's
# own default is a backslash, and with it a doubled quote shifts all later fields. Its writer would
# also strip the blanks around texts.
QUOTING = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
WHITE_SPACE = " \t\n\x0b\f\r"
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def message_text(messages: DataFrame, value: str = "value") -> DataFrame:
    """The message payload, which arrives as bytes or text, as one text column ``csv_line``."""
    return messages.select(F.col(value).cast("string").alias("csv_line"))


def parse_csv(
    lines: DataFrame,
    ddl: str = schema.ACCIDENT_DDL,
    column: str = "csv_line",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Parse one CSV record per row by position into the fields of ``ddl``.

    Missing trailing fields and unparseable ones become null and extra fields are ignored. With
    ``corrupt_column`` the text of a record that did not parse cleanly is kept under that name.
    Times are parsed without a fixed format, so any number of fraction digits will do.
    """
    options = dict(QUOTING)
    if corrupt_column:
        ddl = f"{ddl}, {corrupt_column} STRING"
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    return lines.select(F.from_csv(column, ddl, options).alias("data")).select("data.*")


def csv_record(df: DataFrame) -> Column:
    """All columns of ``df`` as one CSV record in one line.

    Line breaks inside a text become spaces: a message holds exactly one record and readers
    split files at line ends.
    """
    record = F.to_csv(F.struct(*df.columns), {**QUOTING, **TIME_FORMATS})
    for line_break in ("\r\n", "\r", "\n"):
        record = F.replace(record, F.lit(line_break), F.lit(" "))
    return record


def message_value(df: DataFrame) -> Column:
    """All columns as a message's text: the CSV record without the white space around it. Blanks
    at the ends of a message are no data, whichever way it is sent."""
    return F.btrim(csv_record(df), F.lit(WHITE_SPACE))


def to_messages(df: DataFrame) -> DataFrame:
    """Every row as a message: a random key, so that a topic's partitions fill evenly, and the
    row as a CSV record. Works on tables and streams."""
    return df.select(F.expr("uuid()").alias("key"), message_value(df).alias("value"))


def parsed_fields(texts: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """The fields by name, text columns under their types by the parser that reads CSV files, all of a
    row at once; what does not parse becomes null."""
    held = {name.lower(): kind for name, kind in texts.dtypes}
    parsed = {name: kind for name, kind in fields if kind.lower() != held[name.lower()]}
    if not parsed:
        return texts.select(*[name for name, _ in fields])
    ddl = ", ".join(f"{name} {kind}" for name, kind in parsed.items())
    record = F.from_csv(F.to_csv(F.struct(*parsed), QUOTING), ddl, QUOTING)
    typed = texts.select(*[name for name, _ in fields if name not in parsed], record.alias("_parsed"))
    return typed.select(*[F.col(f"_parsed.{name}" if name in parsed else name).alias(name) for name, _ in fields])
