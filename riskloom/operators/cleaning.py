"""Cleaning of the raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom import schema


def blank_missing(df: DataFrame, texts: Sequence[str] = schema.MISSING_TEXTS) -> DataFrame:
    """Null instead of the texts that stand for a missing value, in every text column."""
    return df.select(
        *[
            F.when(~F.col(f"`{field.name}`").isin(*texts), F.col(f"`{field.name}`")).alias(
                field.name
            )
            if isinstance(field.dataType, T.StringType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def coerce_times(df: DataFrame, columns: Sequence[str] = schema.COERCED_TIMES) -> DataFrame:
    """Text to timestamp; what is no time becomes null instead of an error."""
    return df.withColumns({name: F.try_to_timestamp(F.col(name)) for name in columns})


def rename_units(df: DataFrame, names: Mapping[str, str] = schema.UNIT_COLUMNS) -> DataFrame:
    """Plain names instead of unit-suffixed ones; names that are absent are passed over."""
    return df.withColumnsRenamed(dict(names))


def clean_accidents(
    raw: DataFrame, drop_nulls: bool = False, drop_subset: Sequence[str] | None = None
) -> DataFrame:
    """The cleaned table. Rows with nulls stay unless ``drop_nulls`` asks to drop them."""
    cleaned = rename_units(coerce_times(blank_missing(raw)))
    return cleaned.na.drop("any", subset=drop_subset) if drop_nulls else cleaned
