from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    """All rows as tuples, columns by name, in a fixed order."""
    ordered = df.select(sorted(df.columns))
    return sorted((tuple(row) for row in ordered.collect()), key=repr)


def plain_times(df):
    return df.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    )


def final_plan(df) -> str:
    """The physical plan of a table as text."""
    return df._jdf.queryExecution().executedPlan().toString()
