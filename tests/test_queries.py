"""Every query with SQL against DuckDB, and the others for their shape."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bindings.oracles import ORACLES
from bindings.spark_queries import QUERIES

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def in_order(rows, columns):
    places = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted((tuple(row[place] for place in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, tables, name):
    result = queries()[name](spark, tables)
    cursor = duck.execute(oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert {column: SPARK_TYPES[kind] for column, kind in result.dtypes} == types
    expected = in_order(cursor.fetchall(), list(types))
    assert in_order(result.collect(), result.columns) == expected
    assert expected


def test_names_match():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:3] == ["window_start", "window_end", "n"]
    assert result.count() > 0
