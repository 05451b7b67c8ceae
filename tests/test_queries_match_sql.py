"""Every named query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import compare
from listenlake.plans import oracles, registry

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"recommend_songs"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    names, rows = compare.spark_rows(df)
    sql_names, sql_rows, sql_types = compare.duck_rows(duck, ORACLES[name])
    assert names == sql_names
    kinds = dict(df.dtypes)
    assert [TYPES[kinds[n]] for n in names] == sql_types
    assert rows - sql_rows == sql_rows - rows


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["song_id", "song_name", "artist_name", "total_plays", "total_skips"]
    assert result.count() == 100
