"""The queries that SQL expresses, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from orrery.llm import queries
from tests.test_queries import SF, table

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query(spark, name):
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    df, got = queries.QUERIES[name](spark, SF), c.execute(queries.ORACLES[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in got.description], got.fetchall())
