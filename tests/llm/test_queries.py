"""The registered queries that SQL can express, against it."""

import duckdb
import pytest

from newsgraph.llm import queries
from tests.conftest import SMALL_SF_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF_DIR}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL_SF_DIR)
    cur = duck.execute(queries.SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, cur.fetchall()))
