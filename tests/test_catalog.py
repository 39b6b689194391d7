"""Every catalogue query against its DuckDB SQL on the smallest tables,
and the driver's entry point."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL_SF_DIR
from newsgraph.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_sql_or_is_model_bound():
    assert set(catalog.QUERIES) - set(catalog.SQL) <= {"topic_word2vec", "kmeans_plain", "topic_merge", "token_exact"}
    assert set(catalog.SQL) <= set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SMALL_SF_DIR)
    cols = sorted(sdf.columns)
    got = _rows([r.asDict() for r in sdf.collect()], cols)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(dcols) == cols
    want = _rows([dict(zip(dcols, r)) for r in cur.fetchall()], cols)
    assert got == want


@pytest.mark.parametrize("name", ["topic_word2vec", "kmeans_plain", "topic_merge", "token_exact"])
def test_model_bound_queries_run(spark, name):
    assert E.queries()[name](spark, SMALL_SF_DIR).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["id", "type", "freq"]
    assert [r.freq for r in rows] == sorted((r.freq for r in rows), reverse=True)
