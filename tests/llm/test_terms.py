import numpy as np
import pyarrow as pa
import pytest

from newsgraph.llm import divergence, lexical, terms
from tests.llm import brute
from tests.llm.test_divergence import expected as audit
from tests.llm.test_lexical import expected as ranking


@pytest.mark.parametrize("first", ["one", None])
def test_every_piece_of_a_batch_is_split_as_it_stands(first):
    texts = [first] + [f"Wörd{i} x{i}." for i in range(1, 3 * terms.SLICE_ROWS)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    got = []
    for part in terms.slices(batch, "text"):
        rows, flat = terms.split_terms(part.column("text"), terms.NOT_WORD)
        got += [flat.filter(pa.array(rows == i)).to_pylist() for i in range(part.num_rows)]
    assert got == [["one"] if first else []] + [[f"wörd{i}", f"x{i}"] for i in range(1, len(texts))]


@pytest.fixture
def large_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    yield
    spark.conf.set(name, before)


def rows_of(n):
    rng = np.random.default_rng(2)
    names = ["alpha", "béta", "gamma", "delta", "eps", "zeta", "eta"]
    return [(i, " ".join(rng.choice(names, rng.integers(1, 9))) + f" t{i % 97}", "en", f"s{i % 3}", 1) for i in range(n)]


def test_queries_count_all_rows_of_a_large_batch(spark, large_batches):
    rows = rows_of(terms.SLICE_ROWS + 700)
    docs = spark.createDataFrame(rows, brute.SCHEMA).coalesce(1)
    items = [(1, "alpha t5 t96"), (2, "béta eta eta t3")]
    got = lexical.op11(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == ranking(rows, items)
    assert sorted(map(tuple, divergence.op13(docs).collect())) == sorted(audit(rows))
