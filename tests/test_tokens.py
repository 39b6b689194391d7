"""Exact token counts against a plain byte-pair encoder."""

import pytest

from conftest import SMALL_SF_DIR
from newsgraph.operators import tokens as TK
from newsgraph.plans import catalog


def plain(text, ranks, pattern):
    import regex

    n = 0
    for piece in regex.findall(pattern, text):
        parts = [bytes([b]) for b in piece.encode()]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            parts = parts[:i] + [parts[i] + parts[i + 1]] + parts[i + 2:]
        n += len(parts)
    return n


def test_all_documents_equal_a_plain_encoder(spark):
    docs = spark.read.parquet(f"{SMALL_SF_DIR}/documents.parquet")
    ranks = {bytes(r.token): r["rank"] for r in catalog.bpe_ranks(spark).collect()}
    got = {r.doc_id: r.tokens for r in catalog.q_token_exact(spark, SMALL_SF_DIR).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == {r.doc_id: plain(r.text, ranks, catalog.BPE_PATTERN) for r in rows}


def test_equals_the_public_encoder(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {bytes(r.token): r["rank"] for r in catalog.bpe_ranks(spark).collect()}
    enc = tiktoken.Encoding("own", pat_str=catalog.BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, "the thin thing and the action in  it\n\nis 123 --- ß \u4e2d"), (2, ""), (3, None), (4, "thethethe " * 50), (5, "nation station")]
    df = spark.createDataFrame(rows, "k long, text string")
    got = dict(TK.bpe_token_counts(df, catalog.bpe_ranks(spark), "k", pattern=catalog.BPE_PATTERN).collect())
    assert got == {k: None if t is None else len(enc.encode_ordinary(t)) for k, t in rows}


def test_bytes_without_a_rank_and_too_many_ranks(spark, monkeypatch):
    assert TK.merge_count(b"abc", {}) == 3 and TK.merge_count(b"abc", {b"ab": 5}) == 2 and TK.merge_count(b"", {}) == 0
    monkeypatch.setattr(TK, "MAX_RANKS", 10)
    with pytest.raises(ValueError):
        TK.bpe_token_counts(spark.createDataFrame([(1, "a")], "k long, text string"), catalog.bpe_ranks(spark), "k")


def test_no_task_holds_a_pre_token_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(TK, "HELD", 2)  # forgets, and counts the same
    rows = [(i, "the " * (i % 7) + f"own{i} thing") for i in range(300)] + [(5, "again the"), (None, "no key"), (900, "")]
    df = spark.createDataFrame(rows, "k long, text string")
    ranks = {bytes(r.token): r["rank"] for r in catalog.bpe_ranks(spark).collect()}
    out = TK.bpe_token_counts(df, catalog.bpe_ranks(spark), "k", pattern=catalog.BPE_PATTERN)
    assert "hashpartitioning(piece" not in out._jdf.queryExecution().executedPlan().toString()
    got = [(r.k, r.tokens) for r in out.collect() if r.k is not None and r.k != 5]
    assert sorted(got) == sorted((k, plain(t, ranks, catalog.BPE_PATTERN)) for k, t in rows if k is not None and k != 5)
