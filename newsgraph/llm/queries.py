"""Registered queries of the training-data operators: each applies its
operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsgraph.llm import (decontaminate, divergence, language, lexical, minhash, mixing, paragraphs, suffix, tokens,
                           toxicity, urlfilter, vectors, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return register


@query("op8_toxicity")
def _(spark, d):
    return toxicity.op8(_table(spark, d, "documents"), _table(spark, d, "labels"))


@query("op3_minhash")
def _(spark, d):
    return minhash.op3(_table(spark, d, "documents"))


@query("op1_mixing")
def _(spark, d):
    return mixing.op1(_table(spark, d, "documents"))


@query("op5_decontaminate")
def _(spark, d):
    return decontaminate.op5(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


@query("op2_vectors")
def _(spark, d):
    return vectors.op2(_table(spark, d, "embeddings"))


@query("op4_language")
def _(spark, d):
    return language.op4(_table(spark, d, "pages"), _table(spark, d, "documents"))


@query("op6_url_rules", urlfilter.ORACLE)
def _(spark, d):
    return urlfilter.op6(_table(spark, d, "pages"))


@query("op7_warc")
def _(spark, d):
    return warc.op7(_table(spark, d, "pages"))


@query("op9_paragraphs")
def _(spark, d):
    return paragraphs.op9_passages(_table(spark, d, "documents"))


@query("op10_suffix")
def _(spark, d):
    return suffix.op10(_table(spark, d, "documents"))


@query("op12_tokens")
def _(spark, d):
    return tokens.op12(_table(spark, d, "documents"))


@query("op13_divergence", divergence.ORACLE)
def _(spark, d):
    return divergence.op13(_table(spark, d, "documents"))


@query("op11_lexical", lexical.ORACLE)
def _(spark, d):
    return lexical.op11(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
