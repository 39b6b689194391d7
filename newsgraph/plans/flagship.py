"""Flagship: the whole news workflow on the driver's tables.

pages → feed items → newspaper and day → date window → newspaper filter →
page text (join with the landed pages, HTML to text) → length filter →
model annotation (deterministic client) → parse → drop empty topics →
topic merge by model (deterministic client) → persons → graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.operators import annotate as A
from newsgraph.operators.graph import ArticleGraph
from newsgraph.operators.persons import REGROUP_KEYS
from newsgraph.plans import fixtures as fx
from newsgraph.plans import stand_ins as SI
from newsgraph.plans import workflow as W

# Fixed run parameters: the window covers every feed day, the accepted
# names cover the common host prefixes.
FLAGSHIP_RUN = dict(query=fx.QUERY, sources=["Blog", "www", "M"], topics=list(fx.STUB_TOPICS),
                    start_date="2024-01-01", end_date="2024-03-31")
FLAGSHIP_RELS = [("newspaper", "topics", "covers"), ("newspaper", "persons", "cites"),
                 ("persons", "topics", "about")]


def _annotator():
    return SI.StubAnnotator(fx.STUB_TOPICS)


def processed_articles(spark: SparkSession, sf_dir: str, pin: bool = True) -> tuple[DataFrame, DataFrame]:
    run = W.NewsRun(**FLAGSHIP_RUN)
    pages = fx.table(spark, sf_dir, "pages")
    arts = W.collect_articles(fx.feed_items_from_pages(pages), run)
    return W.process_articles(arts, pages.select("url", "html"), run, _annotator,
                              cluster_client_factory=SI.StubClusterer, cluster="model", pin=pin)


def in_key_order(processed: DataFrame) -> DataFrame:
    """``processed`` with ``row_ord`` numbering the rows in the order of their
    group keys, in which regrouped rows come.  A range-partitioned sort: the
    keys, the article text among them, do not follow every endpoint row."""
    return processed.orderBy(*REGROUP_KEYS).withColumn("row_ord", F.monotonically_increasing_id())


def flagship_graph(spark: SparkSession, sf_dir: str, pin: bool = True) -> ArticleGraph:
    processed, _ = processed_articles(spark, sf_dir, pin)
    return ArticleGraph.build(in_key_order(processed), FLAGSHIP_RELS)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship_graph(spark, sf_dir).nodes.orderBy(F.desc("freq"), F.asc("id"))
