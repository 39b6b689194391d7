"""The README's public-API flow end to end on landed files."""

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import SMALL_SF_DIR
from newsgraph.plans import stand_ins as SI
from newsgraph.operators import annotate as A
from newsgraph.operators.graph import ArticleGraph
from newsgraph.plans import fixtures as fx
from newsgraph.plans.workflow import NewsRun, collect_articles, process_articles
from newsgraph.sources.feed import read_feed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def annotator():
    return SI.StubAnnotator(fx.STUB_TOPICS)


class Refusing:
    def complete(self, system, prompt, max_tokens):
        raise RuntimeError("the store should have answered")


def test_readme_flow_with_reply_store(spark, tmp_path):
    pages = fx.table(spark, SMALL_SF_DIR, "pages")
    items = fx.feed_items_from_pages(pages)
    replies = items.select(F.col("row_ord").cast("int").alias("source_idx"), F.lit("q").alias("keywords"),
                           F.array(F.struct(F.lit(0).alias("position"), "title", "link", "date", "source"))
                           .alias("news_results"))
    landed = str(tmp_path / "feed")
    replies.write.json(landed)

    run = NewsRun(query="elezioni", sources=["Blog", "www", "M"], topics=list(fx.STUB_TOPICS),
                  start_date="2024-01-01", end_date="2024-03-31", reply_store=str(tmp_path / "replies"))
    articles = collect_articles(read_feed(spark, landed), run)
    processed, rejects = process_articles(articles, pages.select("url", "html"), run, annotator,
                                          cluster_client_factory=SI.StubClusterer)
    first = sorted((r.link, r.topics, tuple(r.persons)) for r in processed.collect())
    assert first and rejects.count() == 0
    assert os.path.isdir(str(tmp_path / "replies"))

    # a second run sends nothing new: every annotation prompt is in the store
    again, _ = process_articles(collect_articles(read_feed(spark, landed), run), pages.select("url", "html"), run,
                                Refusing, cluster_client_factory=SI.StubClusterer)
    assert sorted((r.link, r.topics, tuple(r.persons)) for r in again.collect()) == first

    g = ArticleGraph.build(processed.withColumn("row_ord", F.struct("title", "link")),
                           [("newspaper", "topics", "covers"), ("newspaper", "persons", "cites"),
                            ("persons", "topics", "about")])
    assert g.nodes.count() > 0 and g.edges_simple.count() <= g.edges_multi.count()
    assert g.display("triangle_layout").filter(F.col("dx").isNull()).count() == 0


def test_topics_cluster_without_a_cut(spark):
    """Topics around three separate words come out as three clusters, each
    named by its commonest topic."""
    from newsgraph.plans.workflow import cluster_topics

    names = [f"{w} {x}" for w in ("calcio", "borsa", "teatro") for x in ("uno", "due", "tre", "quattro")]
    rows = [(i, n) for i, n in enumerate(n for n in names for _ in range(3))]
    df = spark.createDataFrame([*rows, (900, "calcio uno"), (901, None)], "row_ord long, topics string")
    out = cluster_topics(df).collect()
    assert len(out) == len(rows) + 2 and {r.row_ord for r in out} == {r for r, _ in rows} | {900, 901}
    named = {}
    for r in out:
        if r.topic_cluster is not None and r.topic_cluster != -1:
            named.setdefault(r.topic_cluster, set()).add(r.topics)
    assert named and all(len(v) == 1 for v in named.values())
    assert [r.topics for r in out if r.row_ord == 901] == [None]


def test_flagship_orders_rows_without_carrying_their_text(spark):
    """The last written type wins in the order of the keys, and what is sorted
    by and grouped is a number, not the article."""
    from newsgraph.operators.persons import REGROUP_KEYS
    from newsgraph.plans.flagship import FLAGSHIP_RELS, in_key_order

    names = ["a", "b", "c"]
    rows = [(i, f"t{i % 4}", names[i % 3], f"l{i % 5}", f"2024-01-{1 + i % 2:02d}", "long text %d " % (i * 7 % 11) * 50,
             names[(i + i // 3) % 3], [names[i % 2], "d"]) for i in range(40)]
    df = spark.createDataFrame(rows, ["row_ord", *REGROUP_KEYS, "persons"]).repartition(5)
    by_keys = df.withColumn("row_ord", F.struct(*REGROUP_KEYS))
    ordered = in_key_order(df)
    assert ordered.schema["row_ord"].dataType.simpleString() == "bigint"
    rank = lambda d: [r.text for r in d.orderBy("row_ord").collect()]
    assert rank(ordered) == rank(by_keys)
    nodes = lambda d: sorted(map(tuple, ArticleGraph.build(d, FLAGSHIP_RELS).nodes.collect()))
    assert nodes(ordered) == nodes(by_keys)
