"""End-to-end compositions: collect articles, process articles, merge
topics by vectors.  Each is one lazy plan except where a model is called
(replies are pinned) or an iterative job runs (k-means rounds, component
rounds)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.functions.text import html_to_text, with_columns_once
from newsgraph.operators.annotate import (ANNOTATE_CALL, annotate_prompt, call_model, clean_texts,
                                          drop_empty_topics, parse_annotations)
from newsgraph.operators.articles import (ARTICLE_COLUMNS, date_window, filter_newspapers,
                                          length_filter, normalize_feed)
from newsgraph.operators.density import density_clusters, density_components
from newsgraph.operators.persons import process_persons
from newsgraph.operators.topics import (apply_representatives, cluster_with_model,
                                        distinct_topics, representatives)
from newsgraph.operators.vectors import mean_word_vectors, seeded_kmeans, topic_vectors, train_word2vec
from newsgraph.session import materialize
from newsgraph.sources.feed import attach_pages, feed_items
from newsgraph.sources.live import search_replies

PROCESSED_COLUMNS = (*ARTICLE_COLUMNS, "text", "topics", "persons")


@dataclass
class NewsRun:
    """Parameters of a run.  Secrets are not kept here: the caller's client
    factories hold them.  Dates default per call (today and one month
    before)."""
    query: str
    sources: Sequence[str]
    topics: Sequence[str] | None = None
    start_date: str | _dt.date | None = None
    end_date: str | _dt.date | None = None
    limit: int | None = None    # entries kept of each landed reply; none are cut by default
    country: str = "it"         # sent to the search service
    max_chars: int = 15000
    model: str = ""             # model name: part of the store key
    pause: float = 0.0          # seconds between the starts of two calls of one task
    in_flight: int = 4          # calls of one task at a time
    pandas_compat: bool = False
    model_partitions: int | None = None
    reply_store: str | None = None
    dedup_links: bool = False   # keep one row per link before the model calls
    sort_keys: bool = False     # order the result by the article keys, as the reference returns it


def collect_articles(replies: DataFrame, run: NewsRun) -> DataFrame:
    """Search replies → items → newspaper and day → date window →
    newspaper filter (→ one row per link with ``dedup_links``) →
    ``title, newspaper, link, date, row_ord``."""
    items = feed_items(replies, run.limit) if "news_results" in replies.columns else replies
    arts = normalize_feed(items)
    arts = date_window(arts, run.start_date, run.end_date)
    arts = filter_newspapers(arts, list(run.sources))
    if run.dedup_links:
        # an article returned for two newspapers is annotated once: the
        # first occurrence (lowest row order) is kept
        whole = F.struct(*[F.col(c) for c in arts.columns])
        first = arts.where("link is not null").groupBy("link").agg(F.min_by(whole, F.struct("row_ord", "title")).alias("_a"))
        arts = first.select("_a.*").select(*arts.columns).unionByName(arts.where("link is null"))
    return arts


def scrape_articles(spark: SparkSession, run: NewsRun, search: Callable) -> DataFrame:
    """The run's queries (one per newspaper, ``"{source} {query}"``) sent to a
    search service, then ``collect_articles``.  ``search(keywords, limit,
    country)`` runs on the executors; the replies are written once, so that a
    recomputed stage does not search again."""
    replies = search_replies(spark, run.sources, run.query, search, run.limit, run.country)
    return collect_articles(materialize(replies, "search-replies"), run)


def annotate_articles(articles: DataFrame, run: NewsRun, client_factory: Callable,
                      pin: bool = True) -> tuple[DataFrame, DataFrame]:
    """Length filter → model call (distinct prompts, pinned replies) →
    parse → drop empty topics → project.  Returns (annotated, rejects): an
    article whose text is too long, whose page could not be read, whose call
    failed or whose reply does not parse is in rejects, with the reason in
    ``error``."""
    arts = length_filter(articles, "text", run.max_chars, run.pandas_compat)
    cut = F.when(F.col("text").isNull(), F.lit("no text")).otherwise(
        F.concat(F.lit("text of "), F.length("text").cast("string"), F.lit(" characters")))
    skipped = articles.filter(F.col("text").isNull() if not run.pandas_compat else F.lit(False)).unionByName(
        articles.filter(F.length("text") >= run.max_chars))
    call = replace(ANNOTATE_CALL, model=run.model, min_interval=run.pause, in_flight=run.in_flight)
    text = F.coalesce(F.col("text"), F.lit("None")) if run.pandas_compat else F.col("text")
    replied = call_model(arts, annotate_prompt(text, run.query, run.topics), client_factory,
                         call, partitions=run.model_partitions, store=run.reply_store, pin=pin)
    accepted, rejects = parse_annotations(replied)
    accepted = drop_empty_topics(accepted)
    keep = [c for c in ("row_ord", *PROCESSED_COLUMNS) if c in accepted.columns]
    own = [c for c in rejects.columns if c in skipped.columns]
    skipped = skipped.select(*own, F.lit(None).cast("string").alias("reply"), F.lit(None).cast("string").alias("json"),
                             cut.alias("error"))
    return accepted.select(*keep), rejects.unionByName(skipped)


def process_articles(articles: DataFrame, pages: DataFrame, run: NewsRun, client_factory: Callable,
                     cluster_client_factory: Callable | None = None, cluster: str = "model",
                     pin: bool = True, density_cut: float | None = None,
                     keep: bool = True, clean_client_factory: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """Fetch (join with landed pages) → HTML to text → annotate → merge
    topics (by model, or by vectors) → persons.  Returns (processed, rejects).
    With ``clean_client_factory`` the page text is first cleaned by a model.

    With ``keep`` the annotated table is written once to the shared folder:
    the topic merge and the persons steps read it several times."""
    # decoded once: the length filter and the prompt both read the text
    fetched = with_columns_once(attach_pages(articles, pages), text=html_to_text(F.col("html"))).drop("html")
    if clean_client_factory is not None:  # optional model cleaning of the page text (off by default)
        fetched = clean_texts(fetched, clean_client_factory, partitions=run.model_partitions,
                              store=run.reply_store, pin=pin).drop("prompt_key", "error")
    annotated, rejects = annotate_articles(fetched, run, client_factory, pin)
    if keep:
        annotated = materialize(annotated, "annotated")
    if cluster == "model":
        merged = cluster_with_model(annotated, cluster_client_factory or client_factory, run.topics,
                                    partitions=run.model_partitions, store=run.reply_store, pin=pin)
    elif cluster == "vectors":
        merged = cluster_topics(annotated, run.topics, density_cut=density_cut)
    elif cluster == "none":
        merged = annotated
    else:
        raise ValueError(f"cluster must be 'model', 'vectors' or 'none', not {cluster!r}")
    return process_persons(merged, pandas_compat=run.pandas_compat, sort_keys=run.sort_keys), rejects


def cluster_topics(df: DataFrame, topics: Sequence[str] | None = None, col: str = "topics",
                   order_col: str = "row_ord", seed: int = 42, density_cut: float | None = None,
                   max_iter: int = 300, noise_as_cluster: bool = False, words: DataFrame | None = None) -> DataFrame:
    """Merge topics by vectors.  One Word2Vec over the words of all topic
    rows and the given topics, or the word vectors ``words`` (word, vec) if they
    are given; each distinct topic (weighted by its rows) is
    a point.  With ``topics``: k-means started at the given topics' vectors
    (they are points too), each cluster named by its given topic.  Without:
    density clusters, chosen by stability over the whole hierarchy or taken at
    ``density_cut`` if that is given, each named by its commonest topic
    (noise keeps its own topic; ``noise_as_cluster`` names all noise rows by
    the commonest noise topic, as the reference does).  A topic without a
    vector (no known word) stays as it is.  Adds ``topic_cluster``."""
    spark = df.sparkSession
    given = spark.createDataFrame(list(enumerate(topics or [])), "idx int, topic string")
    if words is None:
        rows = df.select(F.col(col).alias("topics"))
        model = train_word2vec(rows.unionByName(given.select(F.col("topic").alias("topics"))) if topics else rows, "topics", seed=seed)

    def vectors(frame: DataFrame) -> DataFrame:
        if words is None:
            return topic_vectors(frame, model, "topic")
        return frame.join(mean_word_vectors(frame.select("topic").distinct(), words), "topic")

    vecs = materialize(vectors(distinct_topics(df, col, order_col)), "topic-vectors")
    if topics:
        seeds_df = vectors(given)
        found = {r["idx"]: r["vec"] for r in seeds_df.collect()}  # k given vectors
        if len(found) < len(topics):
            raise ValueError(f"no vector for {[t for i, t in enumerate(topics) if i not in found]}")
        seeds = [found[i] for i in range(len(topics))]
        pts = vecs.select("topic", "vec", "weight").unionByName(
            seeds_df.select("topic", "vec", F.lit(1).cast("bigint").alias("weight")).withColumn("topic", F.lit(None).cast("string")))
        labelled, _ = seeded_kmeans(pts, seeds, weight_col="weight", max_iter=max_iter)
        lab = labelled.filter(F.col("topic").isNotNull()).select("topic", F.col("cluster").alias("topic_cluster"))
        out = df.join(lab, df[col] == lab["topic"], "left").drop("topic")
        names = given.select(F.col("idx").alias("topic_cluster"), F.col("topic").alias("representative"))
        return (apply_representatives(out.where("topic_cluster is not null"), names, "topic_cluster", col)
                .unionByName(out.where("topic_cluster is null")))
    ids = vecs.withColumn("id", F.col("first_ord"))  # unique per topic
    pts = ids.select("id", "vec", "weight")
    cl = density_clusters(pts) if density_cut is None else density_components(pts, density_cut)
    lab = ids.join(cl, "id").select("topic", F.col("cluster").alias("topic_cluster"))
    out = df.join(lab, df[col] == lab["topic"], "left").drop("topic")
    if noise_as_cluster:  # the reference's behaviour: noise is one more cluster
        return apply_representatives(out, representatives(out, "topic_cluster", col, order_col),
                                     "topic_cluster", col)
    clustered = out.filter(F.col("topic_cluster") != -1)
    reps = representatives(clustered, "topic_cluster", col, order_col)
    named = apply_representatives(clustered, reps, "topic_cluster", col)
    return named.unionByName(out.filter(~(F.col("topic_cluster") != -1) | F.col("topic_cluster").isNull()))
