"""News feed source (search-service replies) and page source.

The search service and the web are outside Spark; their replies are landed
as files and read as DataFrames.  A live path exists for both: a Python
data source that calls a search function once per keyword string (one
partition per keyword), and a ``mapInPandas`` page fetcher.  Neither ever
runs on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED_ITEM = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
])

# One search reply: the keyword string sent and the list of results.
FEED_REPLY = T.StructType([
    T.StructField("source_idx", T.IntegerType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("news_results", T.ArrayType(FEED_ITEM)),
])

PAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("html", T.StringType()),
])

DEFAULT_LIMIT = 10000
DEFAULT_COUNTRY = "it"


def row_order(source_idx: Column, position: Column) -> Column:
    """Order of an item in the concatenation of all replies: reply (source)
    index in the high 32 bits, position in the reply in the low ones.  A
    reply as the service sends it has no source index (null): its items are
    ordered by position.  Not unique over several landings; what gathers
    rows uses a row number of its own (:func:`newsgraph.operators.persons.numbered`)."""
    idx = F.coalesce(source_idx.cast("bigint"), F.lit(0).cast("bigint"))
    return F.shiftleft(idx, 32) + position.cast("bigint")


def search_queries(sources: DataFrame, query: str, source_col: str = "source") -> DataFrame:
    """One keyword string per newspaper: ``"{source} {query}"``.

    ``sources`` has ``source_idx`` (list order) and ``source_col``."""
    return sources.select(
        F.col("source_idx").cast("int").alias("source_idx"),
        F.col(source_col).alias("source"),
        F.concat_ws(" ", F.col(source_col), F.lit(query)).alias("keywords"))


def sources_frame(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A list of newspaper names as a small DataFrame with list order."""
    return spark.createDataFrame(list(enumerate(names)), "source_idx int, source string")


def read_feed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed search replies, read with a fixed schema (no inference)."""
    return spark.read.schema(FEED_REPLY).format(fmt).load(path)


def feed_items(replies: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per reply entry, with its position and global row order.

    A reply without results contributes nothing.  Landed replies are read
    whole; ``limit`` keeps the first ``limit`` entries of each reply (the
    live source passes its limit to the service instead)."""
    items = replies.select(
        "source_idx", "keywords",
        F.posexplode(F.col("news_results")).alias("pos", "item"))
    position = F.coalesce(F.col("item.position"), F.col("pos"))
    if limit is not None:
        items = items.filter(F.col("pos") < F.lit(limit))
    return (items
            .select(
                "source_idx", "keywords",
                position.cast("int").alias("position"),
                F.col("item.title").alias("title"),
                F.col("item.link").alias("link"),
                F.col("item.date").alias("date"),
                F.col("item.source").alias("source"),
                row_order(F.col("source_idx"), F.col("pos")).alias("row_ord")))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def attach_pages(articles: DataFrame, pages: DataFrame, link_col: str = "link",
                 html_col: str = "html", dedupe: bool = True) -> DataFrame:
    """Page fetch as a join: each article gets the landed HTML of its link;
    a link with no page, or a page whose status is not 200, gives null.

    Pages that no article links to leave first, by a semi join on the
    distinct links, so only wanted HTML is deduped.  ``dedupe`` keeps one
    page per URL, the smallest HTML in byte order; pass ``False`` for landed
    pages already keyed by URL.  A null link fetches nothing and does not
    enter the join."""
    p = pages
    if "status" in p.columns:
        p = p.filter(F.col("status") == 200)
    p = p.select(F.col("url").alias("_url"), F.col(html_col).alias("_html"))
    if dedupe:
        links = articles.where(F.col(link_col).isNotNull()).select(F.col(link_col).alias("_link")).distinct()
        p = p.join(links, p["_url"] == links["_link"], "left_semi").groupBy("_url").agg(F.min("_html").alias("_html"))
    out = articles.join(p, articles[link_col] == p["_url"], "left").drop("_url")
    return out.withColumnRenamed("_html", html_col)


# --------------------------------------------------------------------------
# Live paths (network on the executors; tested with local stand-ins)
# --------------------------------------------------------------------------

def fetch_pages(links: DataFrame, fetcher_factory: Callable[[], Callable[[str], tuple[int, str | None]]],
                link_col: str = "link", partitions: int | None = None) -> DataFrame:
    """Fetch each distinct link once with a pluggable fetcher (made once per
    partition on the executor).  Returns ``url, status, html``; a failed
    request gives status -1 and null html.  Write the result to a table
    before using it twice: a recomputed stage would fetch again."""
    import pandas as pd

    urls = links.select(F.col(link_col).alias("url")).where(F.col("url").isNotNull()).distinct()
    if partitions:
        urls = urls.repartition(partitions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = fetcher_factory()
        for b in batches:
            status, html = [], []
            for u in b["url"]:
                try:
                    s, h = fetch(u)
                except Exception:
                    s, h = -1, None
                status.append(s)
                html.append(h if s == 200 else None)
            yield pd.DataFrame({"url": b["url"], "status": status, "html": html})

    return urls.mapInPandas(run, PAGE)


def register_search_source(spark: SparkSession, search: Callable | None = None) -> None:
    """Register the ``newsfeed`` Python data source.

    ``search(keywords, limit, country)`` returns a list of result dicts
    (``title, link, date, source: {name}``).  Pass it here (it is shipped
    with the source), or name it with the option ``search`` =
    ``"module:function"`` importable on the executors.  Options:
    ``keywords`` = the keyword strings joined by newlines (list order is the
    source index), ``limit``, ``country``.  One partition per keyword
    string, so searches run in parallel on the executors."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    given = search

    class _Part(InputPartition):
        def __init__(self, idx: int, keywords: str):
            super().__init__(idx)
            self.idx, self.keywords = idx, keywords

    class _Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def partitions(self):
            kws = [k for k in self.options.get("keywords", "").split("\n") if k]
            return [_Part(i, k) for i, k in enumerate(kws)]

        def read(self, partition):
            fn = given
            if fn is None:
                import importlib

                mod, name = self.options["search"].split(":")
                fn = getattr(importlib.import_module(mod), name)
            limit = int(self.options.get("limit", DEFAULT_LIMIT))
            country = self.options.get("country", DEFAULT_COUNTRY)
            results = fn(partition.keywords, limit, country) or []
            items = [(i, r.get("title"), r.get("link"), r.get("date"),
                      ((r.get("source") or {}).get("name"),)) for i, r in enumerate(results)]
            yield (partition.idx, partition.keywords, items)

    class NewsFeedSource(DataSource):
        @classmethod
        def name(cls):
            return "newsfeed"

        def schema(self):
            return FEED_REPLY

        def reader(self, schema):
            return _Reader(self.options)

    spark.dataSource.register(NewsFeedSource)
