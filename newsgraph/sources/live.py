"""Live collection: the run's queries sent to a search service.

``search_replies`` asks once, a partition per keyword string.  The ``newslive``
streaming source asks again and again: its offset says, per keyword string, how
many results have been taken, so a restarted query goes on after the last
finished batch and no result is read twice.  The driver only asks how many
results there are; results are read on the executors, in pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from newsgraph.sources.feed import DEFAULT_COUNTRY, DEFAULT_LIMIT, FEED_REPLY, register_search_source, search_queries, sources_frame


def query_strings(spark: SparkSession, sources: Sequence[str], query: str) -> list[str]:
    """One keyword string per newspaper, in list order."""
    rows = search_queries(sources_frame(spark, list(sources)), query).orderBy("source_idx").collect()  # the caller's list
    return [r["keywords"] for r in rows]


def search_replies(spark: SparkSession, sources: Sequence[str], query: str, search: Callable,
                   limit: int | None = None, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """The service's replies to the queries of all newspapers, searched on the
    executors when the result is read (write it before using it twice)."""
    register_search_source(spark, search)
    return (spark.read.format("newsfeed").option("keywords", "\n".join(query_strings(spark, sources, query)))
            .option("limit", str(limit or DEFAULT_LIMIT)).option("country", country).load())


def register_live_source(spark: SparkSession, service_factory: Callable) -> None:
    """Register the ``newslive`` streaming source.

    ``service_factory()`` makes an object with ``available(keywords, country)``,
    the number of results so far (oldest first, never fewer than before), and
    ``results(keywords, country, start, stop)``, that range of them.  Options:
    ``keywords`` = the keyword strings joined by newlines, ``page`` = results per
    request, ``country``."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class _Page(InputPartition):
        def __init__(self, idx: int, keywords: str, start: int, stop: int):
            super().__init__((idx, start))
            self.idx, self.keywords, self.start, self.stop = idx, keywords, start, stop

    class _Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.keywords = [k for k in options.get("keywords", "").split("\n") if k]
            self.page = int(options.get("page", "100"))
            self.country = options.get("country", DEFAULT_COUNTRY)

        def initialOffset(self):
            return {k: 0 for k in self.keywords}

        def latestOffset(self):
            service = service_factory()
            return {k: int(service.available(k, self.country)) for k in self.keywords}

        def partitions(self, start, end):
            return [_Page(i, k, at, min(at + self.page, end.get(k, 0)))
                    for i, k in enumerate(self.keywords) for at in range(start.get(k, 0), end.get(k, 0), self.page)]

        def read(self, partition):
            found = service_factory().results(partition.keywords, self.country, partition.start, partition.stop) or []
            items = [(partition.start + i, r.get("title"), r.get("link"), r.get("date"), ((r.get("source") or {}).get("name"),))
                     for i, r in enumerate(found)]
            yield (partition.idx, partition.keywords, items)

        def commit(self, end):
            pass

    class NewsLiveSource(DataSource):
        @classmethod
        def name(cls):
            return "newslive"

        def schema(self):
            return FEED_REPLY

        def streamReader(self, schema):
            return _Reader(self.options)

    spark.dataSource.register(NewsLiveSource)


def live_replies(spark: SparkSession, sources: Sequence[str], query: str, service_factory: Callable, page: int = 100,
                 country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Streaming replies to the queries of all newspapers."""
    register_live_source(spark, service_factory)
    return (spark.readStream.format("newslive").option("keywords", "\n".join(query_strings(spark, sources, query)))
            .option("page", str(page)).option("country", country).load())
