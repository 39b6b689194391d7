"""Live-path hooks exercised with local stand-ins (no network)."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsgraph.functions import text as T
from newsgraph.operators.articles import normalize_feed
from newsgraph.sources import feed as FD

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fake_search(keywords, limit, country):
    name = keywords.split()[0]
    return [{"title": f"{keywords} #{i}", "link": f"https://{name}.example/{i}",
             "date": f"{i + 1}/2/2024, 07:00 AM, +0000 UTC", "source": {"name": name.title()}}
            for i in range(min(3, limit))]


def test_search_source_one_partition_per_keyword(spark):
    FD.register_search_source(spark, fake_search)
    q = FD.search_queries(FD.sources_frame(spark, ["repubblica", "corriere"]), "elezioni")
    kws = "\n".join(r.keywords for r in q.orderBy("source_idx").collect())
    replies = spark.read.format("newsfeed").option("keywords", kws).option("limit", "2").load()
    assert replies.rdd.getNumPartitions() == 2
    arts = normalize_feed(FD.feed_items(replies)).orderBy("row_ord").collect()
    assert [(a.newspaper, a.link, str(a.date)) for a in arts] == [
        ("Repubblica", "https://repubblica.example/0", "2024-01-02"),
        ("Repubblica", "https://repubblica.example/1", "2024-02-02"),
        ("Corriere", "https://corriere.example/0", "2024-01-02"),
        ("Corriere", "https://corriere.example/1", "2024-02-02")]
    assert arts[2].row_ord == 1 << 32


class WordEncoder:
    def encode(self, s):
        return s.split()


def test_exact_token_count_hook(spark):
    df = spark.createDataFrame([("a b c",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(T.token_count(F.col("s"), WordEncoder)).collect()]
    assert got == [3, 0, None]
    approx = [r[0] for r in df.select(T.token_count(F.col("s"))).collect()]
    assert approx == [3, 0, None]


def test_fetch_pages_with_local_fetcher(spark):
    def make_fetcher():
        def fetch(url):
            if url.endswith("/missing"):
                return 404, None
            if url.endswith("/boom"):
                raise IOError("reset")
            return 200, f"<p>{url}</p>"
        return fetch

    links = spark.createDataFrame([("u/1",), ("u/1",), ("u/missing",), ("u/boom",)], "link string")
    got = {r.url: (r.status, r.html) for r in FD.fetch_pages(links, make_fetcher).collect()}
    assert got == {"u/1": (200, "<p>u/1</p>"), "u/missing": (404, None), "u/boom": (-1, None)}


def test_scrape_articles_builds_the_queries(spark):
    from newsgraph.plans.workflow import NewsRun, scrape_articles

    asked = NewsRun(query="elezioni", sources=["repubblica", "corriere"], start_date="2024-01-15", end_date="2024-03-31",
                    limit=3, country="fr")

    def search(keywords, limit, country):
        return [{**r, "title": f"{r['title']} {country}"} for r in fake_search(keywords, limit, country)]

    got = scrape_articles(spark, asked, search).orderBy("row_ord").collect()
    assert [(r.title, r.newspaper, str(r.date)) for r in got] == [
        (f"{s} elezioni #{i} fr", s.title(), f"2024-0{i + 1}-02") for s in ("repubblica", "corriere") for i in (1, 2)]


class FileService:
    """A service whose results grow: a line per result in a file per keyword string."""

    def __init__(self, folder):
        self.folder = folder

    def _lines(self, keywords):
        import os

        path = os.path.join(self.folder, keywords.replace(" ", "_"))
        return open(path).read().splitlines() if os.path.exists(path) else []

    def available(self, keywords, country):
        return len(self._lines(keywords))

    def results(self, keywords, country, start, stop):
        return [{"title": x, "link": f"https://{x}", "date": "1/2/2024", "source": {"name": keywords.split()[0]}}
                for x in self._lines(keywords)[start:stop]]


def test_live_source_resumes_without_repeats(spark, tmp_path):
    from newsgraph.sources.live import live_replies

    folder = tmp_path / "service"
    folder.mkdir()

    def poll():
        replies = live_replies(spark, ["Ansa", "Agi"], "voto", lambda: FileService(str(folder)), page=2)
        (replies.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination())
        rows = FD.feed_items(spark.read.schema(FD.FEED_REPLY).parquet(str(tmp_path / "out"))).collect()
        return sorted((r.keywords, r.position, r.title) for r in rows)

    (folder / "Ansa_voto").write_text("a0\na1\na2\n")
    first = [("Ansa voto", i, f"a{i}") for i in range(3)]
    assert poll() == first
    (folder / "Ansa_voto").write_text("a0\na1\na2\na3\n")
    (folder / "Agi_voto").write_text("b0\n")
    assert poll() == [("Agi voto", 0, "b0"), *first, ("Ansa voto", 3, "a3")]
