"""Inputs of the news workflow derived from the driver's tables.

The driver's tables carry no news feed, so each input is derived from them
by a fixed rule, stated here in Spark and in ``plans/sql.py`` in SQL:

* feed items from ``pages`` (one item per page: link = url, newspaper =
  host with dots as spaces, title = page title, date text made from the
  page id);
* search replies from ``pages`` (one reply per page, its results = the
  page's anchors);
* model replies from ``documents`` (a deterministic annotation of the
  whole text, with defects injected on some rows to drive the reject
  paths);
* topics from ``part.p_name``; vectors from ``embeddings``.

Every rule reads its whole table; the modulo tests below choose which rows
get an injected defect, they never filter rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgraph.functions.text import html_title, url_host
from newsgraph.sources.feed import FEED_ITEM

# Fixed values of the derivations (shared with plans/sql.py).
FEED_EPOCH = "2024-01-01"
FEED_DAYS = 60
FEED_TIME_SUFFIX = ", 07:00 AM, +0000 UTC"
MOVED_EVERY = 7          # page fetch: every 7th link points to a moved page
REPLY_PERSON_RE = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"
REPLY_KEEP_RE = r"[^\p{L} ]"
ANCHOR_RE = r'<a href="([^"]*)">([^<]*)</a>'
# Defects injected into model replies, by doc_id divisibility, first match wins.
MISSING_COMMA, NO_BRACES, NO_TOPIC_KEY, SINGLE_QUOTES, TRAILING_COMMA = 17, 31, 29, 23, 19
EMPTY_TOPIC, NO_PERSONS = 13, 11
# Replies that are valid and hard to read: quotes, a bare word and a bracket
# inside the text (not in single-quoted replies), a bare string as persons.
HARD_TEXT, STRING_PERSONS = 7, 41
HARD_WORDS = ' Disse \u201cciao\u201d: None, [a, ] "x" l\u2019altro'
ONE_PERSON = "Mario Rossi"
STUB_TOPICS = ("the", "les", "der", "los", "und", "con")
QUERY = "elezioni europee"


# Text-heavy tables and their keys.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table.  A text-heavy table whose scan yields no more
    splits than the session has cores (a small file, possibly one row group
    that only one split reads) is hash-partitioned on its key so every core
    gets text to work on; large inputs scan into many splits and are left
    as read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = TEXT_TABLES.get(name)
    if key:
        try:
            par = spark.sparkContext.defaultParallelism
            few = df.rdd.getNumPartitions() <= par
        except Exception:  # sessions without an RDD view (Spark Connect)
            few = False
        if few:
            df = df.repartition(par, key)
    return df


def newspaper_of(url: Column) -> Column:
    return F.replace(url_host(url), F.lit("."), F.lit(" "))


def feed_date_text(page_id: Column) -> Column:
    day = F.date_add(F.to_date(F.lit(FEED_EPOCH)), F.pmod(page_id, F.lit(FEED_DAYS)).cast("int"))
    return F.concat(F.date_format(day, "M/d/yyyy"), F.lit(FEED_TIME_SUFFIX))


def feed_items_from_pages(pages: DataFrame) -> DataFrame:
    """Feed items as the search reader yields them (one per page)."""
    return pages.select(
        F.lit(0).alias("source_idx"),
        F.col("page_id").cast("int").alias("position"),
        html_title(F.col("html")).alias("title"),
        F.col("url").alias("link"),
        feed_date_text(F.col("page_id")).alias("date"),
        F.struct(newspaper_of(F.col("url")).alias("name")).alias("source"),
        F.col("page_id").cast("bigint").alias("row_ord"))


def feed_replies_from_pages(pages: DataFrame) -> DataFrame:
    """One search reply per page: keywords = host, results = anchors."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(ANCHOR_RE), 1)
    texts = F.regexp_extract_all(F.col("html"), F.lit(ANCHOR_RE), 2)
    host = newspaper_of(F.col("url"))
    items = F.transform(F.arrays_zip(hrefs.alias("h"), texts.alias("t")), lambda x, i: F.struct(
        i.cast("int").alias("position"), x["t"].alias("title"), x["h"].alias("link"),
        F.lit(None).cast("string").alias("date"), F.struct(host.alias("name")).alias("source")))
    return pages.select(F.col("page_id").cast("int").alias("source_idx"), host.alias("keywords"),
                        items.cast(f"array<{FEED_ITEM.simpleString()}>").alias("news_results"))


def moved_links(items: DataFrame) -> DataFrame:
    """Feed items whose link no longer matches a landed page on every
    ``MOVED_EVERY``-th row (to exercise the fetch misses)."""
    moved = F.pmod(F.col("row_ord"), F.lit(MOVED_EVERY)) == 0
    return items.withColumn("link", F.when(moved, F.concat(F.col("link"), F.lit("?moved=1")))
                            .otherwise(F.col("link")))


def _divisible(c: Column, n: int) -> Column:
    return F.pmod(c, F.lit(n)) == 0


def reply_parts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the fields the deterministic annotator puts in its
    reply: letters and spaces of the whole text, topic, persons."""
    d = F.col("doc_id")
    persons = (F.when(_divisible(d, STRING_PERSONS), F.array(F.lit(ONE_PERSON)))
               .when(_divisible(d, NO_PERSONS), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(F.col("text"), F.lit(REPLY_PERSON_RE), 0)))
    hard = _divisible(d, HARD_TEXT) & ~_divisible(d, SINGLE_QUOTES)
    return documents.select(
        "doc_id", "lang", "source", "text",
        F.concat(F.regexp_replace(F.col("text"), REPLY_KEEP_RE, ""),
                 F.when(hard, F.lit(HARD_WORDS)).otherwise(F.lit(""))).alias("r_text"),
        F.when(_divisible(d, EMPTY_TOPIC), F.lit("")).otherwise(F.col("source")).alias("r_topic"),
        persons.alias("r_persons"))


def replies_from_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, text, reply)``: a model reply per document."""
    p = reply_parts(documents)
    d = F.col("doc_id")
    plist = F.concat(F.lit("["), F.array_join(F.transform("r_persons", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "),
                     F.lit("]"))
    plist = F.when(_divisible(d, STRING_PERSONS), F.lit(f'"{ONE_PERSON}"')).otherwise(plist)
    text_kv = F.concat(F.lit('"text": "'), F.replace(F.col("r_text"), F.lit('"'), F.lit('\\"')), F.lit('"'))
    topic_kv = F.concat(F.lit('"topic": "'), F.col("r_topic"), F.lit('"'))
    persons_kv = F.concat(F.lit('"persons": '), plist)
    normal = F.concat(F.lit("{"), F.concat_ws(", ", text_kv, topic_kv, persons_kv), F.lit("}"))
    obj = (F.when(_divisible(d, MISSING_COMMA),
                  F.concat(F.lit("{"), text_kv, F.lit(" "), topic_kv, F.lit(", "), persons_kv, F.lit("}")))
           .when(_divisible(d, NO_BRACES), F.lit("nessun risultato"))
           .when(_divisible(d, NO_TOPIC_KEY), F.concat(F.lit("{"), F.concat_ws(", ", text_kv, persons_kv), F.lit("}")))
           .when(_divisible(d, SINGLE_QUOTES), F.replace(normal, F.lit('"'), F.lit("'")))
           .when(_divisible(d, TRAILING_COMMA),
                 F.concat(F.lit("{"), F.concat_ws(", ", text_kv, topic_kv, persons_kv), F.lit(",}")))
           .otherwise(normal))
    return p.select("doc_id", "lang", "source", "text",
                    F.concat(F.lit("Ecco: "), obj, F.lit(" fine")).alias("reply"))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Article rows for the replies: title, newspaper (= language), link,
    date, page text and the reply; ``row_ord`` = doc_id."""
    return (replies_from_documents(documents)
            .select(F.col("doc_id").cast("bigint").alias("row_ord"),
                    F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
                    F.col("lang").alias("newspaper"),
                    F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("link"),
                    F.date_add(F.to_date(F.lit(FEED_EPOCH)), F.pmod(F.col("doc_id"), F.lit(FEED_DAYS)).cast("int")).alias("date"),
                    "text", "reply"))


def part_topics(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").cast("bigint").alias("row_ord"), F.col("p_name").alias("topics"),
                       "p_partkey", "p_size", "p_type")

