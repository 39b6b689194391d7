"""Incremental feed: landed search replies picked up as they arrive.

``readStream`` over the reply folder → items → newspaper and day →
newspaper filter → ``dropDuplicatesWithinWatermark`` on the link (an article
returned again, for another newspaper or a later search, is kept once) →
append to a parquet table.  The filter comes first: a link that a newspaper
outside the list returned does not stand in the way of the same link from one
on the list.  Articles without a link are never equal to one another and pass
by the dedupe.  The watermark follows the time at which a reply
is picked up, not the article's date: no article is ever late, however old
its date, and ``remember`` only says how long a link stays known after it
was picked up.  The checkpoint lives in the shared
folder, so a restarted query resumes where it stopped.

The stream keeps the first arrival of a link; ``graph_stream`` builds the
graph from landings in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsgraph.operators.articles import filter_newspapers, normalize_feed
from newsgraph.sources.feed import FEED_REPLY, feed_items


def accepted_articles(spark: SparkSession, replies_dir: str, accepted: Sequence[str],
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of all accepted articles, repeats included."""
    reader = spark.readStream.schema(FEED_REPLY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return filter_newspapers(normalize_feed(feed_items(reader.json(replies_dir))), list(accepted))


def feed_stream(spark: SparkSession, replies_dir: str, accepted: Sequence[str],
                remember: str = "62 days",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of new articles (``title, newspaper, link, date,
    row_ord``)."""
    arts = accepted_articles(spark, replies_dir, accepted, max_files_per_trigger)
    linked = (arts.where("link is not null").withColumn("_seen", F.current_timestamp())
              .withWatermark("_seen", remember).dropDuplicatesWithinWatermark(["link"]).drop("_seen"))
    return linked.unionByName(arts.where("link is null"))


def run_feed_stream(spark: SparkSession, replies_dir: str, accepted: Sequence[str], sink_dir: str,
                    checkpoint_dir: str, remember: str = "62 days", available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental feed into a parquet table (append mode)."""
    df = feed_stream(spark, replies_dir, accepted, remember, max_files_per_trigger=max_files_per_trigger)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
