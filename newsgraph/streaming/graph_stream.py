"""Incremental graph: node, edge and surname tables kept up with the feed.

Each micro-batch writes small change tables, named by its batch id, so a
batch that is run again after a failure writes the same tables again:

* ``articles``: per link the row that now stands for it.  The smallest row
  (row order, then its columns) of a link wins, whatever order the landings come
  in; a row that is not smaller than the one at hand changes nothing.
* ``pairs``: the node pairs that the new rows bring, counted 1, and those of
  rows they replace, counted -1, each with its place in the table's order.
* ``names``: the full names they bring and take back, likewise.

Names are kept as they were read (title-cased, not completed), because a
later article can bring the full name of an earlier bare surname.  ``graph``
nets the counts, takes the last full name per surname over all that is left,
completes, and sums: node types and simple edges follow the last place, so the
result equals the graph of all landings read at once, each link once.
``compact`` nets the finished changes into a base table; readers take the last
complete base and the changes after it, so it can stop at any point.

An article with a null key column (its link among them) gives names but no
pairs, as in the batch result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsgraph.functions.text import ws_tokens
from newsgraph.operators.articles import ARTICLE_COLUMNS
from newsgraph.operators.graph import ArticleGraph, endpoints, node_types
from newsgraph.operators.persons import REGROUP_KEYS, title_persons
from newsgraph.session import drop_path, materialize
from newsgraph.streaming.feed_stream import accepted_articles

_ROW = "struct<row_ord:bigint,title:string,newspaper:string,link:string,date:date>"
_PLACE = f"struct<row:{_ROW},pos:int>"
_TABLES = {
    "articles": f"link string, row {_ROW}, batch bigint",
    "pairs": (f"link string, place {_PLACE}, rel_idx int, relationship string, src string, src_type string, "
              "dst string, dst_type string, n bigint, batch bigint"),
    "names": f"link string, place {_PLACE}, person string, n bigint, batch bigint",
}


@dataclass
class GraphState:
    """The change tables under ``folder`` of the shared file system.

    ``annotate`` maps new articles (``title, newspaper, link, date,
    row_ord``) to annotated ones, with ``topics`` and ``persons``; it should be
    a function of the article alone (pin model replies in a store)."""
    spark: SparkSession
    folder: str
    relationships: Sequence
    annotate: Callable[[DataFrame], DataFrame]

    def _folders(self, table: str) -> dict[str, list[int]]:
        """Batch ids of the complete base and change tables."""
        sc = self.spark.sparkContext
        root = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
        found: dict[str, list[int]] = {"base": [], "batch": []}
        for f in fs.listStatus(root) if fs.exists(root) else []:
            kind, _, number = f.getPath().getName().partition("-")
            if fs.exists(sc._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
                found[kind].append(int(number))
        return found

    def _read(self, table: str, before: int | None = None) -> DataFrame:
        found = self._folders(table)
        base = max(found["base"], default=-1)
        parts = [f"base-{base}"] * (base >= 0) + [
            f"batch-{b}" for b in sorted(found["batch"]) if b > base and (before is None or b < before)]
        if not parts:
            return self.spark.createDataFrame([], _TABLES[table])
        return self.spark.read.schema(_TABLES[table]).parquet(*[f"{self.folder}/{table}/{p}" for p in parts])

    def _write(self, table: str, name: str, batch: int, df: DataFrame) -> None:
        df.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{self.folder}/{table}/{name}-{batch}")

    def net(self, table: str, before: int | None = None) -> DataFrame:
        """What is left of a table after all changes."""
        rows = self._read(table, before)
        if table == "articles":
            linked = rows.where("link is not null").groupBy("link").agg(F.min("row").alias("row"))
            return linked.unionByName(rows.where("link is null").select("link", "row"))
        keys = [c for c in rows.columns if c not in ("n", "batch")]
        return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 0")

    def apply(self, articles: DataFrame, batch: int) -> None:
        """One micro-batch of accepted articles."""
        row = F.struct("row_ord", *ARTICLE_COLUMNS).cast(_ROW).alias("row")
        new = materialize(articles.select("link", row), "graph-batch")
        best = new.where("link is not null").groupBy("link").agg(F.min("row").alias("row"))
        known = self.net("articles", batch).where("link is not null").withColumnRenamed("row", "old")
        changed = best.join(known, "link", "left").where("old is null or row < old")
        lone = new.where("link is null").withColumn("old", F.lit(None).cast(_ROW))
        changed = materialize(changed.select("link", "row", "old").unionByName(lone), "graph-changed")
        replaced = changed.where("old is not null").select(F.col("link").alias("_link"), "old")
        exploded = materialize(self._exploded(changed.select("row.*")), "graph-rows")
        for table, added in (("pairs", self._pairs(exploded)), ("names", self._names(exploded))):
            gone = self.net(table, batch).join(
                replaced, (F.col("link") == F.col("_link")) & (F.col("place.row") == F.col("old")), "left_semi")
            added = added.withColumn("n", F.lit(1).cast("bigint"))
            self._write(table, "batch", batch, added.unionByName(gone.withColumn("n", -F.col("n")).select(*added.columns)))
        # last: until it stands the batch has not happened
        self._write("articles", "batch", batch, changed.select("link", "row"))

    def _exploded(self, articles: DataFrame) -> DataFrame:
        """Annotated articles, a row per person, with their place in the order."""
        table = self.annotate(articles).withColumn("_row", F.struct("row_ord", *ARTICLE_COLUMNS).cast(_ROW))
        if "persons" in table.columns:
            table = table.select("*", F.posexplode_outer("persons").alias("pos", "person"), F.lit("some").alias("list_state")).drop("persons")
            table = title_persons(table).withColumnRenamed("person", "persons").drop("list_state")
        else:
            table = table.withColumn("pos", F.lit(0))
        return table.withColumn("place", F.struct(F.col("_row").alias("row"), F.coalesce("pos", F.lit(0)).alias("pos")).cast(_PLACE)).drop("_row", "pos")

    def _pairs(self, exploded: DataFrame) -> DataFrame:
        """The node pairs of articles; a pair has a place for each time it is given."""
        whole = exploded.dropna(subset=[c for c in REGROUP_KEYS if c in exploded.columns])
        pairs = endpoints(whole, self.relationships, "place").withColumn("place", F.col("place.place"))
        return pairs.select(
            F.col("place.row.link").alias("link"), "place", F.col("rel_idx").cast("int").alias("rel_idx"), "relationship",
            "src", "src_type", "dst", "dst_type")

    @staticmethod
    def _names(exploded: DataFrame) -> DataFrame:
        person = F.col("persons") if "persons" in exploded.columns else F.lit(None).cast("string")
        return (exploded.select(F.col("place.row.link").alias("link"), "place", person.alias("person"))
                .where(F.size(ws_tokens(F.col("person"))) >= 2))

    def surnames(self) -> DataFrame:
        """(surname, full): the last full name that ends with a surname."""
        return self.net("names").groupBy(F.element_at(ws_tokens(F.col("person")), -1).alias("surname")).agg(
            F.max_by("person", "place").alias("full"))

    def graph(self) -> ArticleGraph:
        """The graph of all articles taken in so far."""
        names = materialize(self.surnames(), "graph-surnames")
        done = self.net("pairs")
        for end in ("src", "dst"):
            words = ws_tokens(F.col(end))
            bare = F.coalesce((F.col(f"{end}_type") == "persons") & (F.size(words) == 1), F.lit(False))
            single = done.where(bare).join(names, F.element_at(words, -1) == F.col("surname"), "left")
            single = single.withColumn(end, F.coalesce("full", end)).drop("surname", "full")
            done = single.unionByName(done.where(~bare))
        done = materialize(done, "graph-pairs")
        ends = done.select("place", "rel_idx", "n", F.explode(F.array(
            F.struct(F.lit(0).alias("end"), F.col("src").alias("id"), F.col("src_type").alias("type")),
            F.struct(F.lit(1).alias("end"), F.col("dst").alias("id"), F.col("dst_type").alias("type")))).alias("e"))
        nodes = (ends.select("place", "rel_idx", "n", "e.*").groupBy("id")
                 .agg(F.max_by("type", F.struct("place", "rel_idx", "end")).alias("type"), F.sum("n").alias("freq")))
        multi = done.groupBy("src", "dst", "relationship").agg(F.sum("n").alias("n"))
        simple = (done.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
                  .agg(F.max_by("relationship", F.struct("place", "rel_idx")).alias("relationship"))
                  .select(F.col("a").alias("src"), F.col("b").alias("dst"), "relationship"))
        return ArticleGraph(nodes, simple, multi, node_types(self.relationships))

    def compact(self) -> None:
        """Net the changes of all finished batches into a base table.  Not
        while a batch runs: what that one sees must not move."""
        upto = max(self._folders("articles")["batch"], default=-1)
        for table in _TABLES if upto >= 0 else ():
            self._write(table, "base", upto, materialize(self.net(table, upto + 1), "compact"))
        for table in _TABLES if upto >= 0 else ():
            found = self._folders(table)
            for kind, numbers in found.items():
                for b in numbers:
                    if b < upto or kind == "batch" and b == upto:
                        drop_path(self.spark, f"{self.folder}/{table}/{kind}-{b}")


def run_graph_stream(state: GraphState, replies_dir: str, accepted: Sequence[str], checkpoint_dir: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream that keeps ``state`` up with the landings."""
    arts = accepted_articles(state.spark, replies_dir, accepted, max_files_per_trigger)
    w = arts.writeStream.foreachBatch(state.apply).option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
