"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix is the golden-ratio point frac((i + 1) * phi); mapped
through the cumulative target shares it names a source, and the rank of the
slot among its source's slots names that source's block.  A source's
documents are shuffled by a hash and laid end to end as a stream of words,
cut into blocks of equal word count; its blocks are read in order, and a
second time where the target asks for more than one pass.  Slots and blocks
meet in a join on (source, block), so a source of any size spreads over all
tasks; ranks and stream positions are prefix sums in two levels (inside
hash chunks, and over the chunks' totals).

Sizes are runs of ``[^\\x20\\x09-\\x0D]+``.  Targets: weights 3, 1, 2,
repeating over the sources by code point (null last), share 150 % of all
words; no source gets above 2 times its own words, what is cut is shared
anew by weight.

Edge cases: a null text has size 0, and documents of size 0 take nothing; a
null source is a source of its own; rows that repeat one another are
copies with places of their own in the stream; a null doc_id is an id like
any other; other columns are ignored, and kept by the pipeline stage."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgraph.llm import common as C

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5        # of all words
MAX_PASSES = 2.0    # of a source's own words
BLOCK_WORDS = 512
CHUNK_ROWS = 4096   # documents per chunk of a source's stream
CHUNK_SLOTS = 1 << 14
PHI = (math.sqrt(5) - 1) / 2
SEED = 17


def _sizes(b: pa.RecordBatch):
    """Word count of each text in place of the text."""
    words = C.scan_words(b.column("text"), C.NON_SPACE_BYTE, lower=False, hashes=False)
    at = b.schema.get_field_index("text")
    yield b.set_column(at, "size", pa.array(C.row_counts(words.row, b.num_rows)))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of each row."""
    C.use_small_batches(docs.sparkSession)
    return C.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"),
                       _sizes, "doc_id long, source string, size long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): the shares of the budget by weight,
    with what exceeds a source's limit shared anew among the others.

    A source is at its limit exactly if its limit per weight lies below the
    common level; in the order of limit per weight, the level after the
    first k limits is (budget - their sum) / (weight of the rest), and the
    right k is the first whose level lies under the next source's limit.
    One row per source goes through the windows, never more."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MAX_PASSES)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("at", F.row_number().over(order))
           .withColumn("total", F.sum("source_size").over(every))
           .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", (F.col("total") * BUDGET - F.col("capped")) / F.col("open"))
           .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    level = F.min(F.when(F.col("fits"), F.struct("at", "level"))).over(every)["level"]
    return per.withColumn("common", level).select(
        "source", "source_size",
        F.least("cap", F.coalesce(F.col("common") * F.col("weight"), F.col("cap"))).alias("target"))


def stream(sizes: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, copy, start): where each document of at least
    one word begins in its source's shuffled stream of words."""
    rows = (sizes.where("size > 0").groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")))
    rows = rows.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "size", "copy"))
    chunks = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("chunks"))
    rows = C.keep(rows.join(chunks, rows["source"].eqNullSafe(chunks["source"])).drop(chunks["source"])
                  .withColumn("chunk", F.pmod(F.xxhash64("place"), F.col("chunks"))).drop("chunks"), "mix-stream")
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
            .withColumn("base", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
            .select(F.col("source").alias("s"), F.col("chunk").alias("c"), "base"))
    inside = (Window.partitionBy("source", "chunk").orderBy("place", "doc_id", "size", "copy")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (rows.join(sums, rows["source"].eqNullSafe(sums["s"]) & (rows["chunk"] == sums["c"]))
            .select("doc_id", "source", "size", "copy", (F.col("start") + F.col("base")).alias("start")))


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, block, pass, words): the mix, slot by slot.

    ``goals``: (source, source_size, target).  Each source keeps as many
    slots as its target has blocks, the last one partial; slots that the
    points leave short of that follow at the end."""
    spark = goals.sparkSession
    plan = (goals.where("target >= 1").withColumn("words", F.floor("target").cast("long"))
            .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
            .withColumn("slots", F.floor(F.col("words") / F.col("source_size")) * F.col("blocks")
                        + F.ceil(F.col("words") % F.col("source_size") / block)))
    by = Window.orderBy(F.col("source").asc_nulls_last())
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plan = plan.withColumn("hi", F.sum("target").over(upto)).withColumn("lo", F.col("hi") - F.col("target"))
    plan = C.keep(plan, "mix-plan")
    total, n = plan.agg(F.sum("target"), F.sum("slots")).first()
    if not n:
        return spark.createDataFrame([], "slot long, source string, block long, pass int, words long")
    n = int(n)
    # slots meet sources by the whole share units their point lies in, a
    # range join in which each slot fits exactly one source
    unit = 1024
    spans = plan.select("source", (F.col("lo") / total).alias("lo"), (F.col("hi") / total).alias("hi"))
    last = spans.agg(F.max("hi")).first()[0]
    spans = spans.withColumn("hi", F.when(F.col("hi") == last, F.lit(2.0)).otherwise(F.col("hi")))
    spans = spans.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * unit).cast("int"), F.least(F.floor(F.col("hi") * unit), F.lit(unit - 1)).cast("int"))))
    point = ((F.col("id") + 1) * F.lit(PHI)) % 1.0
    slots = (spark.range(n).withColumn("point", point).withColumn("cell", F.floor(F.col("point") * unit).cast("int"))
             .join(spans, "cell").where("point >= lo and point < hi")
             .select(F.col("id").alias("slot"), "source", F.floor(F.col("id") / CHUNK_SLOTS).alias("chunk")))
    inside = Window.partitionBy("source", "chunk").orderBy("slot")
    slots = slots.withColumn("rank", F.row_number().over(inside) - 1)
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (slots.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("k"))
            .withColumn("base", F.coalesce(F.sum("k").over(ahead), F.lit(0)))
            .select(F.col("source").alias("s"), F.col("chunk").alias("c"), "base", "k"))
    sums = C.keep(sums, "mix-sums")
    ranked = (slots.join(sums, slots["source"].eqNullSafe(sums["s"]) & (slots["chunk"] == sums["c"]))
              .select("slot", "source", (F.col("rank") + F.col("base")).alias("rank")))
    got = sums.groupBy("s").agg(F.sum("k").alias("k"))
    short = (plan.join(got, plan["source"].eqNullSafe(got["s"]), "left")
             .where(F.coalesce("k", F.lit(0)) < F.col("slots"))
             .select("source", F.explode(F.sequence(F.coalesce("k", F.lit(0)), F.col("slots") - 1)).alias("rank"))
             .select((F.col("rank") + n).alias("slot"), "source", "rank"))
    use = ranked.union(short).alias("r")
    p = plan.select(F.col("source").alias("s"), "words", "slots", "blocks", "source_size").alias("p")
    # a pass over a source ends with its last, shorter block: count words, not slots
    full = (use.join(p, F.col("r.source").eqNullSafe(F.col("p.s"))).where("rank < slots")
            .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")).cast("int"))
            .withColumn("block", F.col("rank") % F.col("blocks")))
    done = F.col("pass") * F.col("source_size") + F.col("block") * block
    size = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    return (full.withColumn("words", F.greatest(F.lit(0), F.least(size, F.col("words") - done)))
            .where("words > 0").select("slot", "source", "block", "pass", "words"))


def mix(sizes: DataFrame, goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, pass, source, block, doc_id, size, copy, first, taken): each
    piece of a document that the mix reads, ``first`` being the piece's
    first word in the document."""
    docs = stream(sizes)
    parts = docs.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    slots = schedule(goals, block)
    lo = F.greatest(F.col("start"), F.col("d.block") * block)
    hi = F.least(F.col("start") + F.col("size"), F.col("d.block") * block + F.col("words"))
    return (parts.alias("d").join(slots.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))
                                  & (F.col("d.block") == F.col("s.block")))
            .withColumn("first", lo - F.col("start")).withColumn("taken", hi - lo).where("taken > 0")
            .select("slot", "pass", F.col("d.source").alias("source"), F.col("d.block").alias("block"),
                    "doc_id", "size", "copy", "first", "taken"))


def op1(docs: DataFrame) -> DataFrame:
    """The registered query: doc_id, size, source_size, target, taken."""
    sizes = C.keep(sized(docs), "mix-sizes")
    goals = C.keep(targets(sizes), "mix-targets")
    per = (mix(sizes, goals).groupBy("doc_id", "source", "size", "copy").agg(F.sum("taken").alias("taken"))
           .select(F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("size").alias("z"), "copy", "taken"))
    every = stream_rows(sizes)
    out = every.join(per, every["doc_id"].eqNullSafe(per["i"]) & every["source"].eqNullSafe(per["s"])
                     & (every["size"] == per["z"]) & (every["copy_no"] == per["copy"]), "left").select(
        "doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    g = goals.select(F.col("source").alias("s"), "source_size", "target")
    return out.join(g, out["source"].eqNullSafe(g["s"])).select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "source")


def stream_rows(sizes: DataFrame) -> DataFrame:
    """Every row with the number of its copy, as ``stream`` numbers them."""
    some = (sizes.where("size > 0").groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy_no")))
    return some.union(sizes.where("size = 0").select("doc_id", "source", "size", F.lit(1)))


def mix_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the documents that the mix reads, with
    their columns, ``size``, ``target`` and ``taken`` (words, repeats
    counted); a document of which the mix takes nothing is left out.
    Rows that repeat one another share what is taken of them evenly."""
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    own = docs.select(columns, F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("source").cast("string").alias("source"), "text")
    schema = own.drop("text").schema.add("size", "long")
    own = C.map_arrow(own, _sizes, schema).select("d", F.col("doc_id").alias("i"), F.col("source").alias("s"),
                                                  F.col("size").alias("z"))
    taken = op1(docs.select("doc_id", "source", "text")).where("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.first("target").alias("target"), F.first("source_size").alias("source_size"),
        F.floor(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("taken"))
    joined = own.join(taken, own["i"].eqNullSafe(taken["doc_id"]) & own["s"].eqNullSafe(taken["source"])
                      & (own["z"] == taken["size"]))
    extra = [F.col(c).alias(C.fresh(docs, c)) for c in ("size", "source_size", "target", "taken")]
    return joined.select(*[F.col("d")[c].alias(c) for c in docs.columns], *extra)
