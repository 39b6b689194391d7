"""Topic merging by mapping: reverse mapping, remap, distinct topics,
representative topic per cluster, and clustering by a language model.

A mapping is a DataFrame ``(label, label_ord, member)`` (one row per
member), possibly parsed from a model reply.  Lookups are joins
that AQE broadcasts when the measured mapping is small and keeps as
sort-merge joins otherwise."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.functions.text import extract_braces, lower_tokens, repair_json
from newsgraph.operators.annotate import CLUSTER_CALL, call_model, cluster_prompt
from newsgraph.operators.forest import edge_components
from newsgraph.session import materialize

MAPPING_TYPE = "map<string,array<string>>"


def mapping_from_json(df: DataFrame, json_col: str, order_cols: Sequence[str] = ()) -> DataFrame:
    """``(label, label_ord, member_pos, member)`` from a JSON object text
    ``{label: [members]}``; ``label_ord`` = (order columns…, key position).
    A key repeated in one object keeps its last list at the position of its
    first occurrence, as a Python dict does (the JSON reader keeps both)."""
    m = F.from_json(F.col(json_col), MAPPING_TYPE)
    entries = df.select(*order_cols, F.posexplode(F.map_entries(m)).alias("_kpos", "_e"))
    keyed = (entries.groupBy(*order_cols, F.col("_e.key").alias("label"))
             .agg(F.min("_kpos").alias("_k"), F.max_by(F.col("_e.value"), F.col("_kpos")).alias("_members")))
    return keyed.select(
        "label",
        F.struct(*[F.col(c) for c in order_cols], F.col("_k").alias("k")).alias("label_ord"),
        F.posexplode(F.col("_members")).alias("member_pos", "member"))


def reverse_mapping(mapping: DataFrame) -> DataFrame:
    """member → label; a member listed under two labels takes the later one."""
    return (mapping.filter(F.col("member").isNotNull())
            .groupBy("member").agg(F.max_by("label", F.col("label_ord")).alias("label")))


def remap(df: DataFrame, col: str, reverse: DataFrame) -> DataFrame:
    """Replace ``col`` by its label; values without a label stay."""
    r = reverse.select(F.col("member").alias("_member"), F.col("label").alias("_label"))
    out = df.join(r, df[col] == r["_member"], "left")
    return out.withColumn(col, F.coalesce(F.col("_label"), F.col(col))).drop("_member", "_label")


def distinct_topics(df: DataFrame, col: str = "topics", order_col: str = "row_ord") -> DataFrame:
    """Distinct non-null topics with first appearance and row count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("topic"))
            .agg(F.min(order_col).alias("first_ord"), F.count(F.lit(1)).alias("weight")))


def representatives(df: DataFrame, cluster_col: str = "topic_cluster", col: str = "topics",
                    order_col: str = "row_ord") -> DataFrame:
    """Commonest topic per cluster; a tie goes to the topic seen first.
    Two partial aggregations, no window over a whole cluster."""
    counts = (df.groupBy(cluster_col, col)
              .agg(F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_first")))
    return counts.groupBy(cluster_col).agg(
        F.max_by(F.col(col), F.struct(F.col("_n"), -F.col("_first"))).alias("representative"))


def apply_representatives(df: DataFrame, reps: DataFrame, cluster_col: str = "topic_cluster",
                          col: str = "topics") -> DataFrame:
    """Overwrite ``col`` by the representative of the row's cluster."""
    r = reps.select(F.col(cluster_col).alias("_cl"), F.col("representative").alias("_rep"))
    out = df.join(r, df[cluster_col].eqNullSafe(r["_cl"]), "left")
    return out.withColumn(col, F.col("_rep")).drop("_cl", "_rep")


def topic_batches(topics: DataFrame, batch_size: int = 200) -> DataFrame:
    """Distinct topics in batches of about ``batch_size`` for the clustering
    prompt: ``(batch, first_ord, prompt_lines)``.  Batches are hash buckets
    (no global sort into one partition); inside a batch, topics keep their
    first-seen order."""
    n = topics.count()
    buckets = max(1, -(-n // batch_size))
    return _prompt_lines(topics.withColumn("batch", F.pmod(F.xxhash64("topic"), F.lit(buckets))))


def _paired_batches(topics: DataFrame, groups: int, turn: int) -> DataFrame:
    """Batches of two groups each, as a round-robin draw pairs them: in
    ``groups - 1`` turns in a row (``groups`` is even) each two groups meet
    once.  A topic's group follows from its first appearance, which its
    label keeps whatever the model calls it."""
    odd = groups - 1
    g = F.pmod(F.xxhash64("first_ord"), F.lit(groups))
    other = F.pmod(F.lit(turn % odd) - g, F.lit(odd))
    alone = turn * (groups // 2) % odd  # the group that meets the last one
    return _prompt_lines(topics.withColumn("batch", F.when(g == odd, F.lit(alone)).otherwise(F.least(g, other))))


def _prompt_lines(b: DataFrame) -> DataFrame:
    return (b.groupBy("batch")
            .agg(F.array_sort(F.collect_set(F.struct("first_ord", "topic"))).alias("_t"))
            .select("batch", F.col("_t")[0]["first_ord"].alias("first_ord"),
                    F.array_join(F.transform("_t", lambda x: x["topic"]), "\n").alias("prompt_lines")))


def _placed(batches: DataFrame, client_factory: Callable, labels, **kw) -> DataFrame:
    """(member, label): what the model says of the topics in ``batches``,
    one call per batch."""
    replies = call_model(batches, cluster_prompt(F.col("prompt_lines"), labels),
                         client_factory, CLUSTER_CALL, **kw)
    raw = replies.withColumn("_j", extract_braces(F.col("reply")))
    parsed = raw.withColumn("_json", F.when(
        F.from_json("_j", MAPPING_TYPE, {"allowSingleQuotes": "true"}).isNull(), repair_json(F.col("_j"))).otherwise(F.col("_j")))
    return mapping_from_json(parsed, "_json", ("first_ord", "batch"))


def label_blocks(labels: DataFrame, batch_size: int, buckets: int) -> DataFrame:
    """(batch, topic, first_ord): labels that may be one, in the same call.

    Labels meet in the block of each word they share (lower-cased); blocks are
    packed by a hash of the word into ``buckets`` calls.  The block of a word
    that more than ``batch_size`` labels share is cut by the labels' next word,
    so that the nearest of them still meet."""
    words = F.array_distinct(lower_tokens(F.col("topic")))
    pairs = labels.select("topic", "first_ord", F.posexplode(words).alias("at", "word"), words.alias("words"))
    size = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    other = F.element_at("words", F.when(F.col("at") == 0, F.lit(-1)).otherwise(F.col("at")).cast("int"))
    part = F.when(F.col("n") > batch_size, F.pmod(F.xxhash64(other), F.ceil(F.col("n") / batch_size))).otherwise(F.lit(0))
    return pairs.join(size, "word").select(
        F.when(part == 0, F.pmod(F.xxhash64("word"), F.lit(buckets)))
        .otherwise(F.xxhash64("word", part)).alias("batch"), "topic", "first_ord")


def _one_label(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """(member, label) with one answer per label: those that some call put
    under one label are one, transitively, and take the label of the first."""
    named = placed.where("member is not null").join(labels.select(F.col("topic").alias("member"), "first_ord"), "member")
    ends = named.select("label", "first_ord").unionByName(  # a label that is itself among the labels
        named.select("label").distinct().join(labels.select(F.col("topic").alias("label"), "first_ord"), "label"))
    low = ends.groupBy("label").agg(F.min("first_ord").alias("b"))
    links = ends.join(low, "label").select(F.col("first_ord").alias("a"), "b")
    comps = edge_components(links)
    found = named.join(comps, named["first_ord"] == comps["id"])
    best = found.groupBy("comp").agg(F.min_by("label", F.struct("first_ord", "label_ord", "label")).alias("label"))
    return found.select("member", "comp").distinct().join(best, "comp").select("member", "label")


def cluster_with_model(df: DataFrame, client_factory: Callable, labels: Sequence[str] | None = None,
                       col: str = "topics", order_col: str = "row_ord", batch_size: int = 200,
                       partitions: int | None = None, store: str | None = None,
                       pin: bool = False, every_pair: bool = False) -> DataFrame:
    """Merge topics by a model: distinct topics are sent in batches, each
    reply (``{label: [topics]}``) is brace-extracted and parsed, and the
    topics are remapped; a topic the model did not place stays.

    More topics than one batch holds are reconciled: the labels found are
    sent again, all in one call once a batch holds them, else those that share
    a word in the same calls (``label_blocks``).  What calls put under one label
    becomes one label, and only calls whose labels have changed are sent
    again.  A round of n labels of w words takes at most about ``n * w /
    batch_size`` calls, and later rounds only those that a merge touched, so
    calls are linear in the labels.  Labels without a common word meet only in
    the first batches and the last call; with ``every_pair`` each two labels
    are in one call in the end, by a round-robin draw, which takes calls in
    the square of the labels.  With given ``labels`` one round is enough."""
    ask = partial(_placed, client_factory=client_factory, labels=labels, partitions=partitions, store=store, pin=pin)
    now = materialize(distinct_topics(df, col, order_col).select("topic", "first_ord"), "topics")
    n = now.count()
    placed = reverse_mapping(ask(topic_batches(now, batch_size)))
    if n <= batch_size or labels:
        return remap(df, col, placed)
    total = materialize(now.join(placed, now["topic"] == placed["member"], "left").select(
        F.col("topic").alias("member"), F.coalesce("label", "topic").alias("label"), "first_ord"), "topic-labels")
    sent = buckets = None
    turn = quiet = 0
    before = None
    while True:
        now = materialize(total.groupBy(F.col("label").alias("topic")).agg(F.min("first_ord").alias("first_ord")), "labels")
        left = now.count()
        if left <= batch_size:
            return remap(df, col, _moved(total, reverse_mapping(ask(topic_batches(now, batch_size)))))
        if buckets is None:
            words = now.select(F.sum(F.size(F.array_distinct(lower_tokens(F.col("topic")))))).first()[0] or 0
            buckets = max(1, -(-words // batch_size))
        batches = _prompt_lines(label_blocks(now, batch_size, buckets)).where(F.contains("prompt_lines", F.lit("\n")))
        batches = batches.withColumn("sign", F.sha2("prompt_lines", 256))
        if sent is not None:
            batches = batches.join(sent, "sign", "left_anti")
        batches = materialize(batches, "label-calls")
        if not batches.isEmpty():
            known = batches.select("sign")
            sent = known if sent is None else sent.unionByName(known)
        elif every_pair:
            if left != before:
                groups, quiet, before = 2 * -(-left // batch_size), 0, left
            elif quiet == groups - 1:
                break
            turn, quiet = turn + 1, quiet + 1
            batches = _paired_batches(now, groups, turn)
        else:
            break
        step = materialize(_one_label(ask(batches), now), "label-step")
        total = materialize(_moved(total, step), "topic-labels")
    return remap(df, col, total)


def _moved(total: DataFrame, step: DataFrame) -> DataFrame:
    """``total`` (member, label, first_ord) with its labels replaced as ``step`` says."""
    s = step.select(F.col("member").alias("_m"), F.col("label").alias("_l"))
    return total.join(s, total["label"] == s["_m"], "left").select("member", F.coalesce("_l", "label").alias("label"), "first_ord")
