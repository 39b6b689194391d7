"""Language identification by Bayesian evidence fusion.

For each page and language the log posterior adds up
* the text's likelihood: hashed byte trigrams under a multinomial model per
  language, trained on a bounded sample of labelled documents, tempered so
  that neighbouring trigrams do not count as independent;
* the declared markup language: how often pages of a language declare what
  this one does;
* the address: a prior of the host, smoothed towards that of its domain
  (last two labels), of its suffix (last label) and of all pages, in turn.
The last two are sums of the text posteriors by grouped aggregation; a
page's own share is taken out of the groups it is judged by.

Edge cases: a page without text, url or declaration lacks that piece of
evidence only (the prior decides); equal posteriors go to the first
language by name; labelled documents without text or language do not train;
with no training rows language and posterior are null; a null page_id is
kept; rows that repeat are judged each; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.llm.urlfilter import host_of

TRAIN_DOCS = 20_000   # bound of the labelled training sample
HASH_BITS = 16
TEMPER = 0.25         # weight of one trigram's log likelihood
SHRINK = 2.0          # pseudo-pages of the next wider group
TAGS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the byte trigrams of each lower-cased text."""
    data, offsets = C.text_buffer(texts)
    if len(data) < 3:
        z = np.zeros(0, np.int64)
        return z, z
    x = C.LOWER[data].astype(np.uint32)
    key = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    bucket = ((key * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)).astype(np.int64)
    per = np.maximum(np.diff(offsets) - 2, 0)
    row = np.repeat(np.arange(len(texts)), per)
    at = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(offsets[:-1], per)
    return row, bucket[at]


def train(docs: DataFrame, max_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log trigram probabilities and log shares."""
    spark = docs.sparkSession
    C.use_small_batches(spark)
    picked = (docs.where("lang is not null and doc_id is not null and text is not null")
              .select("doc_id", F.xxhash64("doc_id").alias("pos")).distinct()
              .orderBy("pos", "doc_id").limit(max_docs).select("doc_id"))
    rows = docs.select("doc_id", "lang", "text").where("lang is not null").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            row, bucket = trigrams(b.column("text"))
            langs = b.column("lang").to_pylist()
            for lang in set(langs):
                mine = np.array([x == lang for x in langs])
                n = np.bincount(bucket[mine[row]], minlength=1 << HASH_BITS)
                held[lang] = held.get(lang, 0) + np.append(n, mine.sum())
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "i", "n"])

    sums = (rows.select("lang", "text").mapInArrow(count, "lang string, i int, n long")
            .groupBy("lang", "i").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(sums["lang"].unique())
    counts = np.zeros((len(langs), (1 << HASH_BITS) + 1))
    if langs:
        counts[sums["lang"].map(langs.index), sums["i"]] = sums["n"]
    grams = counts[:, :-1] + 0.5
    prior = counts[:, -1] + 1
    return langs, np.log(grams / grams.sum(1, keepdims=True)), np.log(prior / max(prior.sum(), 1))


def evidence(pages: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """(page_id, host, domain, suffix, declared, ll): the tempered text log
    likelihoods per language."""
    sent = pages.sparkSession.sparkContext.broadcast(logp.astype(np.float32))
    host = host_of(F.col("url"))
    labels = F.split(host, r"\.")
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"),
        F.lower(F.coalesce(F.regexp_extract("html", DECLARED, 1), F.lit(""))).alias("declared"),
        F.regexp_replace("html", TAGS, " ").alias("text"))

    def run(b: pa.RecordBatch):
        p = sent.value
        row, bucket = trigrams(b.column("text"))
        ll = np.stack([np.bincount(row, weights=p[k][bucket], minlength=b.num_rows) for k in range(len(p))], 1) * TEMPER
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("page_id", "host", "domain", "suffix", "declared")),
             C.list_of(ll.ravel(), np.full(b.num_rows, ll.shape[1]))],
            ["page_id", "host", "domain", "suffix", "declared", "ll"])

    return C.map_arrow(own, run, "page_id long, host string, domain string, suffix string, declared string, ll array<double>")


def softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _sums(n: int) -> Column:
    return F.array(*[F.sum(F.col("q")[i]) for i in range(n)])


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, host, declared, text_lang, lang, posterior)."""
    langs, logp, prior = train(docs)
    k = len(langs)
    if not k:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                            F.lower(F.regexp_extract("html", DECLARED, 1)).alias("declared"),
                            *[F.lit(None).cast("string").alias(c) for c in ("text_lang", "lang")],
                            F.lit(None).cast("double").alias("posterior"))
    known = F.array(*[F.lit(float(x)) for x in prior])
    rows = evidence(pages, langs, logp)
    rows = rows.withColumn("base", F.zip_with("ll", known, lambda a, b: a + b)).withColumn("q", softmax(F.col("base")))
    rows = C.keep(rows.drop("base"), "lang-evidence")
    # sums of text posteriors per group; the widest ones fit one row each language
    total = rows.agg(_sums(k).alias("s")).first()["s"] or [0.0] * k
    everywhere = [(x or 0.0) for x in total]
    share = F.array(*[F.lit((x + 1.0) / (sum(everywhere) + k)) for x in everywhere])
    names = C.keep(rows.groupBy("suffix", "domain", "host").agg(_sums(k).alias("host_s")), "lang-hosts")
    add = lambda c: F.array(*[F.sum(F.col(c)[i]) for i in range(k)])
    domains = names.groupBy("suffix", "domain").agg(add("host_s").alias("domain_s"))
    suffixes = domains.groupBy("suffix").agg(add("domain_s").alias("suffix_s"))
    groups = (names.join(domains.drop("suffix"), "domain").join(suffixes, "suffix")
              .select(F.col("host").alias("h"), "host_s", "domain_s", "suffix_s"))
    says = rows.groupBy("declared").agg(_sums(k).alias("says_s"), F.count(F.lit(1)).alias("says_n"))
    n = F.lit(float(sum(everywhere)) or 1.0)
    # a hot host or declaration is one key of these joins, which AQE splits
    full = rows.join(groups, rows["host"] == groups["h"]).join(
        says.withColumnRenamed("declared", "says"), F.col("declared") == F.col("says"))

    def smoothed(sums: str, wider: Column) -> Column:
        left = F.zip_with(sums, "q", lambda s, q: F.greatest(s - q, F.lit(0.0)))
        size = F.aggregate(left, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(left, wider, lambda s, w: (s + SHRINK * w) / (size + SHRINK))

    for level, wider in (("suffix_s", share), ("domain_s", F.col("p_suffix_s")), ("host_s", F.col("p_domain_s"))):
        full = full.withColumn(f"p_{level}", smoothed(level, wider))
    # P(declares this | language), smoothed by how often pages declare it at all
    every = F.array(*[F.lit(x) for x in everywhere])
    says_p = F.zip_with(F.zip_with("says_s", "q", lambda s, q: F.greatest(s - q, F.lit(0.0))), every,
                        lambda s, e: (s + SHRINK * F.col("says_n") / n) / (e + SHRINK))
    full = full.withColumn("score", F.zip_with(
        F.zip_with("ll", "p_host_s", lambda a, b: a + F.log(b)),
        F.when(F.col("declared") == "", F.array_repeat(F.lit(1.0), k)).otherwise(says_p),
        lambda a, b: a + F.log(b)))
    full = full.withColumn("post", softmax(F.col("score")))
    names_ = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(names_, F.array_position(F.col(c), F.array_max(c)).cast("int"))
    return full.select("page_id", "host", "declared", best("q").alias("text_lang"), best("post").alias("lang"),
                       F.array_max("post").alias("posterior"))


def op4(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The registered query."""
    return identify(pages, docs)
