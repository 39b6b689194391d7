"""URL rules by a sort-merge range join on reversed-host keys.

The key of a url at one level of its host is the reversed host labels down
to that level, then the path: ``net\\0example\\0`` + ``\\1`` + ``/en/x``.  A
rule's key is built alike, and the rule fits exactly the keys in the
interval that begins with its own key (all that have it as prefix).  Keys of
urls and rules are cut into the same ranges and sorted; one sweep over a
range keeps the stack of rules whose interval is open, nested, the longest
on top.  A rule whose interval reaches over several ranges is dealt to each
of them; a key that many ranges begin with is spread over them.  Among the
levels of a host the longest host wins, then the longest path.

Edge cases: a null url, or one without ``://``, has an empty host and path
and fits no rule; no fitting rule means ``allow``; a rule with a null host is
ignored, a null path is empty; equal rules with both actions block; urls
that repeat are judged once; a null page_id is kept; other columns are
ignored."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import common as C

DEFAULT = "allow"
SAMPLE_PER_RANGE = 40
SPLIT_CHARS = 256
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_labels(host: Column) -> Column:
    """Labels from the top domain down, each closed by NUL (which, like the
    byte that opens the path, is escaped inside a label)."""
    safe = F.replace(F.replace(host, F.lit("\1"), F.lit("\1\3")), F.lit("\0"), F.lit("\1\2"))
    return F.transform(F.reverse(F.split(safe, r"\.", -1)), lambda x: F.concat(x, F.lit("\0")))


def level_key(labels: Column, level: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.slice(labels, F.lit(1), level), ""), F.lit("\1"), path)


def rule_table(rules: DataFrame) -> DataFrame:
    """(key, level, rule, action), one row per distinct rule."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    path = F.coalesce("path", F.lit(""))
    labels = reversed_labels(host)
    return (rules.where("host is not null and host != ''")
            .select(level_key(labels, F.size(labels), path).alias("key"), F.size(labels).alias("level"),
                    F.concat(host, path).alias("rule"), "action")
            .groupBy("key", "level", "rule").agg(F.max(F.when(F.col("action") == "block", 1).otherwise(0)).alias("b"))
            .select("key", "level", "rule", F.when(F.col("b") == 1, "block").otherwise("allow").alias("action")))


def sweep(rows):
    """(ref, rule, action) of each probe that fits a rule, from rows (range,
    key, kind, ref, action) sorted by range, key and kind; kind 0 are rules
    (``ref`` then is the rule), 1 probes."""
    stack, now = [], None
    for part, key, kind, ref, action in rows:
        if part != now:
            stack, now = [], part
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if kind == 0:
            stack.append((key, ref, action))
        elif stack:
            yield ref, stack[-1][1], stack[-1][2]


def _ranges(splits: list[str]):
    """Pandas functions giving the range of a probe and those of a rule."""
    def of_probe(key: pd.Series, salt: pd.Series) -> pd.Series:
        out = []
        for k, s in zip(key, salt):
            a = bisect_left(splits, k)
            out.append(a + s % (bisect_right(splits, k) - a + 1))
        return pd.Series(out, dtype="int32")

    def of_rule(key: pd.Series) -> pd.Series:
        out = []
        for k in key:
            a = z = bisect_left(splits, k)
            while z < len(splits) and splits[z].startswith(k):
                z += 1
            out.append(list(range(a, z + 1)))
        return pd.Series(out)

    return F.pandas_udf(of_probe, "int"), F.pandas_udf(of_rule, "array<int>")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the distinct (host, path) of ``urls``
    that fit a rule."""
    spark = urls.sparkSession
    table = C.keep(rule_table(rules), "url-rules")
    depth = table.agg(F.max("level")).first()[0] or 0
    labels = reversed_labels(F.col("host"))
    probes = (urls.where("host != ''").select("host", "path", labels.alias("labels"),
                                              F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1))))).alias("level"))
              .select("host", "path", "level", level_key(F.col("labels"), F.col("level"), F.col("path")).alias("key")))
    probes = C.keep(probes, "url-probes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = probes.count()
    share = min(1.0, SAMPLE_PER_RANGE * parts / max(n, 1))
    sample = sorted(r[0] for r in probes.sample(share, seed=7).select(F.substring("key", 1, SPLIT_CHARS)).collect())
    splits = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    of_probe, of_rule = _ranges(splits)
    rows = table.select(F.explode(of_rule("key")).alias("part"), "key", F.lit(0).alias("kind"),
                        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
                        "level", "rule", "action")
    rows = rows.union(probes.select(
        of_probe("key", F.pmod(F.xxhash64("host", "path"), F.lit(1 << 20)).cast("int")).alias("part"), "key",
        F.lit(1).alias("kind"), "host", "path", "level", F.lit(None).cast("string"), F.lit(None).cast("string")))

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("part", "key", "kind")),
                               zip(*(b.column(c).to_pylist() for c in ("host", "path", "level", "rule"))),
                               b.column("action").to_pylist())

        held = []
        for probe, rule, action in sweep(rows()):
            held.append((*probe[:3], rule[3], action))
            if len(held) == 4096:
                yield _batch(held)
                held = []
        yield _batch(held)

    found = (rows.repartition(parts, "part").sortWithinPartitions("part", "key", "kind")
             .mapInArrow(run, "host string, path string, level int, rule string, action string"))
    best = F.max_by(F.struct("rule", "action"), "level")
    return found.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")


def _batch(rows):
    cols = list(zip(*rows)) or [[]] * 5
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["host", "path", "level", "rule", "action"])


def op6(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """The registered query: page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    C.use_small_batches(spark, 4096)
    if rules is None:
        rules = spark.createDataFrame(RULES, "host string, path string, action string")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"))
    found = judge(own.select("host", "path").distinct(), rules).select(
        F.col("host").alias("h"), F.col("path").alias("p"), "rule", "action")
    # a hot url is one key of this join, which AQE splits
    return own.join(found, (own["host"] == found["h"]) & (own["path"] == found["p"]), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.lit(DEFAULT)).alias("verdict"))


ORACLE = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(host, path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                 ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT u.*, r.host || r.path AS rule, r.action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.host) DESC, length(r.path) DESC) AS k
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
"""
