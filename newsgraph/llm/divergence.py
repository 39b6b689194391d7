"""Source divergence audit: how far each source of a language is from the
others, and which terms set it apart.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; each
lang keeps those in at least 30 of its documents.  Shares are whole numbers
(1 + floor(10^9 (count + 5) / (N + 5 V))), by long division in 64 bits.

*Pairs.*  The distance of two sources sums |p - q| over all kept terms.  A
term that a source does not have gives it the same share whatever the term,
so only occurring (source, term) cells are read: tiles of sources by salted
parts of the terms sum the difference to the distance of the empty sources.

*Terms.*  The value p - q grows with the group's count and falls with the
lang's, and ties go to the earlier term.  So a term that at least ``k`` others
dominate (a count in the group no lower, in the lang no higher, earlier in
UTF-8) is not among the first ``k``.  Parts of each group keep their ``k``-skyband;
the bands are merged in parts of bounded size while that removes a tenth of
the rows, and what is left is ranked exactly.

Edge cases: null lang, source or text is ''; groups without terms, and
langs that keep none, still get their pairs (value 0 if the lang keeps none);
a lang with one source has no pairs; repeated rows count each; very long texts
are split whole; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgraph.llm import common as C
from newsgraph.llm import terms

MIN_DOCS = 30
SMOOTH = 5
TOP = 50
TILE = 512            # sources per side of a tile
PART_TERMS = 8192     # terms in one part of a tile, or of a group
_CHUNK = 512


def scan(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, partial sums."""
    base = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])

    def run(batches):
        for b in batches:
            for part in terms.slices(b, "text"):
                rows, flat = terms.split_terms(part.column("text"), terms.NOT_LETTER)
                if not len(rows):
                    continue
                coded = flat.dictionary_encode()
                n = len(coded.dictionary)
                lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                r, c, count = terms.row_term_counts(rows, coded.indices.to_numpy(), n)
                key, at = np.unique(group[r] * n + c, return_inverse=True)
                of = key // n
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(of // len(source.dictionary))),
                     source.dictionary.take(pa.array(of % len(source.dictionary))),
                     coded.dictionary.take(pa.array(key % n)).cast(pa.string()),
                     pa.array(np.bincount(at, weights=count).astype(np.int64)), pa.array(np.bincount(at))],
                    ["lang", "source", "term", "n", "docs"])

    return base.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 5) / total), exact while total * 1000 fits in
    64 bits; null if total is 0."""
    div = lambda a, b: F.call_function("div", a, b)
    x = count.cast("long") + SMOOTH
    out, rest = div(x, total), x % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + div(rest, total), rest % total
    return F.when(total > 0, out + 1)


def skyband(count: np.ndarray, lang_count: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the points that fewer than ``k`` others dominate: higher or
    equal ``count``, lower or equal ``lang_count``, lower ``order``."""
    at = np.lexsort((order, lang_count, -count))  # dominators come first
    low, early = lang_count[at], order[at]
    kept = np.zeros(0, np.int64)
    for lo in range(0, len(at), _CHUNK):
        x, y = low[lo:lo + _CHUNK], early[lo:lo + _CHUNK]
        n = ((low[kept] <= x[:, None]) & (early[kept] <= y[:, None])).sum(1)
        inside = (x <= x[:, None]) & (y <= y[:, None])
        n += np.tril(inside, -1).sum(1)
        kept = np.append(kept, np.flatnonzero(n < k) + lo)
    return at[kept]


def term_candidates(cells: DataFrame, k: int = TOP) -> DataFrame:
    """The rows of ``cells`` (lang, source, term, n, l) that can be among the
    first ``k`` of their group."""
    schema = "lang string, source string, term string, n long, l long"

    def band(t: pa.Table) -> pa.Table:
        t = t.select(["lang", "source", "term", "n", "l"])
        term = t.column("term").combine_chunks()
        order = np.empty(len(term), np.int64)
        order[pc.array_sort_indices(term.cast(pa.binary())).to_numpy()] = np.arange(len(term))
        return t.take(pa.array(skyband(t.column("n").to_numpy(), t.column("l").to_numpy(), order, k)))

    found, rows = cells, cells.count()
    while rows:
        size = found.groupBy("lang", "source").agg(
            F.ceil(F.count(F.lit(1)) / PART_TERMS).cast("int").alias("parts"))
        salted = found.join(size, ["lang", "source"]).withColumn(
            "part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
        found = C.keep(salted.groupBy("lang", "source", "part").applyInArrow(band, schema), "skyband")
        left = found.count()
        if left > 0.9 * rows:
            break
        rows = left
    return found


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, s) for source numbers a < b of a lang: the sum over its
    kept terms of |p_a - p_b| less that of two sources without terms.

    ``cells``: (lang, i, term, p).  ``groups``: (lang, i, p0, v)."""
    tile = F.floor(F.col("i") / TILE).cast("int")
    last = groups.groupBy("lang").agg(
        F.floor(F.max("i") / TILE).cast("int").alias("last"),
        F.greatest(F.lit(1), F.ceil(F.max("v") / PART_TERMS)).cast("int").alias("parts"))
    wide = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    sides = [F.least(tile, "other").alias("ta"), F.greatest(tile, "other").alias("tb")]
    cell = (cells.join(last, "lang").withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
            .select("lang", "part", "i", "term", "p", "last", wide).select("lang", *sides, "part", "i", "term", "p"))
    # the shares of absent terms go to each part of a tile, marked by no term
    none = (groups.join(last, "lang").select("lang", "i", "p0", "parts", "last", wide)
            .select("lang", *sides, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "i",
                    F.lit(None).cast("string").alias("term"), F.col("p0").alias("p")))

    def run(t: pa.Table) -> pa.Table:
        absent = pc.is_null(t.column("term")).to_numpy()
        i, p = t.column("i").to_numpy(), t.column("p").to_numpy()
        at = np.unique(i[absent])
        p0 = np.zeros(len(at), np.int64)
        p0[np.searchsorted(at, i[absent])] = p[absent]
        code = t.column("term").combine_chunks().filter(pa.array(~absent)).dictionary_encode()
        m = np.tile(p0, (len(code.dictionary), 1))
        m[code.indices.to_numpy(), np.searchsorted(at, i[~absent])] = p[~absent]
        ta, tb = t.column("ta")[0].as_py(), t.column("tb")[0].as_py()
        out = []
        for x in np.flatnonzero(at // TILE == ta):
            y = np.flatnonzero((at > at[x]) & (at // TILE == tb))
            s = np.abs(m[:, y] - m[:, x:x + 1]).sum(0) - len(m) * np.abs(p0[y] - p0[x])
            out.append((np.full(len(y), at[x]), at[y], s))
        a, b, s = (np.concatenate(c).astype(np.int64) for c in zip(*out))
        return pa.table([pa.array([t.column("lang")[0].as_py()] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(s)],
                        names=["lang", "a", "b", "s"])

    parts = cell.unionByName(none).groupBy("lang", "ta", "tb", "part").applyInArrow(run, "lang string, a long, b long, s long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("s").alias("s"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    every = docs.select(*names).distinct()
    counts = C.keep(scan(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                    "divergence-counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("l"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "l"))
    cells = C.keep(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
                   .select("lang", "source", "term", "n", "l"), "divergence-cells")
    langs = (cells.groupBy("lang", "term").agg(F.max("l").alias("l"))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("l").alias("nl")))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("ng"))
    total = lambda n: F.coalesce(F.col(n), F.lit(0)) + SMOOTH * F.coalesce(F.col("v"), F.lit(0))
    groups = C.keep(
        every.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .withColumn("i", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
        .select("lang", "source", "i", F.coalesce("v", F.lit(0)).alias("v"), total("ng").alias("dg"), total("nl").alias("dl"))
        .withColumn("p0", F.coalesce(share(F.lit(0), F.col("dg")), F.lit(0))), "divergence-groups")

    shares = (cells.join(groups.select("lang", "source", "i", "dg"), ["lang", "source"])
              .select("lang", "i", "term", share(F.col("n"), F.col("dg")).alias("p")))
    sums = pair_sums(shares, groups.where("v > 0").select("lang", "i", "p0", "v"))
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    left = groups.select("lang", "source", F.col("i").alias("a"), "v", F.col("p0").alias("pa"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("i").alias("b"), F.col("p0").alias("pb"))
    # the result has a row for each two sources of a lang
    pair = (left.join(right, "lang").where("a != b").join(both, ["lang", "a", "b"], "left")
            .select("lang", "source", F.lit("pair").alias("part"), "item",
                    (F.coalesce("s", F.lit(0)) + F.col("v") * F.abs(F.col("pa") - F.col("pb"))).alias("value")))

    term = (term_candidates(cells, top).join(groups.select("lang", "source", "dg", "dl"), ["lang", "source"])
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    (share(F.col("n"), F.col("dg")) - share(F.col("l"), F.col("dl"))).alias("value")).where("value > 0"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    ranked = [pair.select("*", rank), term.select("*", rank).where(F.col("rank") <= top)]
    return reduce(DataFrame.unionByName, ranked).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))


def op13(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return audit(docs)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS l FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v, sum(l)::HUGEINT AS nl FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
ng AS (SELECT lang, source, sum(n)::HUGEINT AS ng FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(ng.ng, 0) + 5 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.l + 5)) // (v.nl + 5 * v.v) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN ng USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term
                        WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
