import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsgraph.llm import divergence
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, min_docs=30, top=50):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        w = TERM.findall((text or "").translate(brute.LOW))
        counts[lang or "", source or ""].update(w)
        docs[lang or ""].update(set(w))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for x, s in counts if x == lang]
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}

        def p(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // total for t in kept}

        ps, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in sources if o != s]
            found = [(ps[s][t] - q[t], t) for t in kept if counts[lang, s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", found, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(items[:most])]
    return sorted(out)


def corpus():
    rng = random.Random(8)
    rows = brute.messy_documents()
    words = [w + x for w in "der die une été x ß Ña the of".split() for x in ("", "a", "ö", "ing", "s", "en")]
    for i in range(1500):
        source = rng.choice(["hot", "hot", "hot", "a", "b", "", None, "é"])
        own = words if source == "hot" else words[len(source or "zz"):]
        rows.append((5000 + i, ", ".join(rng.choice(own) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None]), source, 0))
    return rows + [(1, "only here", "xx", "alone", 0), (2, None, "yy", "s1", 0), (3, "", "yy", None, 0)]


@pytest.mark.parametrize("small", [False, True])
def test_audit_matches_brute_force(spark, monkeypatch, small):
    if small:  # several tiles, parts and merges
        monkeypatch.setattr(divergence, "TILE", 2)
        monkeypatch.setattr(divergence, "PART_TERMS", 10)
        monkeypatch.setattr(divergence, "_CHUNK", 4)
    rows = corpus()
    top = 7 if small else divergence.TOP
    got = divergence.audit(brute.frame(spark, rows, extra=not small), top=top).collect()
    assert sorted(map(tuple, got)) == expected(rows, top=top)
    assert {r.part for r in got} == {"pair", "term"}


def test_skyband_is_exact():
    rng = np.random.default_rng(3)
    for n, k in ((0, 3), (1, 1), (300, 1), (700, 5), (900, 50)):
        g, low, order = rng.integers(0, 12, n), rng.integers(0, 40, n), rng.permutation(n)
        dom = (g[None] >= g[:, None]) & (low[None] <= low[:, None]) & (order[None] < order[:, None])
        assert sorted(divergence.skyband(g, low, order, k)) == np.flatnonzero(dom.sum(1) < k).tolist()


def test_shares_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10 ** 12), rng.randrange(1, 9 * 10 ** 15)) for _ in range(200)] + [(0, 1), (3, 7), (5, 0)]
    from pyspark.sql import functions as F

    got = spark.createDataFrame(rows, "c long, t long").select("c", "t", divergence.share(F.col("c"), F.col("t")).alias("p")).collect()
    assert all(r.p == (1 + 10 ** 9 * (r.c + 5) // r.t if r.t else None) for r in got)


def test_empty_table(spark):
    assert divergence.op13(brute.frame(spark, []).coalesce(1)).collect() == []
