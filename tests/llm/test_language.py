import random

import numpy as np
import pytest

from newsgraph.llm import language
from tests.llm import brute

VOCAB = {"en": "the and with from house tree".split(), "de": "der und mit vom haus baum ß".split(),
         "fr": "le et avec de maison arbre é".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


def tables(spark, extra=False):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    docs = [(i, text(rng, lang, 40), lang, "a", 0) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    docs += [(900, None, "en", "a", 0), (901, "x y", None, "a", 0), (None, "x y", "en", "a", 0), (902, "", "en", "a", 0)]
    pages, truth = [], {}
    for i in range(300):
        lang = rng.choice(["en", "de", "fr"])
        host = {"en": "a.com", "de": "b.example.de", "fr": "c.example.fr"}[lang]
        declared = lang if rng.random() < 0.8 else "en"
        n = 30 if i % 3 else 0  # a third of the pages have no text of their own
        pages.append((i, f"http://{host}/{i}", f'<html lang="{declared}"><script>the the the</script><p>{text(rng, lang, n)}</p>'))
        truth[i] = lang
    pages += [(400, None, None), (401, "", ""), (402, "http://b.example.de/", None), (None, "http://c.example.fr", "<html lang=FR>")]
    p = spark.createDataFrame(pages, "page_id long, url string, html string")
    if extra:
        for c in ("host", "ll", "q", "lang", "says", "h", "score"):
            p = p.withColumn(c, F.lit("y"))
    return p.repartition(3), brute.frame(spark, docs, extra), truth


@pytest.mark.parametrize("extra", [False, True])
def test_evidence_decides(spark, extra):
    pages, docs, truth = tables(spark, extra)
    got = language.op4(pages, docs).collect()
    assert len(got) == 304
    by = {r.page_id: r for r in got}
    right = sum(by[i].lang == lang for i, lang in truth.items())
    assert right >= 0.97 * len(truth)
    assert right > sum(by[i].text_lang == lang for i, lang in truth.items())  # host and markup help where text is missing
    assert by[402].lang == "de" and by[None].lang == "fr"
    assert all(0 <= r.posterior <= 1 for r in got)


def test_posterior_follows_bayes(spark):
    """The fused posterior of one page, by hand."""
    pages, docs, _ = tables(spark)
    langs, logp, prior = language.train(docs)
    rows = {r.page_id: r for r in language.evidence(pages, langs, logp).collect()}
    q = {}
    for i, r in rows.items():
        x = np.array(r.ll) + prior
        e = np.exp(x - x.max())
        q[i] = e / e.sum()
    own = rows[1]
    k = len(langs)
    everywhere = sum(q.values())
    p = (everywhere + 1) / (everywhere.sum() + k)
    for level in ("suffix", "domain", "host"):
        s = np.maximum(sum(q[i] for i, r in rows.items() if r[level] == own[level]) - q[1], 0)
        p = (s + language.SHRINK * p) / (s.sum() + language.SHRINK)
    same = [i for i, r in rows.items() if r.declared == own.declared]
    says = (np.maximum(sum(q[i] for i in same) - q[1], 0) + language.SHRINK * len(same) / everywhere.sum()) / (everywhere + language.SHRINK)
    x = np.array(own.ll) + np.log(p) + np.log(says)
    e = np.exp(x - x.max())
    got = {r.page_id: r for r in language.op4(pages, docs).collect()}[1]
    assert got.posterior == pytest.approx((e / e.sum()).max(), rel=1e-6)
    assert got.lang == langs[int(e.argmax())]


def test_no_training_rows_and_no_pages(spark):
    pages, docs, _ = tables(spark)
    assert {r.lang for r in language.op4(pages, docs.limit(0)).collect()} == {None}
    assert language.op4(pages.limit(0), docs).collect() == []
