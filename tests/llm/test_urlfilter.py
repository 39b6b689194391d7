import random

import pytest

from newsgraph.llm import urlfilter
from tests.llm import brute


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path] or [len(path)])
    return rest[:cut].translate(brute.LOW), path[:end]


def judge(url, rules):
    host, path = split(url)
    fits = [(r[0].count("."), len(r[1]), r) for r in rules
            if r[0] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1] or "")]
    if not host or not fits:
        return host, path, None, "allow"
    r = max(fits, key=lambda x: x[:2])[2]
    return host, path, r[0] + (r[1] or ""), r[2]


URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://anet/", "ftp://example.net/en/",
        "https://x.example.net/en/?q=/de/", "https://example.net/en", "http://example.com/de/a#b", "http://example.com?/de/",
        "http://a.b.org/fr/", "http://org/fr/x://y.net/", "http://éx.net/ü", "http://a..net/", "http://.net/", "http://net./",
        "http://a\0b.net/\1x", "http://" + "s." * 300 + "net/" + "p" * 5000, "x\ny://www.example.com/de/\nz"]


def pages(spark, urls, extra=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i if i % 9 else None, u, "h") for i, u in enumerate(urls)], "page_id long, url string, html string")
    if extra:
        for c in ("host", "path", "key", "rule", "level", "part"):
            df = df.withColumn(c, F.lit("y"))
    return df.repartition(3)


@pytest.mark.parametrize("extra", [False, True])
def test_given_rules(spark, extra):
    rng = random.Random(1)
    urls = URLS + [f"http://{rng.choice(['', 'w.', 'a.b.'])}{rng.choice(['example.net', 'example.com', 'x.org', 'net', 'io'])}"
                   f"{rng.choice(['', '/', '/en/', '/de/x', '/fr/', '/fr'])}" for _ in range(200)] + ["http://hot.net/same"] * 100
    got = urlfilter.op6(pages(spark, urls, extra)).collect()
    want = [judge(u, urlfilter.RULES) for u in urls]
    assert sorted((r.host, r.path, r.rule, r.verdict) for r in got if r.rule) == sorted(w for w in want if w[2])
    assert sorted((r.host, r.path, r.verdict) for r in got if not r.rule) == sorted((w[0], w[1], w[3]) for w in want if not w[2])
    assert len(got) == len(urls) and sum(r.page_id is None for r in got) == len(range(0, len(urls), 9))


def test_many_nested_rules(spark):
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "org", "x.org"]
    rules = list({(rng.choice(hosts), rng.choice(["", "/", "/a", "/a/b", "/a/b/c", "/z"])): 0 for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"http://{rng.choice(['', 'q.', 'c.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/ab', '/a/b/c/d', '/z/'])}" for _ in range(400)]
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block")], "host string, path string, action string")
    got = urlfilter.op6(pages(spark, urls), table).collect()
    assert sorted((r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted(
        (h, p, str(rule), v) for h, p, rule, v in (judge(u, rules) for u in urls))


def test_empty_tables(spark):
    assert urlfilter.op6(pages(spark, URLS).limit(0)).collect() == []
    none = spark.createDataFrame([], "host string, path string, action string")
    assert {r.verdict for r in urlfilter.op6(pages(spark, URLS), none).collect()} == {"allow"}
