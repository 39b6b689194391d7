"""Randomised parity checks against plain-Python restatements of the rules
(one Spark job per property over a few hundred generated cases)."""

import random

from pyspark.sql import functions as F

from newsgraph.functions import text as T
from newsgraph.operators import persons as P

WS = [" ", "\t", "\n", " ", " ", "　", "\x1c", "\x1f", " ", "\x85"]
LETTERS = list("abcxyzABCXYZ") + ["é", "É", "ß", "ñ", "Ö", "ø", "ł", "ǆ", "ǅ", "Ǆ", "ŉ", "ﬁ", "İ", "ı", "σ", "Σ",
                                  "ς", "ª", "º", "ʰ", "\u0301", "Ⓐ", "ⓐ", "ǰ"]
OTHERS = list("0123'-.,!?") + ["’", "“", "”", "‘", "​", "\x01", "\x7f"]


def _rand(rnd, pool, n_max=24):
    return "".join(rnd.choice(pool) for _ in range(rnd.randint(0, n_max)))


def _one_job(spark, values, col_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.r for r in df.select("i", col_fn(F.col("s")).alias("r")).orderBy("i").collect()]


def test_ws_tokens_equal_python_split(spark):
    rnd = random.Random(11)
    vals = [_rand(rnd, WS + list("ab") + ["é"]) for _ in range(300)]
    got = _one_job(spark, vals, T.ws_tokens)
    assert got == [v.split() for v in vals]


def test_title_case_equal_python_title(spark):
    rnd = random.Random(12)
    vals = [_rand(rnd, LETTERS + OTHERS + [" "]) for _ in range(2000)]
    got = _one_job(spark, vals, T.title_case)
    bad = [(v, g) for v, g in zip(vals, got) if g != v.title()]
    assert not bad, bad[:5]


def _clean_py(s):
    for a, b in {"‘": "'", "’": "'", "“": '"', "”": '"', " ": " ", "​": ""}.items():
        s = s.replace(a, b)
    return "".join(c for c in s if ord(c) >= 32)


def test_clean_json_equal_python(spark):
    rnd = random.Random(13)
    vals = [_rand(rnd, OTHERS + WS + list("ab{}\"")) for _ in range(300)]
    assert _one_job(spark, vals, T.clean_json_text) == [_clean_py(v) for v in vals]


def _html_py(s):
    from html.parser import HTMLParser

    class Pp(HTMLParser):
        skip = {"script", "style", "template", "rt", "rp"}

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.stack = [], []

        def handle_starttag(self, tag, attrs):
            self.stack.append(tag)

        def handle_endtag(self, tag):
            while self.stack:
                if self.stack.pop() == tag:
                    break

        def handle_data(self, data):
            if not (set(self.stack) & self.skip):
                self.out.append(data)

    p = Pp()
    p.feed(s)
    p.close()
    return "".join(p.out).replace("\n", "")


def test_html_to_text_equal_stdlib_parser_on_random_markup(spark):
    rnd = random.Random(14)
    parts = ["<p>", "</p>", "<b class='x'>", "</b>", "<br/>", "<!-- c -->", "<script>var a='</p>';</script>",
             "<style>p{}</style>", "&amp;", "&lt;", "&quot;", "&copy;", "\n", "word", "Ünï", " ", "<div>", "</div>",
             "<!DOCTYPE html>", "<title>T</title>"]
    vals = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 15))) for _ in range(300)]
    assert _one_job(spark, vals, T.html_to_text) == [_html_py(v) for v in vals]


def _complete_py(names):
    full = {}
    for n in names:
        parts = n.strip().split()
        if len(parts) >= 2:
            full[parts[-1]] = n
    out = []
    for n in names:
        parts = n.strip().split()
        out.append(full.get(parts[0], n) if len(parts) == 1 else n)
    return out


def test_complete_surnames_equal_python(spark):
    rnd = random.Random(15)
    first = ["Mario", "Luca", "Anna", "Elly"]
    last = ["Draghi", "Rossi", "Meloni", "Schlein", "Bianchi"]
    rows, flat = [], []
    for r in range(60):
        names = []
        for _ in range(rnd.randint(0, 5)):
            names.append(rnd.choice(last) if rnd.random() < 0.5 else f"{rnd.choice(first)} {rnd.choice(last)}")
        rows.append((r, names))
        flat.extend(names)
    df = spark.createDataFrame(rows, "row_ord long, persons array<string>")
    got = (P.complete_surnames(P.explode_persons(df)).filter(F.col("person").isNotNull())
           .orderBy("row_ord", "pos").select("person").collect())
    assert [r.person for r in got] == _complete_py(flat)
