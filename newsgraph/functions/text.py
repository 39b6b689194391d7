"""Scalar column functions on text.

Every function takes and returns a ``Column`` and is built from Spark's
native expressions, so it stays inside whole-stage code generation; no
Python runs per row.  Python-side helpers exist only behind explicit
options (``entities="python"`` in :func:`html_to_text`, the exact token
counter in :func:`token_count`)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_columns_once(df, **exprs):
    """Add columns evaluated exactly once per row.

    A filter on a computed column is normally pushed below the projection
    that computes it, with the expression copied into the filter, so a
    costly expression runs twice.  A generator output cannot be pushed
    through, so the columns are produced by ``inline`` of a one-element
    array."""
    row = F.struct(*[e.alias(k) for k, e in exprs.items()])
    return df.select("*", F.inline(F.array(row)))


# --------------------------------------------------------------------------
# Fixed values (must equal the behaviour being matched)
# --------------------------------------------------------------------------

# Whitespace as Python's str.split() sees it: Unicode White_Space plus the
# four information separators U+001C..U+001F.
WHITESPACE_RE = r"(?U)[\s\x{1C}-\x{1F}]+"

# Cased characters (Python's notion: Lowercase, Uppercase or Lt), runs of
# them and of the rest, and the case-ignorable characters (Mn, Me, Cf, Lm,
# Sk and the word-break MidLetter/MidNumLet/Single_Quote characters) used
# by the final-sigma rule.
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
CASED_RUN_RE = rf"([{CASED}]+|[^{CASED}]+)"
CASE_IGNORABLE = (r"\p{Mn}\p{Me}\p{Cf}\p{Lm}\p{Sk}'.:\x{00B7}\x{0387}\x{05F4}\x{2018}\x{2019}"
                  r"\x{2024}\x{2027}\x{FE13}\x{FE52}\x{FE55}\x{FF07}\x{FF0E}\x{FF1A}")
# Σ is final when, skipping case-ignorables on each side, a cased letter
# comes before it and none after it.
_CASED_ANCHOR = rf"[{CASED}&&[^{CASE_IGNORABLE}]]"
FINAL_SIGMA_RE = (rf"({_CASED_ANCHOR}[{CASE_IGNORABLE}]*+)\x{{03A3}}"
                  rf"(?![{CASE_IGNORABLE}]*+{_CASED_ANCHOR})")

# Elements whose text the HTML-to-text conversion leaves out, and the named
# character references decoded natively (``&amp;`` is decoded last).
SKIPPED_ELEMENTS = ("script", "style", "template", "rt", "rp")
NATIVE_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)

# Characters rewritten before JSON parsing: left/right single quotes to ',
# left/right double quotes to ", no-break space to a space; zero-width space
# is deleted (it has no partner in the target string of translate).
JSON_CLEAN_FROM = "\u2018\u2019\u201c\u201d\u00a0\u200b"
JSON_CLEAN_TO = "''\"\" "

# Approximate pre-token pattern for token budgets: letter runs, up to three
# digits, punctuation runs.
PRETOKEN_RE = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"

FEED_DATE_FORMAT = "M/d/yyyy"


# --------------------------------------------------------------------------
# Tokens and predicates
# --------------------------------------------------------------------------

def ws_tokens(c: ColumnOrName) -> Column:
    """Whitespace tokens as Python ``str.split()`` returns them."""
    return F.filter(F.split(_c(c), WHITESPACE_RE), lambda t: t != F.lit(""))


def lower_tokens(c: ColumnOrName) -> Column:
    return ws_tokens(F.lower(_c(c)))


def contains_any_word(c: ColumnOrName, words: Sequence[str]) -> Column:
    """True when any of ``words`` equals a whitespace token (case-sensitive)."""
    if not words:
        return F.lit(False)
    return F.arrays_overlap(ws_tokens(c), F.array(*[F.lit(w) for w in words]))


def first_keyword_match(c: ColumnOrName, keywords: Sequence[str], words: Sequence[str]) -> Column:
    """Canonical word of the first keyword (in list order) found as a
    substring; null when none is found.  A repeated keyword maps to the
    word given last for it."""
    if len(keywords) != len(words):
        raise ValueError("keywords and words must have the same length")
    mapping: dict[str, str] = {}
    for k, w in zip(keywords, words):
        mapping[k] = w
    col = _c(c)
    out = F.lit(None).cast("string")
    for k in reversed(list(mapping)):
        out = F.when(col.contains(k), F.lit(mapping[k])).otherwise(out)
    return out


# --------------------------------------------------------------------------
# HTML to text
# --------------------------------------------------------------------------

def _entity_tables():
    """Named references (HTML5, with the semicolon) and the remapped numeric
    range 0x80-0x9F, both built from the standard library."""
    import html.entities
    import json

    # named references bucketed by their first, then second character:
    # a map lookup scans its keys, so three small scans beat one of 2125
    named: dict[str, dict[str, dict[str, str]]] = {}
    for k, v in html.entities.html5.items():
        if k.endswith(";"):
            named.setdefault(k[0], {}).setdefault(k[1], {})[k] = v
    remap = {str(n): bytes([n]).decode("cp1252", errors="ignore") or "\ufffd" for n in range(0x80, 0xA0)}
    return json.dumps(named), json.dumps(remap)


def _bare_names() -> str:
    """Pattern of the references HTML5 knows without a semicolon, longest first."""
    from html.entities import html5

    names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return "^(" + "|".join(names) + ")"


def _codepoint_char(n: Column) -> Column:
    """The character of code point ``n`` for a numeric reference: C1
    controls read as Windows-1252, 0, surrogates and values above U+10FFFF
    give U+FFFD."""
    named_json, remap_json = _entity_tables()
    remap = F.from_json(F.lit(remap_json), "map<string,string>")
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "utf-32")
    bad = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    return (F.when(bad, F.lit("\ufffd"))
            .when(n.between(0x80, 0x9F), F.element_at(remap, n.cast("string")))
            .otherwise(utf32))


def unescape_entities(c: ColumnOrName) -> Column:
    """Decode character references in one pass: the text is split on ``&``
    and each piece's leading reference is looked up — named references of
    HTML5 in a map constant, decimal and hex numeric references of any
    length by code point; both also without a semicolon, the named ones that
    HTML5 allows so by their longest match.  Anything else keeps its ``&``."""
    named_json, _ = _entity_tables()
    named = F.from_json(F.lit(named_json), "map<string,map<string,map<string,string>>>")
    pieces = F.split(_c(c), "&", -1)
    bare = _bare_names()

    def lookup(name):
        bucket = F.element_at(F.element_at(named, F.substring(name, 1, 1)), F.substring(name, 2, 1))
        return F.element_at(bucket, name)

    # each step is a transform of its own, so it is evaluated once per piece
    def written(p):
        return F.struct(p.alias("p"), F.regexp_extract(
            p, r"^(#[xX][0-9a-fA-F]++;?|#[0-9]++;?|[A-Za-z][A-Za-z0-9]*+;)", 1).alias("ref"))

    def named_value(x):
        number = F.startswith(x["ref"], F.lit("#"))
        return F.struct(x["p"].alias("p"), x["ref"].alias("ref"), number.alias("number"),
                        F.when((x["ref"] != "") & ~number, lookup(x["ref"])).alias("value"))

    def longest(x):
        found = x["number"] | x["value"].isNotNull()
        ref = F.when(found, x["ref"]).otherwise(F.regexp_extract(x["p"], bare, 1))
        return F.struct(x["p"].alias("p"), ref.alias("ref"), x["number"].alias("number"), x["value"].alias("value"))

    def digits(x):
        hexed = F.startswith(x["ref"], F.lit("#x")) | F.startswith(x["ref"], F.lit("#X"))
        value = F.coalesce(x["value"], F.when((x["ref"] != "") & ~x["number"], lookup(F.concat(x["ref"], F.lit(";")))))
        return F.struct(x["p"].alias("p"), x["ref"].alias("ref"), x["number"].alias("number"), value.alias("value"),
                        hexed.alias("hexed"), F.when(x["number"], F.regexp_extract(
                            x["ref"], r"^#[xX]?0*+([0-9a-fA-F]*+)", 1)).alias("digits"))

    def code(x):
        # eight digits or more lie beyond the last code point
        n = (F.when(x["digits"] == "", F.lit("0")).when(F.length(x["digits"]) > 7, F.lit(str(0x110000)))
             .when(x["hexed"], F.conv(x["digits"], 16, 10)).otherwise(x["digits"])).cast("bigint")
        return F.struct(x["p"].alias("p"), x["ref"].alias("ref"), x["value"].alias("value"), n.alias("code"))

    def decoded(x):
        value = F.when(x["code"].isNotNull(), _codepoint_char(x["code"])).otherwise(x["value"])
        return F.when(value.isNotNull(), F.concat(value, F.substring(x["p"], F.length(x["ref"]) + 1, 1 << 30))).otherwise(
            F.concat(F.lit("&"), x["p"]))

    rest = F.slice(pieces, 2, 1 << 30)
    for step in (written, named_value, longest, digits, code, decoded):
        rest = F.transform(rest, step)
    out = F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))
    return F.when(_c(c).contains("&"), out).otherwise(_c(c))


# The rest of a tag, with quoted values taken whole.
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""


def _python_unescape(s):
    import html

    return s.map(lambda v: None if v is None else html.unescape(v))


def html_to_text(c: ColumnOrName, entities: str = "native") -> Column:
    """Text nodes of an HTML document in order, joined without separator,
    then every newline deleted.

    Comments, declarations, processing instructions and the bodies of
    script/style/template/rt/rp are left out; CDATA sections keep their
    text.  ``entities="native"`` decodes
    character references in the JVM (:func:`unescape_entities`);
    ``"common"`` only the few named ones of ``NATIVE_ENTITIES``; ``"python"``
    uses the standard library's decoder in an Arrow-batched UDF."""
    col = _c(c)
    # one pass, left to right: what opens first decides (a comment mark inside
    # a script is script, a > inside a quoted attribute is no end of a tag)
    skipped = "|".join(SKIPPED_ELEMENTS)
    col = F.regexp_replace(col, (
        r"(?is)<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)"
        rf"|<({skipped})\b{_ATTRIBUTES}>.*?(?:</\2\s*>|$)"
        rf"|<[!?][^>]*>|</?[a-z]{_ATTRIBUTES}>|</?[a-z][^>]*>"), "$1")
    if entities == "native":
        col = unescape_entities(col)
    elif entities == "common":
        for ent, ch in NATIVE_ENTITIES:
            col = F.replace(col, F.lit(ent), F.lit(ch))
    elif entities == "python":
        unescape = F.pandas_udf(_python_unescape, "string")
        col = F.when(col.contains("&"), unescape(col)).otherwise(col)
    else:
        raise ValueError(f"entities must be 'native', 'common' or 'python', not {entities!r}")
    return F.replace(col, F.lit("\n"), F.lit(""))


def html_title(c: ColumnOrName) -> Column:
    """Text of the first <title> element."""
    return html_to_text(F.regexp_extract(_c(c), r"(?is)<title[^>]*>(.*?)</title", 1))


def url_host(c: ColumnOrName) -> Column:
    return F.regexp_extract(_c(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)


# --------------------------------------------------------------------------
# Dates
# --------------------------------------------------------------------------

def parse_feed_date(c: ColumnOrName) -> Column:
    """Day from a feed date such as ``05/25/2024, 07:00 AM, +0000 UTC``: the
    text before the first comma read as month/day/year (one- or two-digit
    month and day).  Unparseable text gives null."""
    return F.try_to_date(F.split_part(_c(c), F.lit(","), F.lit(1)), FEED_DATE_FORMAT)


# --------------------------------------------------------------------------
# Braces, JSON cleaning
# --------------------------------------------------------------------------

def extract_braces(c: ColumnOrName) -> Column:
    """Outermost brace group: from the first ``{`` met at depth 0 to the
    ``}`` that brings the depth back to 0.  Not aware of strings; when no
    such group exists the result is ``{}``.

    The fold walks the braces only (with the lengths of the runs between
    them), not every character."""
    col = _c(c)
    # pieces between braces (n+1) and the braces themselves (n), zipped: each
    # step advances over one piece, then meets one brace (null after the last)
    lens = F.transform(F.split(col, "[{}]", -1), lambda x: F.length(x))
    braces = F.regexp_extract_all(col, F.lit("[{}]"), 0)
    steps = F.arrays_zip(lens.alias("l"), braces.alias("b"))
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("p"),
                    F.lit(-1).alias("s"), F.lit(-1).alias("e"))

    def step(acc, x):
        d, s, e = acc["d"], acc["s"], acc["e"]
        p = acc["p"] + x["l"]           # 0-based index of this step's brace
        live = (e < 0) & x["b"].isNotNull()
        is_open = live & (x["b"] == F.lit("{"))
        is_close = live & (x["b"] == F.lit("}"))
        nd = F.when(is_open, d + 1).when(is_close, d - 1).otherwise(d)
        ns = F.when(is_open & (d == 0), p).otherwise(s)
        ne = F.when(is_close & (d == 1), p + 1).otherwise(e)
        return F.struct(nd.alias("d"), (p + 1).alias("p"), ns.alias("s"), ne.alias("e"))

    def finish(st):
        # inside the fold, so the fold's state is computed once per row
        found = (st["s"] >= 0) & (st["e"] >= 0)
        return F.when(found, F.substring(col, st["s"] + 1, st["e"] - st["s"])).otherwise(F.lit("{}"))

    return F.coalesce(F.aggregate(steps, init, step, finish), F.lit("{}"))


def clean_json_text(c: ColumnOrName) -> Column:
    """Curly quotes to straight ones, no-break space to space, zero-width
    space and every character below U+0020 removed."""
    return F.regexp_replace(F.translate(_c(c), JSON_CLEAN_FROM, JSON_CLEAN_TO),
                            r"[\x00-\x1F]+", "")


# A double- or single-quoted string, a run without quotes, or a stray quote.
_JSON_PIECES = r"""(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|[^"']+|["'])"""


def repair_json(c: ColumnOrName) -> Column:
    """What a Python literal allows and JSON does not, mended outside
    strings: trailing commas go, ``None``/``True``/``False`` take their JSON
    spelling, typographic quotes become plain ones."""
    pieces = F.regexp_extract_all(_c(c), F.lit(_JSON_PIECES), 1)

    def mend(p):
        out = F.regexp_replace(clean_json_text(p), r",(\s*[}\]])", "$1")
        for py, js in (("None", "null"), ("True", "true"), ("False", "false")):
            out = F.regexp_replace(out, rf"\b{py}\b", js)
        quoted = (F.length(p) > 1) & (F.startswith(p, F.lit('"')) | F.startswith(p, F.lit("'")))
        return F.when(quoted, p).otherwise(out)

    return F.array_join(F.transform(pieces, mend), "")


# --------------------------------------------------------------------------
# Names
# --------------------------------------------------------------------------

def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title``: the first letter of each run of cased letters
    is title-cased, the rest lower-cased (``d'alema`` → ``D'Alema``,
    ``jean-luc 3rd`` → ``Jean-Luc 3Rd``, ``ǆa`` → ``ǅa``, ``ßa`` → ``Ssa``)."""
    # A capital sigma ending a word (judged on the whole text) becomes final
    # sigma; every other one lower-cases to σ.  Runs are then title-cased
    # on their own: first character title case, the rest lower case.
    col = _c(c)
    text = F.when(col.contains("\u03a3"), F.regexp_replace(col, FINAL_SIGMA_RE, "$1\u03c2")).otherwise(col)
    runs = F.regexp_extract_all(text, F.lit(CASED_RUN_RE), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.initcap(F.substring(r, 1, 1)), F.lower(F.replace(F.substring(r, 2, 1 << 30), F.lit("Σ"), F.lit("σ"))))), "")


# --------------------------------------------------------------------------
# Token budget
# --------------------------------------------------------------------------

def pretoken_count(c: ColumnOrName) -> Column:
    """Approximate token count (pre-token pieces), native."""
    return F.regexp_count(_c(c), F.lit(PRETOKEN_RE)).cast("bigint")


def token_count(c: ColumnOrName, encoder_factory: Callable | None = None) -> Column:
    """Token count.  With ``encoder_factory`` (returns an object with
    ``encode(str) -> list``, e.g. a BPE encoder whose vocabulary is
    available on the executors) the count is exact, computed in an
    Arrow-batched UDF with one encoder per task; without it the native
    approximation :func:`pretoken_count` is used."""
    if encoder_factory is None:
        return pretoken_count(c)

    import pandas as pd

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder_factory()
        for s in batches:
            yield s.map(lambda v: None if v is None else len(enc.encode(v))).astype("Int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(count, "bigint")(_c(c))
