"""Article-level projections and filters (feed normalisation, date window,
newspaper filter, keyword filter, length filter).  All native; filters on
stored columns reach the scan as pushed filters."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.functions.text import (contains_any_word, first_keyword_match,
                                      lower_tokens, parse_feed_date)

ARTICLE_COLUMNS = ("title", "newspaper", "link", "date")
MAX_TEXT_CHARS = 15000
# Literal token lists up to this size are inlined in the predicate; longer
# lists become a semi join against a DataFrame of tokens.
INLINE_TOKEN_LIMIT = 1000


def normalize_feed(items: DataFrame, keep_order: bool = True) -> DataFrame:
    """Newspaper name from the nested ``source.name``, day from the date
    text; project the article columns (plus ``row_ord``)."""
    cols = [F.col("title"), F.col("source.name").alias("newspaper"), F.col("link"),
            parse_feed_date(F.col("date")).alias("date")]
    if keep_order and "row_ord" in items.columns:
        cols.append(F.col("row_ord"))
    return items.select(*cols)


def _as_date(v) -> Column:
    if v is None:
        return None
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.strftime("%Y-%m-%d")
    return F.to_date(F.lit(v))


def date_window(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Keep rows whose day lies in ``[start, end]`` (both ends kept).
    Defaults are evaluated per query: one month before today, and today."""
    s = _as_date(start) if start is not None else F.add_months(F.current_date(), -1)
    e = _as_date(end) if end is not None else F.current_date()
    return df.filter(F.col(col).between(s, e))


def _accepted_tokens(names: Sequence[str]) -> list[str]:
    toks: list[str] = []
    seen = set()
    for n in names:
        for t in n.lower().split():
            if t not in seen:
                seen.add(t)
                toks.append(t)
    return toks


def filter_newspapers(df: DataFrame, accepted: Sequence[str] | DataFrame,
                      col: str = "newspaper", name_col: str = "name") -> DataFrame:
    """Keep a row when the lower-cased whitespace tokens of its newspaper
    name share at least one token with any accepted name.

    ``accepted`` is a list of names, or a DataFrame with a ``name_col``
    column for lists too long to inline (then a left-semi join on tokens)."""
    if isinstance(accepted, DataFrame) or len(_accepted_tokens(accepted)) > INLINE_TOKEN_LIMIT:
        if not isinstance(accepted, DataFrame):
            accepted = df.sparkSession.createDataFrame([(n,) for n in accepted], f"{name_col} string")
        acc = (accepted.select(F.explode(lower_tokens(F.col(name_col))).alias("_tok"))
               .distinct())
        # Decide per distinct newspaper name (few), then semi-join the rows.
        names = df.select(F.col(col).alias("_name")).distinct()
        ok = (names.select("_name", F.explode(lower_tokens(F.col("_name"))).alias("_tok"))
              .join(acc, "_tok", "left_semi").select("_name").distinct())
        return df.join(ok, df[col] == ok["_name"], "left_semi")
    toks = _accepted_tokens(accepted)
    if not toks:
        return df.limit(0)
    return df.filter(F.arrays_overlap(lower_tokens(F.col(col)), F.array(*[F.lit(t) for t in toks])))


def keyword_filter(df: DataFrame, col: str, words: Sequence[str],
                   keywords: Sequence[str] | None = None,
                   canonical: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose ``col`` has one of ``words`` as a whitespace token,
    then replace ``col`` by the canonical word of the first keyword (list
    order) it contains as a substring.  By default keywords = canonical =
    ``words``."""
    keywords = list(keywords if keywords is not None else words)
    canonical = list(canonical if canonical is not None else keywords)
    return (df.filter(contains_any_word(F.col(col), words))
            .withColumn(col, first_keyword_match(F.col(col), keywords, canonical)))


def length_filter(df: DataFrame, col: str = "text", max_chars: int = MAX_TEXT_CHARS,
                  pandas_compat: bool = False) -> DataFrame:
    """Keep texts shorter than ``max_chars`` characters.  A null text is
    dropped; with ``pandas_compat`` it counts as the 4-character ``"None"``
    and is kept, as the string conversion of a failed fetch is."""
    n = F.length(F.col(col))
    if pandas_compat:
        n = F.coalesce(n, F.lit(4))
    return df.filter(n < max_chars)
