"""Person names: explode, title-case, complete bare surnames, regroup.

The work on names runs on a narrow table ``(row_ord, pos, person)``; the
wide article columns (long text) are not copied once per person.  Every
"last one wins" rule is ``max_by(value, struct(row_ord, pos))``, which
aggregates partially on the map side, so a surname shared by a third of
all rows still leaves one row per surname and map task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.functions.text import title_case, ws_tokens
from newsgraph.session import materialize

REGROUP_KEYS = ("title", "newspaper", "link", "date", "text", "topics")


def explode_persons(df: DataFrame, order_col: str = "row_ord", col: str = "persons",
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per person with its position; an empty or null list keeps
    one row with null ``pos`` and ``person``.  ``list_state`` records which
    (``empty``/``null``/``some``) for the pandas-compatible spelling."""
    state = (F.when(F.col(col).isNull(), F.lit("null"))
             .when(F.size(col) == 0, F.lit("empty")).otherwise(F.lit("some")))
    return df.select(*keep, order_col, state.alias("list_state"),
                     F.posexplode_outer(col).alias("pos", "person"))


def title_persons(persons: DataFrame, pandas_compat: bool = False) -> DataFrame:
    """Title-case names as Python's ``str.title``.  With ``pandas_compat``
    an empty list becomes ``"Nan"`` and a null list or null entry ``"None"``
    (the string spelling of the missing values), else they stay null."""
    name = F.col("person")
    if pandas_compat:
        name = (F.when(F.col("list_state") == "empty", F.lit("nan"))
                .when(name.isNull(), F.lit("None")).otherwise(name))
    return persons.withColumn("person", title_case(name))


def complete_surnames(persons: DataFrame, order_cols: Sequence[str] = ("row_ord", "pos")) -> DataFrame:
    """Replace a one-word name by the full name (two or more words) that
    ends with it, taking the last such full name over all rows; other names
    stay as they are.  Case-sensitive."""
    toks = ws_tokens(F.col("person"))
    order = F.struct(*[F.col(c) for c in order_cols])
    tagged = persons.withColumn("_ntok", F.size(toks)).withColumn("_last", F.element_at(toks, -1))
    full = (tagged.filter(F.col("_ntok") >= 2)
            .groupBy(F.col("_last").alias("_surname"))
            .agg(F.max_by("person", order).alias("_full")))
    # only one-word names can match: the others do not enter the join
    single = tagged.filter(F.col("_ntok") == 1).join(full, F.col("_last") == F.col("_surname"), "left")
    single = single.withColumn("person", F.coalesce(F.col("_full"), F.col("person")))
    rest = tagged.filter((F.col("_ntok") != 1) | F.col("_ntok").isNull())
    return single.select(*persons.columns).unionByName(rest.select(*persons.columns))


def regroup_persons(articles: DataFrame, persons: DataFrame, keys: Sequence[str] = REGROUP_KEYS,
                    order_col: str = "row_ord", keep_order: bool = False) -> DataFrame:
    """One row per distinct article key with its persons in row order
    (duplicates kept).  A row with a null key is dropped.  Null persons
    (from empty lists) are left out, so such an article has an empty list.

    Two steps keep the wide columns out of the per-person shuffle: persons
    are first gathered per source row (narrow), then the per-row lists are
    concatenated per article key in row order."""
    per_row = (persons.groupBy(order_col)
               .agg(F.array_sort(F.collect_list(
                   F.when(F.col("person").isNotNull(), F.struct("pos", "person")))).alias("_p"))
               .select(order_col, F.transform("_p", lambda x: x["person"]).alias("_plist")))
    rows = articles.select(*keys, order_col).dropna(subset=list(keys))
    joined = rows.join(per_row, order_col, "left")
    grouped = joined.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                             F.coalesce("_plist", F.array().cast("array<string>")).alias("l"))))
        .alias("_lists"))
    order = [F.col("_lists")[0]["o"].alias(order_col)] if keep_order else []
    return grouped.select(*keys, F.flatten(F.transform("_lists", lambda x: x["l"])).alias("persons"), *order)


def numbered(articles: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """``articles`` as a written table whose ``order_col`` is unique and
    keeps the rows' order (rows that share a place, or have none, follow
    their key columns): one range sort, then a row number per partition."""
    ties = [c for c in REGROUP_KEYS if c in articles.columns and c != "text"]
    ordered = articles.orderBy(F.col(order_col).asc_nulls_last(), *ties)
    return materialize(ordered.withColumn(order_col, F.monotonically_increasing_id()), "numbered")


def process_persons(articles: DataFrame, keys: Sequence[str] = REGROUP_KEYS, order_col: str = "row_ord",
                    pandas_compat: bool = False, sort_keys: bool = False) -> DataFrame:
    """Number the rows → explode → title-case → complete surnames (over all
    rows, null keys included) → regroup; each article carries the smallest
    number of its rows as ``order_col``.  ``sort_keys`` orders the result by
    the keys, as a sorted grouping returns it (a range-partitioned sort)."""
    articles = numbered(articles, order_col)
    p = explode_persons(articles, order_col)
    p = title_persons(p, pandas_compat)
    p = complete_surnames(p, (order_col, "pos"))
    out = regroup_persons(articles, p, keys, order_col, keep_order=True)
    return out.orderBy(*keys) if sort_keys else out
