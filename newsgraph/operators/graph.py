"""Typed graph of newspapers, topics and persons as node and edge tables.

One scan of the article table is expanded into endpoint rows
``(row_ord, rel_idx, end, id, type)`` — one per row, relationship and end
— and every table is an aggregation of it: frequencies (count), node type
(last written wins: ``max_by`` over (row, relationship, end)), multi-edges
(count per (src, dst, relationship)) and simple undirected edges (last
relationship per unordered pair).  All aggregations combine on the map
side, so a node that touches a third of all rows costs one partial row per
map task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYOUTS = ("random_layout", "layered_layout", "triangle_layout")  # no spring solver: a position it did not solve is refused
# Fixed display values: layered y step, triangle shifts per type rank, size scale.
LAYER_STEP = 1.5
TRIANGLE_SHIFTS = ((-1.0, -1.0), (1.0, -1.0), (0.0, 1.0))
SIZE_BASE, SIZE_SCALE = 200.0, 2000.0


class LayoutError(ValueError):
    def __init__(self, layout: str):
        super().__init__(f"no layout is called {layout!r}; choose one of {', '.join(LAYOUTS)}")
        self.layout = layout


@dataclass(frozen=True)
class Relationship:
    source: str
    target: str
    relationship: str


def as_relationships(rels) -> list[Relationship]:
    out = []
    for r in rels:
        if isinstance(r, Relationship):
            out.append(r)
        elif isinstance(r, dict):
            out.append(Relationship(r["source"], r["target"], r["relationship"]))
        else:
            out.append(Relationship(*r))
    return out


def node_types(relationships) -> list[str]:
    """Column names used as an end of a relationship, in order of first use."""
    seen: list[str] = []
    for r in as_relationships(relationships):
        for c in (r.source, r.target):
            if c not in seen:
                seen.append(c)
    return seen


def explode_array_columns(df: DataFrame, columns: Sequence[str], order_col: str = "row_ord") -> DataFrame:
    """Rows with one element per array column used by the graph, in the
    order an explode of the table gives: (row, element position).  An empty
    or null list keeps one row with a null value."""
    arrays = [c for c in columns if isinstance(df.schema[c].dataType, T.ArrayType)]
    out, places = df, []
    for c in arrays:
        out = (out.select("*", F.posexplode_outer(c).alias(f"_{c}_pos", f"_{c}_val"))
               .drop(c).withColumnRenamed(f"_{c}_val", c)
               .withColumn(f"_{c}_pos", F.coalesce(F.col(f"_{c}_pos"), F.lit(0))))
        places.append(f"_{c}_pos")
    return out.withColumn(order_col, F.struct(F.col(order_col), *[F.col(p) for p in places])).drop(*places)


def endpoints(df: DataFrame, relationships, order_col: str = "row_ord") -> DataFrame:
    """``(row_ord, rel_idx, end, id, type, relationship, other)``: both ends
    of every relationship of every row.  A pair with a null end is left
    out entirely."""
    rels = as_relationships(relationships)
    cols = sorted({c for r in rels for c in (r.source, r.target)})
    base = explode_array_columns(df.select(order_col, *cols), cols, order_col)
    pairs = F.array(*[
        F.struct(F.lit(i).alias("rel_idx"), F.lit(r.relationship).alias("relationship"),
                 F.col(r.source).cast("string").alias("src"), F.lit(r.source).alias("src_type"),
                 F.col(r.target).cast("string").alias("dst"), F.lit(r.target).alias("dst_type"))
        for i, r in enumerate(rels)])
    p = base.select(order_col, F.explode(pairs).alias("p")).select(order_col, "p.*")
    return p.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())


def _ends(pairs: DataFrame, order_col: str) -> DataFrame:
    ends = F.array(
        F.struct(F.lit(0).alias("end"), F.col("src").alias("id"), F.col("src_type").alias("type")),
        F.struct(F.lit(1).alias("end"), F.col("dst").alias("id"), F.col("dst_type").alias("type")))
    return pairs.select(order_col, "rel_idx", F.explode(ends).alias("e")).select(order_col, "rel_idx", "e.*")


def node_frequencies(pairs: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """Each row × relationship adds one to both ends (a self-pair adds two)."""
    return _ends(pairs, order_col).groupBy("id").agg(F.count(F.lit(1)).alias("freq"))


def nodes(pairs: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """``(id, type, freq)``: one node per distinct value; the type written
    last (row, then relationship, then source before target) wins."""
    e = _ends(pairs, order_col)
    order = F.struct(F.col(order_col), F.col("rel_idx"), F.col("end"))
    return e.groupBy("id").agg(F.max_by("type", order).alias("type"), F.count(F.lit(1)).alias("freq"))


def edges_multi(pairs: DataFrame) -> DataFrame:
    """Every ``(src, dst, relationship)`` with the number of rows giving it."""
    return pairs.groupBy("src", "dst", "relationship").agg(F.count(F.lit(1)).alias("n"))


def edges_simple(pairs: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """One undirected edge per unordered pair (self-loops kept); the
    relationship written last wins."""
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    order = F.struct(F.col(order_col), F.col("rel_idx"))
    return (pairs.groupBy(a.alias("src"), b.alias("dst"))
            .agg(F.max_by("relationship", order).alias("relationship")))


def edge_labels(simple: DataFrame) -> DataFrame:
    """``(src, dst) → relationship`` for drawing."""
    return simple.select("src", "dst", F.col("relationship").alias("label"))


@dataclass
class ArticleGraph:
    """Node and edge tables built from a table and a relationship list
    (each relationship names a source column, a target column and a label).
    Array columns (persons) are exploded first."""
    nodes: DataFrame
    edges_simple: DataFrame
    edges_multi: DataFrame
    node_types: list[str]

    @classmethod
    def build(cls, df: DataFrame, relationships, order_col: str = "row_ord") -> ArticleGraph:
        pairs = endpoints(df, relationships, order_col)
        return cls(nodes(pairs, order_col), edges_simple(pairs, order_col), edges_multi(pairs),
                   node_types(relationships))

    def node_sizes(self) -> DataFrame:
        return node_sizes(self.nodes)

    def display(self, layout: str = "random_layout") -> DataFrame:
        return display_attributes(self.nodes, self.node_types, layout)


def node_sizes(nodes_df: DataFrame) -> DataFrame:
    """Drawing size ``200 + freq / max(freq) * 2000``.  The maximum is a
    scalar subquery (computed once, inlined as a value), not a window over
    the whole table."""
    mx = nodes_df.select(F.max("freq")).scalar()
    return nodes_df.withColumn("size", F.lit(SIZE_BASE) + F.col("freq") / mx * F.lit(SIZE_SCALE))


def display_attributes(nodes_df: DataFrame, types: Sequence[str], layout: str = "random_layout") -> DataFrame:
    """Per node: colour index (rank of its type), a base position in
    [0, 1)² from a hash of the id, and the layout offset of its type
    (layered: ``(0, (rank+1)*1.5)``; triangle: one of three corners)."""
    if layout not in LAYOUTS:
        raise LayoutError(layout)
    types = list(types)
    if layout == "triangle_layout" and len(types) > len(TRIANGLE_SHIFTS):
        raise ValueError(f"triangle_layout takes at most {len(TRIANGLE_SHIFTS)} node types")
    rows = []
    for i, t in enumerate(types):
        if layout == "layered_layout":
            dx, dy = 0.0, (i + 1) * LAYER_STEP
        elif layout == "triangle_layout":
            dx, dy = TRIANGLE_SHIFTS[i]
        else:
            dx, dy = 0.0, 0.0
        rows.append((t, i, dx, dy))
    # One row per node type: bounded by the relationship list, safe to broadcast.
    tt = nodes_df.sparkSession.createDataFrame(rows, "_type string, color_idx int, dx double, dy double")
    scale = F.lit(float(1 << 52))
    bx = F.xxhash64("id").bitwiseAND(F.lit((1 << 52) - 1)) / scale
    by = F.xxhash64(F.concat(F.lit("y:"), F.col("id"))).bitwiseAND(F.lit((1 << 52) - 1)) / scale
    out = nodes_df.join(F.broadcast(tt), nodes_df["type"] == tt["_type"], "left").drop("_type")
    return out.withColumn("x", bx + F.col("dx")).withColumn("y", by + F.col("dy"))
