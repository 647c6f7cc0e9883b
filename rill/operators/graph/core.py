"""Graph basics on edge/vertex DataFrames: counts, degrees, subgraphs.

A graph is an edge DataFrame ``(src, dst, ...)`` and, where vertex
attributes matter, a vertex DataFrame ``(id, ...)``.  Every operator here
is one or two aggregates or semi joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.session import cut_lineage


def vertices_of(edges: DataFrame) -> DataFrame:
    """Distinct vertex ids touching an edge (``id``)."""
    return (edges.select(F.col("src").alias("id"))
            .unionByName(edges.select(F.col("dst").alias("id"))).distinct())


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def _vertex_degrees(edges: DataFrame) -> DataFrame:
    """``id, out_deg, in_deg`` from one scan: every edge yields its source
    and its target once, then one aggregate per vertex."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("d")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("d")))).alias("x"))
    return ends.groupBy("x.id").agg(F.sum("x.s").alias("out_deg"), F.sum("x.d").alias("in_deg"))


def max_degree_vertex(edges: DataFrame) -> DataFrame:
    """The vertex with the largest in-degree and the one with the
    largest out-degree (ties: smaller id), as rows ``kind, id, degree``.

    One scan and two aggregates: per-vertex degrees, then both arg-maxes as
    ``max`` of (degree, -id) structs -- no sort of all vertices."""
    deg = _vertex_degrees(edges)
    best = deg.agg(
        F.max(F.when(F.col("in_deg") > 0, F.struct(F.col("in_deg").alias("degree"),
                                                   (-F.col("id")).alias("neg")))).alias("i"),
        F.max(F.when(F.col("out_deg") > 0, F.struct(F.col("out_deg").alias("degree"),
                                                    (-F.col("id")).alias("neg")))).alias("o"))
    rows = best.select(F.explode(F.array(
        F.struct(F.lit("in").alias("kind"), F.col("i").alias("b")),
        F.struct(F.lit("out").alias("kind"), F.col("o").alias("b")))).alias("r"))
    return (rows.where(F.col("r.b").isNotNull())
            .select(F.col("r.kind").alias("kind"), (-F.col("r.b.neg")).alias("id"),
                    F.col("r.b.degree").cast("long").alias("degree")))


def drop_isolated(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Keep only vertices touching at least one edge (semi joins)."""
    touched = vertices_of(edges)
    return vertices.join(touched, "id", "left_semi")


def induced_subgraph(edges: DataFrame, keep: DataFrame) -> DataFrame:
    """Edges with both ends in ``keep`` (a DataFrame of ``id``).

    Two semi joins; the vertex predicate already implies the edge
    predicate, so nothing else is tested.
    """
    k = keep.select("id").distinct()
    return (edges.join(k.withColumnRenamed("id", "src"), "src", "left_semi")
            .join(k.withColumnRenamed("id", "dst"), "dst", "left_semi"))


def graph_summary(edges: DataFrame) -> DataFrame:
    """G3/K11 in one scan: every edge yields its source and its target once;
    one aggregate per vertex, then one global aggregate, give the vertex,
    source-vertex, target-vertex and edge counts (one row)."""
    per_vertex = _vertex_degrees(edges)
    return per_vertex.agg(F.count(F.lit(1)).alias("vertices"),
                          F.count_if(F.col("out_deg") > 0).alias("sources"),
                          F.count_if(F.col("in_deg") > 0).alias("targets"),
                          F.sum("out_deg").cast("long").alias("edges"))


#: Out-edges of a vertex that are joined as one part.
SPLIT = 100_000


def split_hubs(edges: DataFrame, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """The edges, stored with a ``src_part``, and the vertices of more than one
    part (``hub, parts``).  A vertex of out-degree d has ``ceil(d / split)``
    parts, to which its edges are dealt by a hash."""
    degree = edges.groupBy(F.col("src").alias("hub")).agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > split)
    hubs = cut_lineage(degree.select("hub", F.ceil(F.col("d") / F.lit(split)).cast("int").alias("parts")))
    e = edges.join(hubs, F.col("src") == F.col("hub"), "left")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    return cut_lineage(e.withColumn("src_part", part).drop("hub", "parts")), hubs


def to_parts(values: DataFrame, hubs: DataFrame) -> DataFrame:
    """``values (id, ...)`` with a row for each part of the vertex (``part``)."""
    rows = values.join(hubs, F.col("id") == F.col("hub"), "left")
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("hub", "parts")
