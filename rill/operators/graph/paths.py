"""Longest distance from any root of a DAG.

Both are instances of the vertex program in ``propagate``: every vertex
starts at 0 and sends ``value + 1`` along its out-edges; messages merge by
``max``.  G16 is Pregel-style (only vertices whose value changed send);
G17 re-aggregates all neighbours every round until the values stop
changing.  Both end with the length of the longest path ending at each
vertex.  The graph must have no cycle: on one the distances never settle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.operators.graph.core import vertices_of
from rill.operators.graph.propagate import propagate


def longest_distance(edges: DataFrame, pregel: bool = True, max_iter: int | None = None) -> DataFrame:
    """``id, distance`` for every vertex touching an edge (with ``max_iter``:
    the distances after that many rounds)."""
    state = vertices_of(edges).select("id", F.lit(0).cast("long").alias("value"))
    e = edges.select("src", "dst").distinct()      # parallel edges carry the same message
    out = propagate(e, state,
                    message=lambda src_value, _edge: src_value + 1,
                    merge="max",
                    update=lambda old, msg: F.greatest(old, msg),
                    max_iter=max_iter, only_changed=pregel)
    return out.select("id", F.col("value").alias("distance"))
