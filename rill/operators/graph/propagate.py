"""A vertex-program loop (initial state, message, merge, update).

With ``only_changed`` each superstep joins the *frontier* -- the vertices whose
value changed in the step before -- to their out-edges; vertices that did not
change cost no edge rows.  Messages are merged per destination by one
aggregate, together with the old values.  Every step's state is stored in the
shared checkpoint folder and the state before is deleted, so a lost executor
replays one step.

The edges lie in buckets by source vertex, and a step shuffles the senders and their
messages, never an edge.  A vertex with very many out-edges is no hot key: its edges are dealt into parts
of ``SPLIT`` and its value is sent to each part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.operators.graph.core import split_hubs, to_parts
from rill.session import cut_lineage, release, store_bucketed


MERGES: dict[str, Callable[[Column], Column]] = {
    "max": F.max, "min": F.min, "sum": F.sum,
}


def propagate(edges: DataFrame, state: DataFrame,
              message: Callable[[Column, DataFrame], Column],
              merge: str | Callable[[Column], Column],
              update: Callable[[Column, Column], Column],
              max_iter: int | None = None, only_changed: bool = True) -> DataFrame:
    """Run a vertex program over ``edges (src, dst, ...)``.

    ``state`` holds ``id, value``.  ``message(src_value, edge_row)`` gives the
    message a source sends along an edge (``edge_row`` exposes the edge
    columns); ``merge`` folds messages per destination; ``update(old, msg)``
    gives the new value of a vertex that received messages.  With
    ``only_changed`` only vertices whose value changed send in the next
    step (Pregel); otherwise every vertex sends every step (repeated
    neighbour aggregation).  Runs until no value changes; ``max_iter`` asks for
    the state after that many steps instead.  Returns the final ``id, value``.
    """
    merge_fn = MERGES[merge] if isinstance(merge, str) else merge
    parts, hubs = split_hubs(edges)
    e = store_bucketed(parts, ["src", "src_part"])
    release(parts)
    vtype = state.schema["value"].dataType
    state = cut_lineage(state.select("id", "value", F.lit(True).alias("changed")))
    mtype, step = None, 0
    while max_iter is None or step < max_iter:
        step += 1
        senders = state.where("changed") if only_changed else state
        # the vertices of a bucket are hashed, so that its edges need no sort
        rows = to_parts(senders.select("id", "value"), hubs).hint("shuffle_hash")
        trip = e.join(rows, (F.col("id") == F.col("src")) & (F.col("part") == F.col("src_part")))
        sent = trip.select(F.col("dst").alias("id"), message(F.col("value"), trip).alias("msg"))
        mtype = mtype or sent.schema["msg"].dataType
        rows = state.select("id", F.col("value").alias("self"), F.lit(True).alias("own"), F.lit(None).cast(mtype).alias("msg"))
        rows = rows.unionByName(sent.select("id", F.lit(None).cast(vtype).alias("self"), F.lit(False).alias("own"), "msg"))
        agg = rows.groupBy("id").agg(F.max("self").alias("old"), F.max("own").alias("own"), merge_fn(F.col("msg")).alias("msg"))
        value = F.when(F.col("msg").isNull(), F.col("old")).otherwise(update(F.col("old"), F.col("msg")))
        agg = agg.where("own")
        prev, state = state, cut_lineage(agg.select("id", value.alias("value"), (~value.eqNullSafe(F.col("old"))).alias("changed")))
        release(prev)
        # a step without any change is a fixpoint: later steps change nothing
        if state.where("changed").isEmpty():
            break
    release(e)
    release(hubs)
    return state.select("id", "value")
