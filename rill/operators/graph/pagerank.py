"""PageRank variants as DataFrame loops.

Each round is ``edges ⋈ ranks`` on ``src`` followed by a sum per ``dst``.
The edges are stored once with their weights; a vertex with very many
out-edges is dealt into parts (``core.split_hubs``) and its rank sent to each,
so that it is no hot key.  Lineage is cut with reliable checkpoints every few rounds, so a lost
executor replays at most those rounds.

``residual_pagerank`` runs to a tolerance instead of a number of rounds: mass
that a vertex received and did not hand on is its residual, and only vertices
with a residual above the tolerance take part in a round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rill.operators.graph.core import split_hubs, to_parts
from rill.session import cut_lineage, release, store_bucketed


def _weighted_edges(edges: DataFrame) -> DataFrame:
    outdeg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg"))
    return edges.select("src", "dst").join(outdeg, "src")


def pagerank(edges: DataFrame, rounds: int = 10, damping: float = 0.85,
             partitions: int | None = None, checkpoint_every: int = 4) -> DataFrame:
    """The classic adjacency-list PageRank.

    Start: rank 1 for every vertex with out-links.  Each round a vertex gets
    ``(1 - d) + d * Σ rank(u) / outdeg(u)`` over its in-links from ranked
    vertices; the join is inner, so a vertex nobody links to (or only
    unranked vertices link to) drops out, and rank of dangling vertices is
    lost.  Duplicate edges count.  ``partitions`` stores the edges as a table of
    so many buckets by ``src`` (the co-partitioned variant): a round then moves
    ranks and sums, never an edge.
    """
    e, hubs = split_hubs(_weighted_edges(edges))
    if partitions:
        return _bucketed_pagerank(e, hubs, rounds, damping, partitions, checkpoint_every)
    stored = e
    ranks = e.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    ranks_cut = None
    base = 1.0 - damping
    for i in range(rounds):
        contrib = e.join(to_parts(ranks, hubs), (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part")))
        contrib = contrib.select("dst", (F.col("rank") / F.col("outdeg")).alias("c"))
        ranks = (contrib.groupBy(F.col("dst").alias("id"))
                 .agg((F.lit(base) + F.lit(damping) * F.sum("c")).alias("rank")))
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
            prev, ranks = ranks_cut, cut_lineage(ranks)
            ranks_cut = ranks
            release(prev)
    done = cut_lineage(ranks)
    for used in (ranks_cut, stored, hubs):
        release(used)
    return done


def _bucketed_pagerank(weighted: DataFrame, hubs: DataFrame, rounds: int, damping: float, partitions: int,
                       checkpoint_every: int) -> DataFrame:
    """``pagerank`` over edges in buckets by (src, src_part).

    Without hubs the buckets are by ``src`` alone.  With as many buckets as the
    session has shuffle partitions, the sums per vertex that a round ends with
    already lie as the next round's join wants them: one exchange per round.  With
    another number Spark deals the sums out once more, still no edge."""
    plain = hubs.isEmpty()
    keys = ["src"] if plain else ["src", "src_part"]
    e = store_bucketed(weighted, keys, partitions)
    release(weighted)
    base = 1.0 - damping
    ranks = e.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    ranks_cut = None
    for i in range(rounds):
        if plain:
            contrib = e.join(ranks, F.col("src") == F.col("id"))
        else:
            rows = to_parts(ranks, hubs).repartition(partitions, "id", "part")
            contrib = e.join(rows, (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part")))
        contrib = contrib.select(F.col("dst").alias("id"), (F.col("rank") / F.col("outdeg")).alias("c"))
        ranks = contrib.groupBy("id").agg((F.lit(base) + F.lit(damping) * F.sum("c")).alias("rank"))
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
            previous, ranks = ranks_cut, cut_lineage(ranks)
            ranks_cut = ranks
            release(previous)
    done = cut_lineage(ranks)
    for used in (ranks_cut, e, hubs):
        release(used)
    return done


def personalized_pagerank(edges: DataFrame, source: int, rounds: int = 20,
                          reset: float = 0.15, tol: float | None = None,
                          checkpoint_every: int = 5) -> DataFrame:
    """Rank personalised to one source vertex.

    ``r0 = 1`` at the source, 0 elsewhere; each round
    ``r(v) = reset * [v = source] + (1 - reset) * Σ r(u) / outdeg(u)``.
    Runs ``rounds`` rounds, or stops earlier once the largest change is
    below ``tol`` (when given).  No normalisation.  Only vertices with a
    positive rank are returned.  The edges lie in buckets by source vertex, so a
    round shuffles ranks and sums, never an edge.
    """
    weighted, hubs = split_hubs(_weighted_edges(edges))
    e = store_bucketed(weighted, ["src", "src_part"])
    release(weighted)
    spark = edges.sparkSession
    src_row = spark.range(1).select(F.lit(source).cast("long").alias("id"))
    ranks = src_row.withColumn("rank", F.lit(1.0))
    ranks_cut = None
    for i in range(rounds):
        rows = to_parts(ranks, hubs).hint("shuffle_hash")            # so the edges need no sort
        contrib = e.join(rows, (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part")))
        contrib = contrib.select(F.col("dst").alias("id"), (F.col("rank") / F.col("outdeg")).alias("c"))
        reset_row = src_row.withColumn("c", F.lit(0.0))
        summed = contrib.unionByName(reset_row).groupBy("id").agg(F.sum("c").alias("s"))
        new = summed.select("id", (F.when(F.col("id") == F.lit(source), F.lit(reset))
                                   .otherwise(F.lit(0.0))
                                   + F.lit(1.0 - reset) * F.col("s")).alias("rank"))
        if tol is not None:
            delta = (new.join(ranks.withColumnRenamed("rank", "old"), "id", "full_outer")
                     .agg(F.max(F.abs(F.coalesce("rank", F.lit(0.0))
                                      - F.coalesce("old", F.lit(0.0)))).alias("d"))
                     .first()["d"])
            ranks = new
            if delta is not None and delta < tol:
                break
        else:
            ranks = new
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
            prev, ranks = ranks_cut, cut_lineage(ranks)
            ranks_cut = ranks
            release(prev)
    done = cut_lineage(ranks)
    for used in (ranks_cut, e, hubs):
        release(used)
    return done


@dataclass
class ResidualRank:
    """Result of ``residual_pagerank``."""
    ranks: DataFrame        # id, rank
    rounds: int
    residual: float         # the largest that is left, not above the tolerance
    pushed: list[int]       # vertices that handed on their residual, per round


def residual_pagerank(edges: DataFrame, source: int, tol: float = 0.01, reset: float = 0.15) -> ResidualRank:
    """Rank personalised to ``source``, to the tolerance ``tol``.

    A vertex has a total (all that it received; 1 at the source to begin with)
    and a residual (what of it was not handed on).  In a round every vertex whose
    residual is above ``tol`` hands ``1 - reset`` of it to its out-neighbours in
    equal parts and keeps none; rounds go on until no residual is above ``tol``.
    ``rank = reset * total``, which is below the settled rank by what the
    residuals left would still bring.  What a vertex without out-edges gets is
    not handed on, but counts as handed on.

    The frontier alone is joined with the edges, which lie in buckets by source
    vertex; a round's work grows with the frontier's edges and the vertices
    reached so far.  Comparisons are made at twelve decimals, so the order of
    sums decides nothing.
    """
    weighted, hubs = split_hubs(_weighted_edges(edges))
    e = store_bucketed(weighted, ["src", "src_part"])
    release(weighted)
    spark = edges.sparkSession
    state = spark.range(1).select(F.lit(source).cast("long").alias("id"), F.lit(1.0).alias("total"), F.lit(1.0).alias("residual"))
    state, left, pushed = cut_lineage(state), 1.0, []
    above = F.round("residual", 12) > F.lit(tol)
    while round(left, 12) > tol:
        front = to_parts(state.where(above).select("id", "residual"), hubs)
        given = e.join(front, (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part"))).select(
            F.col("dst").alias("id"), (F.col("residual") / F.col("outdeg") * (1.0 - reset)).alias("got"))
        given = given.groupBy("id").agg(F.sum("got").alias("got"))
        kept = state.select("id", "total", F.when(above, F.lit(0.0)).otherwise(F.col("residual")).alias("residual"),
                            above.alias("pushed"))
        new = kept.join(given, "id", "full_outer").select(
            "id", *[(F.coalesce(c, F.lit(0.0)) + F.coalesce("got", F.lit(0.0))).alias(c) for c in ("total", "residual")],
            F.coalesce("pushed", F.lit(False)).alias("pushed"))
        seen = Observation()
        new = new.observe(seen, F.max("residual").alias("left"), F.count_if("pushed").alias("pushed")).drop("pushed")
        before, state = state, cut_lineage(new)
        release(before)
        left = seen.get["left"]
        pushed.append(seen.get["pushed"])
    for used in (e, hubs):
        release(used)
    return ResidualRank(state.select("id", (F.lit(reset) * F.col("total")).alias("rank")), len(pushed), left, pushed)
