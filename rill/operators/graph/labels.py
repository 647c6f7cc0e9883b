"""Community detection by synchronous label propagation.

Every vertex starts with its own id as label.  Each round every edge
carries the label of each end to the other end (so edges count in both
directions, duplicates included); a vertex adopts the label it received
most often, ties going to the smallest label; a vertex that received
nothing keeps its label.  The loop ends after ``rounds`` rounds or at a
fixpoint (which later rounds would not change).

While many vertices switch (more than ``MANY`` of all), votes are counted anew in a
round, which is one join of the edges in buckets and one count, and not stored.
Afterwards votes are kept: a table (vertex, label, votes) changes by
what the vertices that switched labels take away and add.  A round joins the
edges of those vertices alone, and only vertices whose votes changed choose
again.  The table is a base in buckets by vertex and the changes since; when
these have grown to the size of the base, both become a new base.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rill.operators.graph.core import split_hubs, to_parts, vertices_of
from rill.session import cut_lineage, release, store_bucketed


#: Share of the vertices; beyond it nearly every vertex has a neighbour that switched.
MANY = 0.02


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The stored rows and their number, counted while they are written."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return stored, seen.get["n"]


def _choice(votes: DataFrame) -> DataFrame:
    """Most votes, then the smallest label: one aggregate with partial maxima."""
    best = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("label")).alias("neg"))).alias("b"))
    return best.select("id", (-F.col("b.neg")).alias("new"))


def _sum_votes(votes: DataFrame) -> DataFrame:
    return votes.groupBy("id", "label").agg(F.sum("n").alias("n")).where("n > 0")


def _all_votes(to: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every vertex's votes under ``labels``; no edge is shuffled before it carries one."""
    rows = to_parts(labels, hubs).hint("shuffle_hash")
    sent = to.join(rows, (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part")))
    return sent.select(F.col("dst").alias("id"), "label", "n").groupBy("id", "label").agg(F.sum("n").alias("n"))


def label_propagation(edges: DataFrame, rounds: int = 50,
                      told: Callable[[int, int, int], None] = lambda *_: None) -> DataFrame:
    """``id, label`` after up to ``rounds`` synchronous rounds.  ``told`` hears
    each round's number, the vertices that switched and the vote rows they changed."""
    e = edges.select("src", "dst")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    # parallel edges are one row with their number
    both = both.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    parts, hubs = split_hubs(both)
    to = store_bucketed(parts, ["src", "src_part"])
    release(parts)
    labels, vertices = _counted(vertices_of(edges).select("id", F.col("id").alias("label")))
    # the votes of the first round are the edges, which go both ways
    base, in_base, since, in_since = None, to.count(), [], 0
    touched = None                                  # vertices whose votes changed; None: all
    for i in range(rounds):
        if base is not None:
            votes = base
            for d in since:
                votes = votes.unionByName(d)
            if touched is not None:
                votes = votes.join(touched, "id", "left_semi")
            if since:
                votes = _sum_votes(votes)
        else:
            votes = _all_votes(to, hubs, labels) if i else to.select(F.col("src").alias("id"), F.col("dst").alias("label"), "n")
        switched, count = _counted(_choice(votes).join(labels, "id").where(F.col("new") != F.col("label"))
                                   .select("id", F.col("label").alias("old"), "new"))
        release(touched)
        if not count:
            told(i, 0, 0)
            release(switched)
            break
        before, labels = labels, cut_lineage(
            labels.join(switched, "id", "left").select("id", F.coalesce("new", "label").alias("label")))
        release(before)
        if base is None:
            told(i, count, in_base)
            release(switched)
            if count <= MANY * vertices:
                base = store_bucketed(_all_votes(to, hubs, labels), "id")
                in_base = base.count()
            continue
        moved = to.join(to_parts(switched, hubs), (F.col("src") == F.col("id")) & (F.col("src_part") == F.col("part")))
        change = moved.select(F.col("dst").alias("id"), F.explode(F.array(
            F.struct(F.col("old").alias("label"), (-F.col("n")).alias("n")),
            F.struct(F.col("new").alias("label"), F.col("n")))).alias("v")).select("id", "v.label", "v.n")
        change, rows = _counted(change.groupBy("id", "label").agg(F.sum("n").alias("n")).where("n != 0"))
        release(switched)
        told(i, count, rows)
        touched = cut_lineage(change.select("id").distinct())
        since.append(change)
        in_since += rows
        if in_since > in_base or len(since) >= 8:
            whole = base
            for d in since:
                whole = whole.unionByName(d)
            new = store_bucketed(_sum_votes(whole), "id")
            for used in (base, *since):
                release(used)
            base, in_base, since, in_since = new, new.count(), [], 0
    else:
        release(touched)
    for used in (base, *since, to, hubs):
        release(used)
    return labels
