"""Connected and strongly connected components on edge DataFrames.

* Connected components use the alternating large-star / small-star rounds
  (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014):
  O(log^2 n) rounds even on long paths, each round two aggregations and
  joins; no vertex ever collects its neighbour list.
* Strong components trim vertices without in- or out-edges, merge vertices
  with a single in- or out-neighbour into it (so chains and rings shrink by a
  constant share per turn), and then search forwards and backwards from many
  pivots at once (after Fleischer, Hendrickson and Pinar, 2000); what lies in no
  pivot's component falls into regions that no component crosses, and repeats.

Labels are the smallest vertex id of each component.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rill.operators.graph.core import vertices_of
from rill.operators.graph.propagate import propagate
from rill.session import cut_lineage, release


def _undirected(edges: DataFrame) -> DataFrame:
    return (edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _both_ways(e: DataFrame) -> DataFrame:
    return (e.select(F.col("a").alias("u"), F.col("b").alias("v"))
            .unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v"))))


def _norm(x: str, y: str, df: DataFrame) -> DataFrame:
    return (df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    nb = _both_ways(e)
    m = nb.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return _norm("v", "m", nb.where(F.col("v") > F.col("u")).join(m, "u"))


def _small_star(e: DataFrame) -> DataFrame:
    nb = _both_ways(e).where(F.col("v") < F.col("u"))     # smaller neighbours only
    m = nb.groupBy("u").agg(F.min("v").alias("m"))
    spokes = nb.join(m, "u").select("v", "m")
    centre = m.select(F.col("u").alias("v"), "m")
    return _norm("v", "m", spokes.unionByName(centre))


def _print_of(e: DataFrame) -> tuple:
    """Row count and an order-free checksum of an edge table."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(e.agg(F.count(F.lit(1)), F.sum(h), F.bit_xor(F.xxhash64("b", "a"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every vertex touching an edge (edges are
    taken as undirected; the component label is its smallest id)."""
    e = cut_lineage(_undirected(edges))
    before = _print_of(e)
    while True:
        large = cut_lineage(_large_star(e))
        nxt = cut_lineage(_small_star(large))
        release(large)
        release(e)
        e, now = nxt, _print_of(nxt)
        if now == before:
            break
        before = now
    labels = _both_ways(e).groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("component"))
    return (vertices_of(edges).join(labels.withColumnRenamed("u", "id"), "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))


def _hashed(turn: int) -> Column:
    return F.xxhash64("id", F.lit(turn))


@dataclass
class _Rest:
    """What is not settled yet: vertices (id, region) and the edges inside regions."""
    verts: DataFrame
    edges: DataFrame
    n: int                      # vertices

    def replace(self, verts: DataFrame, edges: DataFrame) -> None:
        seen = Observation()
        new = cut_lineage(verts.observe(seen, F.count(F.lit(1)).alias("n"))), cut_lineage(edges)
        self.drop()
        self.verts, self.edges, self.n = *new, seen.get["n"]

    def drop(self) -> None:
        for used in (self.verts, self.edges):
            release(used)


def _trim(rest: _Rest) -> list[DataFrame]:
    """Take off vertices without in-edges or without out-edges until there are
    none; each is a component of its own.  Returns them as (id, scc)."""
    off = []
    while True:
        has_in = rest.edges.select(F.col("dst").alias("id")).distinct()
        has_out = rest.edges.select(F.col("src").alias("id")).distinct()
        core = cut_lineage(rest.verts.join(has_in, "id", "left_semi").join(has_out, "id", "left_semi"))
        alone = cut_lineage(rest.verts.join(core, "id", "left_anti").select("id", F.col("id").alias("scc")))
        if alone.isEmpty():
            release(core)
            release(alone)
            return off
        off.append(alone)
        ids = core.select("id")
        rest.replace(core, rest.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
                     .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst"))
        release(core)


def _contract(rest: _Rest, turn: int, least: float = 0.05) -> DataFrame | None:
    """Merge vertices with one in-neighbour into it (with one out-neighbour, in
    odd turns), which keeps all paths between the others.

    Of a chain of such vertices a coin picks some that are not neighbours, so a
    chain or ring shrinks by a constant share per turn, however long it is.
    Returns ``id, into, other`` (a vertex, what it went into, and its neighbours on
    the other side), or None if under ``least`` of the vertices could be merged."""
    e = rest.edges if turn % 2 == 0 else rest.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    single = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("into"))
    heads = single.where((F.col("n") == 1) & (F.pmod(_hashed(turn), F.lit(2)) == 1)).select("id", "into")
    picked = heads.join(heads.select(F.col("id").alias("into")), "into", "left_anti").select("id", "into")
    seen = Observation()
    picked = cut_lineage(picked.observe(seen, F.count(F.lit(1)).alias("n")))
    if seen.get["n"] <= least * rest.n:
        release(picked)
        return None
    out = e.join(picked.withColumnRenamed("id", "src"), "src", "left")
    log = cut_lineage(out.where("into is not null").select(F.col("src").alias("id"), "into", F.col("dst").alias("other")))
    kept = out.select(F.coalesce("into", "src").alias("src"), "dst").join(picked.select(F.col("id").alias("dst")), "dst", "left_anti")
    kept = kept.where("src != dst").select("src", "dst").distinct()
    if turn % 2:
        kept = kept.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    rest.replace(rest.verts.join(picked.select("id"), "id", "left_anti"), kept)
    release(picked)
    return log


def _undo(found: DataFrame, log: DataFrame) -> DataFrame:
    """Components of the merged vertices: that of what they went into, if one of
    their neighbours on the other side is in it, else their own."""
    into = found.select(F.col("id").alias("into"), F.col("scc").alias("mine"))
    other = found.select(F.col("id").alias("other"), F.col("scc").alias("its"))
    back = log.join(into, "into").join(other, "other", "left").groupBy("id").agg(
        F.first("mine").alias("mine"), F.bool_or(F.coalesce(F.col("its") == F.col("mine"), F.lit(False))).alias("same"))
    return found.unionByName(back.select("id", F.when(F.col("same"), F.col("mine")).otherwise(F.col("id")).alias("scc")))


def _many_pivots(rest: _Rest, turn: int) -> DataFrame:
    """One forward and one backward search from up to 63 pivots of every region
    at once; a vertex keeps the pivots that reach it, and that it reaches, as bits.

    Vertices with a pivot in both are the components of those pivots.  The others
    fall into regions of equal bits, which no component crosses: the next turn has
    pivots in each of them.  Returns the components as (id, scc)."""
    bit = F.pmod(_hashed(turn), F.lit(63)).cast("int")
    pivots = rest.verts.groupBy("region", bit.alias("bit")).agg(F.min_by("id", _hashed(turn + 1)).alias("id"))
    state = rest.verts.join(pivots.select("id", "bit"), "id", "left").select(
        "id", F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")), F.lit(0).cast("long")).alias("value"))
    state = cut_lineage(state)
    reach = lambda e: propagate(e, state, lambda v, _e: v, F.bit_or, lambda old, msg: old.bitwiseOR(msg))
    ahead = reach(rest.edges).withColumnRenamed("value", "ahead")
    back = reach(rest.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumnRenamed("value", "back")
    seen = cut_lineage(rest.verts.join(ahead, "id").join(back, "id").withColumn("both", F.col("ahead").bitwiseAND(F.col("back"))))
    for used in (ahead, back, state):
        release(used)
    names = seen.where("both != 0").groupBy("region", "both").agg(F.min("id").alias("scc"))
    found = cut_lineage(seen.where("both != 0").join(names, ["region", "both"]).select("id", "scc"))
    left = cut_lineage(seen.where("both = 0").select("id", F.xxhash64("region", "ahead", "back").alias("region")))
    side = lambda end: left.select(F.col("id").alias(end), F.col("region").alias(f"{end}_region"))
    kept = rest.edges.join(side("src"), "src").join(side("dst"), "dst").where("src_region = dst_region").select("src", "dst")
    rest.replace(left, kept)
    for used in (seen, left):
        release(used)
    return found


def strongly_connected_components(edges: DataFrame, rounds: int | None = None,
                                  told: Callable[[str, int], None] = lambda *_: None) -> DataFrame:
    """``id, scc`` (smallest id of the strong component) for every vertex
    touching an edge.  Runs to the end; ``rounds`` asks for the partial answer
    after that many searches from pivots (vertices without one are left out).
    ``told`` hears of each step and its number."""
    verts = cut_lineage(vertices_of(edges))
    rest = _Rest(edges.limit(0), edges.limit(0), 0)
    rest.replace(verts.withColumn("region", F.lit(0).cast("long")),
                 edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    steps, turn, done = [], 0, 0            # steps: components found, or logs of merged vertices, in order
    while True:
        changed = True
        while changed:                      # trimming leaves more to merge, merging more to trim
            steps += [("found", f) for f in _trim(rest)]
            changed = False
            while rest.n and (log := _contract(rest, turn)) is not None:
                told("merge", turn)
                steps.append(("merged", log))
                turn, changed = turn + 1, True
            turn += 1
        if not rest.n or (rounds is not None and done >= rounds):
            break
        done += 1
        told("search", done)
        steps.append(("found", _many_pivots(rest, turn)))
        turn += 2
    found = verts.limit(0).select("id", F.col("id").alias("scc"))
    for kind, step in reversed(steps):
        before, found = found, cut_lineage(found.unionByName(step) if kind == "found" else _undo(found, step))
        release(before)
        release(step)
    least = found.groupBy("scc").agg(F.min("id").alias("least"))
    out = cut_lineage(found.join(least, "scc").select("id", F.col("least").alias("scc")))
    release(found)
    release(verts)
    rest.drop()
    return out


def component_sizes(labels: DataFrame, label: str = "component") -> DataFrame:
    """Size of every component (``label, size``)."""
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("size"))

