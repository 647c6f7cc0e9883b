"""Motif search: conjunctive edge patterns as chained joins.

A pattern is a list of ``(src_var, edge_var, dst_var)`` triples; a vertex
variable named twice is an equi-join.  Conditions are Column expressions
over ``<var>`` (vertex ids) and ``<edge>_<attr>`` columns; each one is
applied right after the join that binds all the names it uses, so order
predicates prune inside the join rather than after the whole product.
Elements need not be distinct unless a condition says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

Triple = tuple[str, str, str]


def _edge_view(edges: DataFrame, s: str, e: str, d: str) -> DataFrame:
    attrs = [c for c in edges.columns if c not in ("src", "dst")]
    cols = [edges["src"].alias(s)]
    if d != s:
        cols.append(edges["dst"].alias(d))
    cols += [edges[a].alias(f"{e}_{a}") for a in attrs]
    view = edges.select(*cols)
    if d == s:  # self-loop pattern
        view = edges.where(edges["src"] == edges["dst"]).select(*cols)
    return view


def find_motif(edges: DataFrame, pattern: Sequence[Triple],
               conditions: Sequence[tuple[set[str], Column]] = ()) -> DataFrame:
    """All bindings of ``pattern`` satisfying every condition.

    ``conditions`` pairs the set of names a predicate needs with the
    predicate itself, e.g. ``({"e1", "e2"}, F.col("e1_timestamp") <
    F.col("e2_timestamp"))``; edge names stand for all their attributes.
    """
    pending = list(conditions)
    bound: set[str] = set()
    result: DataFrame | None = None
    for s, e, d in pattern:
        view = _edge_view(edges, s, e, d)
        keys = [v for v in dict.fromkeys((s, d)) if v in bound]
        if result is not None and not keys:
            raise ValueError(f"pattern triple {(s, e, d)} shares no vertex with earlier ones; "
                             "order the triples so the pattern stays connected")
        result = view if result is None else result.join(view, keys, "inner")
        bound |= {s, d, e}
        ready = [c for c in pending if c[0] <= bound]
        for c in ready:
            result = result.where(c[1])
            pending.remove(c)
    if pending:
        raise ValueError(f"conditions use unbound names: {[sorted(c[0]) for c in pending]}")
    return result


def count_converging_pairs(edges: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """G7 as a count over a whole graph: pairs of edges into the same target
    from different sources, the first strictly earlier.

    Built from group sizes only -- no pair is materialised and no group is
    gathered in one task.  Per target, C(n, 2) pairs minus C(m, 2) for each
    set of equal times gives the time-ordered pairs; the same for each
    (source, target) removes pairs sharing the source.  All four group
    sizes come out of one grouping-sets aggregate (one scan, one shuffle),
    and ``grouping_id()`` tells which sign each group carries.  Counts use
    exact decimals.  Returns one row ``cnt``.
    """
    from pyspark.sql import functions as F

    e = edges.select("src", "dst", F.col(time_col).alias("t"))
    sets = [["dst"], ["dst", "t"], ["src", "dst"], ["src", "dst", "t"]]
    g = e.groupingSets(sets, "src", "dst", "t").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
    # grouping_id bits (src, dst, t): (dst)=5 +, (dst,t)=4 -, (src,dst)=1 -, (src,dst,t)=0 +
    sign = F.when(F.col("gid").isin(5, 0), F.lit(1)).otherwise(F.lit(-1))
    n = F.col("n").cast("decimal(38,0)")
    pairs = ((n * (n - 1)) / 2).cast("decimal(38,0)")      # n(n-1) is even: exact
    return g.agg(F.coalesce(F.sum(sign * pairs), F.lit(0)).cast("long").alias("cnt"))


def count_two_hop_paths(edges: DataFrame) -> DataFrame:
    """G8 as a count over a whole graph: Σ over vertices of in-degree times
    out-degree (duplicate edges count), one join of two degree tables."""
    from pyspark.sql import functions as F

    ind = edges.groupBy(F.col("dst").alias("v")).agg(F.count(F.lit(1)).alias("i"))
    outd = edges.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("o"))
    prod = F.col("i").cast("decimal(38,0)") * F.col("o").cast("decimal(38,0)")
    return (ind.join(outd, "v")
            .agg(F.coalesce(F.sum(prod), F.lit(0)).cast("long").alias("cnt")))
