"""Graph queries: counts and degrees, time subgraph, motifs, PageRank,
personalised PageRank, components, communities, DAG distances and a
custom vertex program."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rill.operators.graph import components as comp
from rill.operators.graph.crossing import count_fork_motif, count_square_motif
from rill.operators.graph.core import (drop_isolated, graph_summary, induced_subgraph,
                                       max_degree_vertex, out_degrees, vertices_of)
from rill.operators.graph.labels import label_propagation
from rill.operators.graph.motif import count_converging_pairs, count_two_hop_paths, find_motif
from rill.operators.graph.pagerank import pagerank, personalized_pagerank, residual_pagerank
from rill.operators.graph.paths import longest_distance
from rill.operators.graph.propagate import propagate
from rill.operators.relational import merge_single_rows
from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.session import cut_lineage, loop_partitions, release

# The time window (10000 < timestamp <= 50000) of the subgraph and of
# the motifs on it, round counts and list sizes.  The motif shapes below are fixed, too.
SUBGRAPH_WINDOW = (10000, 50000)
MOTIF_WINDOW = SUBGRAPH_WINDOW
PR_ROUNDS = 10
PPR_ROUNDS = 20
PPR_TOP = 20
PPR_SUBGRAPH_TOP = 2000
LPA_ROUNDS = 50

# ---- oracle building blocks (DuckDB) ----
_PARTS = "(SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem)"
_IG = f"""ig AS (SELECT p AS src, nxt AS dst FROM (
  SELECT p, lead(p) OVER (PARTITION BY o ORDER BY (p * {ds.ITEM_ORDER_MULT} + o) % {ds.ITEM_ORDER_MOD}, p) AS nxt
  FROM {_PARTS}) WHERE nxt IS NOT NULL)"""
_DG = f"""dg AS (SELECT p AS src, nxt AS dst FROM (
  SELECT p, lead(p) OVER (PARTITION BY o ORDER BY p) AS nxt FROM {_PARTS}) WHERE nxt IS NOT NULL)"""
_CY = f"""{_DG}, cy AS (
  SELECT DISTINCT src, dst FROM (
    SELECT src, dst FROM dg
    UNION ALL
    SELECT MAX(p), MIN(p) FROM {_PARTS} GROUP BY o HAVING MAX(p) <> MIN(p)))"""
_AE = f"""ae AS (SELECT user_id AS src,
  CAST(json_extract_string(props, '$.k') AS BIGINT) + {ds.ACTIVITY_TARGET_SHIFT} AS dst,
  date_diff('microsecond', TIMESTAMP '{ds.ACTIVITY_EPOCH}', ts) / 1e6 AS timestamp FROM events)"""
_SL = f"sl AS (SELECT * FROM ae WHERE timestamp > {MOTIF_WINDOW[0]} AND timestamp <= {MOTIF_WINDOW[1]})"


# Layers of the order graph; a vertex is 4 * key + layer.
_LAYERED = """lg AS (
  SELECT 4 * CAST(c_nationkey AS BIGINT) AS src, 4 * CAST(c_custkey AS BIGINT) + 1 AS dst FROM customer
  UNION SELECT 4 * CAST(o_custkey AS BIGINT) + 1, 4 * CAST(o_orderkey AS BIGINT) + 2 FROM orders
  UNION SELECT 4 * CAST(l_orderkey AS BIGINT) + 2, 4 * CAST(l_partkey AS BIGINT) + 3 FROM lineitem)"""


def _stored(edges):
    """Edge lists read more than once (loops, degree + join, subgraphs) are
    derived from lineitem once per query and read back from the checkpoint
    folder, instead of re-running the derivation for every use."""
    return cut_lineage(edges)


# ---- counts, degrees, subgraph ----

@query("graph_counts", sql=f"""
WITH {_AE}
SELECT (SELECT COUNT(*) FROM (SELECT src FROM ae UNION SELECT dst FROM ae)) AS vertices,
       (SELECT COUNT(DISTINCT src) FROM ae) AS users,
       (SELECT COUNT(DISTINCT dst) FROM ae) AS activities,
       (SELECT COUNT(*) FROM ae) AS edges
""")
def graph_counts(spark, sf_dir):
    """Vertex, user, activity and edge counts as one report row,
    from one scan (users are the edge sources, activities the targets)."""
    summary = graph_summary(ds.activity_edges(spark, sf_dir))
    return summary.select("vertices", F.col("sources").alias("users"),
                          F.col("targets").alias("activities"), "edges")


@query("max_degree", sql=f"""
WITH {_AE}
(SELECT 'in' AS kind, dst AS id, COUNT(*) AS degree FROM ae GROUP BY dst
 ORDER BY degree DESC, id ASC LIMIT 1)
UNION ALL
(SELECT 'out' AS kind, src AS id, COUNT(*) AS degree FROM ae GROUP BY src
 ORDER BY degree DESC, id ASC LIMIT 1)
""")
def max_degree(spark, sf_dir):
    """Vertices with the largest in- and out-degree."""
    return max_degree_vertex(ds.activity_edges(spark, sf_dir))


@query("time_subgraph", sql=f"""
WITH {_AE}, s AS (SELECT * FROM ae WHERE timestamp > {SUBGRAPH_WINDOW[0]} AND timestamp <= {SUBGRAPH_WINDOW[1]})
SELECT (SELECT COUNT(*) FROM (SELECT src FROM s UNION SELECT dst FROM s)) AS vertices,
       (SELECT COUNT(*) FROM s) AS edges
""")
def time_subgraph(spark, sf_dir):
    """Keep edges in a half-open time range, then drop vertices
    left without edges."""
    e = _stored(ds.activity_edges(spark, sf_dir, SUBGRAPH_WINDOW))   # read three times below
    v = drop_isolated(ds.activity_vertices(spark, sf_dir), e)
    return merge_single_rows([v.agg(F.count(F.lit(1)).alias("vertices")),
                              e.agg(F.count(F.lit(1)).alias("edges"))])


# ---- motifs ----

def _ts(e):
    return F.col(f"{e}_timestamp")


@query("motif_1", sql=f"""
WITH {_AE}, {_SL}
SELECT COUNT(*) AS cnt FROM sl e1 JOIN sl e2 ON e1.dst = e2.dst
WHERE e1.src <> e2.src AND e1.timestamp < e2.timestamp
""")
def motif_1(spark, sf_dir):
    """(v1)-[e1]->(v3); (v2)-[e2]->(v3), v1 != v2, e1 before e2."""
    e = ds.activity_edges(spark, sf_dir, MOTIF_WINDOW)
    m = find_motif(e, [("v1", "e1", "v3"), ("v2", "e2", "v3")],
                   [({"v1", "v2"}, F.col("v1") != F.col("v2")),
                    ({"e1", "e2"}, _ts("e1") < _ts("e2"))])
    return m.agg(F.count(F.lit(1)).alias("cnt"))


@query("motif_2", sql=f"""
WITH {_AE}, {_SL}
SELECT COUNT(*) AS cnt FROM sl e1 JOIN sl e2 ON e1.dst = e2.src
""")
def motif_2(spark, sf_dir):
    """Two-hop paths (v1)-[e1]->(v2); (v2)-[e2]->(v3) on the activity
    slice (users are never targets, so there are none)."""
    e = ds.activity_edges(spark, sf_dir, MOTIF_WINDOW)
    m = find_motif(e, [("v1", "e1", "v2"), ("v2", "e2", "v3")])
    return m.agg(F.count(F.lit(1)).alias("cnt"))


@query("motif_2_item", sql=f"""
WITH {_IG} SELECT COUNT(*) AS cnt FROM ig e1 JOIN ig e2 ON e1.dst = e2.src
""")
def motif_2_item(spark, sf_dir):
    """G8 on the cyclic item graph, where two-hop paths exist."""
    m = find_motif(ds.item_graph(spark, sf_dir), [("v1", "e1", "v2"), ("v2", "e2", "v3")])
    return m.agg(F.count(F.lit(1)).alias("cnt"))


@query("motif_1_all", sql=f"""
WITH {_AE}
SELECT COUNT(*) AS cnt FROM ae e1 JOIN ae e2 ON e1.dst = e2.dst
WHERE e1.src <> e2.src AND e1.timestamp < e2.timestamp
""")
def motif_1_all(spark, sf_dir):
    """G7 over the whole activity graph, counted from group sizes (no pair
    enumeration, no time slice)."""
    return count_converging_pairs(ds.activity_edges(spark, sf_dir))


@query("motif_2_item_all", sql=f"""
WITH {_IG} SELECT COUNT(*) AS cnt FROM ig e1 JOIN ig e2 ON e1.dst = e2.src
""")
def motif_2_item_all(spark, sf_dir):
    """G8 over the whole item graph as in-degree x out-degree per vertex."""
    return count_two_hop_paths(ds.item_graph(spark, sf_dir))


@query("motif_3", sql=f"""
WITH {_AE}, {_SL}
SELECT COUNT(*) AS cnt
FROM sl e1 JOIN sl e4 ON e4.dst = e1.dst
JOIN sl e3 ON e3.src = e1.src
JOIN sl e2 ON e2.src = e4.src AND e2.dst = e3.dst
WHERE e1.src <> e4.src AND e1.dst <> e3.dst
  AND e1.timestamp < e2.timestamp AND e2.timestamp < e3.timestamp AND e3.timestamp < e4.timestamp
""")
def motif_3(spark, sf_dir):
    """(v1)-[e1]->(v2); (v4)-[e4]->(v2); (v1)-[e3]->(v3); (v4)-[e2]->(v3)
    with v1 != v4, v2 != v3 and e1 < e2 < e3 < e4 in time.  The implied
    orders (e1 < e4, e1 < e3, e3 < e4) prune each join as soon as it binds."""
    e = ds.activity_edges(spark, sf_dir, MOTIF_WINDOW)
    m = find_motif(e, [("v1", "e1", "v2"), ("v4", "e4", "v2"), ("v1", "e3", "v3"),
                       ("v4", "e2", "v3")],
                   [({"v1", "v4"}, F.col("v1") != F.col("v4")),
                    ({"e1", "e4"}, _ts("e1") < _ts("e4")),
                    ({"v2", "v3"}, F.col("v2") != F.col("v3")),
                    ({"e1", "e3"}, _ts("e1") < _ts("e3")),
                    ({"e3", "e4"}, _ts("e3") < _ts("e4")),
                    ({"e1", "e2"}, _ts("e1") < _ts("e2")),
                    ({"e2", "e3"}, _ts("e2") < _ts("e3"))])
    return m.agg(F.count(F.lit(1)).alias("cnt"))


@query("motif_4", sql=f"""
WITH {_AE}, {_SL}
SELECT COUNT(*) AS cnt
FROM sl e1 JOIN sl e3 ON e3.src = e1.src
JOIN sl e4 ON e4.dst = e3.dst
JOIN sl e2 ON e2.src = e4.src
WHERE e1.src <> e4.src AND e1.dst <> e3.dst AND e3.dst <> e2.dst AND e1.dst <> e2.dst
  AND e1.timestamp < e2.timestamp AND e2.timestamp < e3.timestamp AND e3.timestamp < e4.timestamp
""")
def motif_4(spark, sf_dir):
    """(v2)-[e1]->(v1); (v2)-[e3]->(v3); (v4)-[e4]->(v3); (v4)-[e2]->(v5)
    with v2 != v4, v1 != v3, v3 != v5, v1 != v5 and e1 < e2 < e3 < e4."""
    e = ds.activity_edges(spark, sf_dir, MOTIF_WINDOW)
    m = find_motif(e, [("v2", "e1", "v1"), ("v2", "e3", "v3"), ("v4", "e4", "v3"),
                       ("v4", "e2", "v5")],
                   [({"v1", "v3"}, F.col("v1") != F.col("v3")),
                    ({"e1", "e3"}, _ts("e1") < _ts("e3")),
                    ({"v2", "v4"}, F.col("v2") != F.col("v4")),
                    ({"e3", "e4"}, _ts("e3") < _ts("e4")),
                    ({"v3", "v5"}, F.col("v3") != F.col("v5")),
                    ({"v1", "v5"}, F.col("v1") != F.col("v5")),
                    ({"e1", "e2"}, _ts("e1") < _ts("e2")),
                    ({"e2", "e3"}, _ts("e2") < _ts("e3"))])
    return m.agg(F.count(F.lit(1)).alias("cnt"))


@query("motif_3_all", sql=f"""
WITH {_AE}
SELECT COUNT(*) AS cnt
FROM ae e1 JOIN ae e4 ON e4.dst = e1.dst
JOIN ae e3 ON e3.src = e1.src
JOIN ae e2 ON e2.src = e4.src AND e2.dst = e3.dst
WHERE e1.src <> e4.src AND e1.dst <> e3.dst
  AND e1.timestamp < e2.timestamp AND e2.timestamp < e3.timestamp AND e3.timestamp < e4.timestamp
""")
def motif_3_all(spark, sf_dir):
    """G9 over the whole activity graph: crossing intervals over the same two
    targets, counted without binding four edges."""
    return count_square_motif(ds.activity_edges(spark, sf_dir)).select(F.col("cnt").cast("long").alias("cnt"))


@query("motif_4_all", sql=f"""
WITH {_AE}
SELECT COUNT(*) AS cnt
FROM ae e1 JOIN ae e3 ON e3.src = e1.src
JOIN ae e4 ON e4.dst = e3.dst
JOIN ae e2 ON e2.src = e4.src
WHERE e1.src <> e4.src AND e1.dst <> e3.dst AND e3.dst <> e2.dst AND e1.dst <> e2.dst
  AND e1.timestamp < e2.timestamp AND e2.timestamp < e3.timestamp AND e3.timestamp < e4.timestamp
""")
def motif_4_all(spark, sf_dir):
    """G10 over the whole activity graph, counted the same way."""
    return count_fork_motif(ds.activity_edges(spark, sf_dir)).select(F.col("cnt").cast("long").alias("cnt"))


# ---- PageRank family ----

def _pr_sql(rounds: int) -> str:
    ctes = [_IG, "od AS (SELECT src, COUNT(*) AS n FROM ig GROUP BY src)",
            "r0 AS (SELECT DISTINCT src AS id, 1.0::DOUBLE AS rank FROM ig)"]
    for k in range(1, rounds + 1):
        ctes.append(f"""r{k} AS MATERIALIZED (
  SELECT e.dst AS id, 0.15 + 0.85 * SUM(r.rank / od.n) AS rank
  FROM ig e JOIN od ON od.src = e.src JOIN r{k - 1} r ON r.id = e.src GROUP BY e.dst)""")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, round(rank, 6) AS rank FROM r{rounds}"


@query("pagerank", sql=_pr_sql(PR_ROUNDS))
def pagerank_q(spark, sf_dir):
    """Ten rounds on the item graph, rounded to 6."""
    r = pagerank(_stored(ds.item_graph(spark, sf_dir)), rounds=PR_ROUNDS)
    return r.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_partitioned", sql=_pr_sql(PR_ROUNDS))
def pagerank_partitioned(spark, sf_dir):
    """The same with the edges in a table of buckets by ``src``, so a
    round moves ranks and sums only."""
    parts = loop_partitions(spark)
    r = pagerank(_stored(ds.item_graph(spark, sf_dir)), rounds=PR_ROUNDS, partitions=parts)
    return r.select("id", F.round("rank", 6).alias("rank"))


def _ppr_source(edges):
    """The vertex with the most out-edges (ties: smallest id)."""
    best = out_degrees(edges).agg(
        F.max(F.struct("out_degree", (-F.col("id")).alias("neg"))).alias("b")).first()["b"]
    return -int(best["neg"])


def _ppr_sql(rounds: int) -> str:
    ctes = [_IG, "od AS (SELECT src, COUNT(*) AS n FROM ig GROUP BY src)",
            "srcv AS (SELECT src AS s FROM ig GROUP BY src ORDER BY COUNT(*) DESC, src ASC LIMIT 1)",
            "r0 AS (SELECT s AS id, 1.0::DOUBLE AS rank FROM srcv)"]
    for k in range(1, rounds + 1):
        ctes.append(f"""r{k} AS MATERIALIZED (
  SELECT id, CASE WHEN id = (SELECT s FROM srcv) THEN 0.15 ELSE 0.0 END + 0.85 * SUM(c) AS rank
  FROM (SELECT e.dst AS id, r.rank / od.n AS c
        FROM ig e JOIN od ON od.src = e.src JOIN r{k - 1} r ON r.id = e.src
        UNION ALL SELECT s, 0.0 FROM srcv)
  GROUP BY id)""")
    return "WITH " + ",\n".join(ctes)


def _ppr_ranked(spark, sf_dir):
    g = _stored(ds.item_graph(spark, sf_dir))
    s = _ppr_source(g)
    r = personalized_pagerank(g, s, rounds=PPR_ROUNDS)
    # the ranks feed both the top list and the subgraph: store them once
    return g, s, _stored(r.select("id", F.round("rank", 6).alias("rank")))


@query("personalized_pagerank_top20", sql=_ppr_sql(PPR_ROUNDS) + f"""
SELECT id, round(rank, 6) AS rank FROM r{PPR_ROUNDS} WHERE id <> (SELECT s FROM srcv)
ORDER BY round(rank, 6) DESC, id ASC LIMIT {PPR_TOP}
""")
def personalized_pagerank_top20(spark, sf_dir):
    """Rank personalised to the busiest vertex; its top 20 other
    vertices (the source itself is excluded)."""
    _, s, r = _ppr_ranked(spark, sf_dir)
    return (r.where(F.col("id") != F.lit(s))
            .orderBy(F.col("rank").desc(), F.col("id").asc()).limit(PPR_TOP))


@query("ppr_subgraph_edges", sql=_ppr_sql(PPR_ROUNDS) + f""",
top AS (SELECT id FROM r{PPR_ROUNDS} ORDER BY round(rank, 6) DESC, id ASC LIMIT {PPR_SUBGRAPH_TOP})
SELECT (SELECT COUNT(*) FROM top) AS vertices,
       (SELECT COUNT(*) FROM ig WHERE src IN (SELECT id FROM top) AND dst IN (SELECT id FROM top)) AS edges
""")
def ppr_subgraph_edges(spark, sf_dir):
    """The subgraph induced by the 2000 best-ranked vertices."""
    g, _, r = _ppr_ranked(spark, sf_dir)
    top = r.orderBy(F.col("rank").desc(), F.col("id").asc()).limit(PPR_SUBGRAPH_TOP).select("id")
    sub = induced_subgraph(g, top)
    return merge_single_rows([top.agg(F.count(F.lit(1)).alias("vertices")),
                              sub.agg(F.count(F.lit(1)).alias("edges"))])


#: Rounds after which ranks on the layered graph (three edges deep) do not change.
LAYERED_ROUNDS = 5


def _layered_ppr_sql() -> str:
    ctes = [_LAYERED, "od AS (SELECT src, COUNT(*) AS n FROM lg GROUP BY src)",
            "srcv AS (SELECT src AS s FROM lg WHERE src % 4 = 0 GROUP BY src ORDER BY COUNT(*) DESC, src ASC LIMIT 1)",
            "r0 AS (SELECT s AS id, 1.0::DOUBLE AS rank FROM srcv)"]
    for k in range(1, LAYERED_ROUNDS + 1):
        ctes.append(f"""r{k} AS MATERIALIZED (
  SELECT id, CASE WHEN id = (SELECT s FROM srcv) THEN 0.15 ELSE 0.0 END + 0.85 * SUM(c) AS rank
  FROM (SELECT e.dst AS id, r.rank / od.n AS c
        FROM lg e JOIN od ON od.src = e.src JOIN r{k - 1} r ON r.id = e.src
        UNION ALL SELECT s, 0.0 FROM srcv)
  GROUP BY id)""")
    return "WITH " + ",\n".join(ctes)


@query("ppr_subgraph_layered", sql=_layered_ppr_sql() + f""",
top AS (SELECT id FROM r{LAYERED_ROUNDS} ORDER BY round(rank, 9) DESC, id ASC LIMIT {PPR_SUBGRAPH_TOP})
SELECT (SELECT COUNT(*) FROM r{LAYERED_ROUNDS}) AS ranked, (SELECT COUNT(*) FROM top) AS vertices,
       (SELECT COUNT(*) FROM lg WHERE src IN (SELECT id FROM top) AND dst IN (SELECT id FROM top)) AS edges
""")
def ppr_subgraph_layered(spark, sf_dir):
    """G14/P17 where the 2000 best are not all: rank personalised to the nation of
    most customers on the order graph, and the subgraph of its best vertices."""
    g = _stored(ds.layered_edges(spark, sf_dir).distinct())
    r = _stored(personalized_pagerank(g, _ppr_source(g.where("src % 4 = 0")), rounds=LAYERED_ROUNDS))
    top = r.orderBy(F.round("rank", 9).desc(), F.col("id").asc()).limit(PPR_SUBGRAPH_TOP).select("id")
    return merge_single_rows([r.agg(F.count(F.lit(1)).alias("ranked")), top.agg(F.count(F.lit(1)).alias("vertices")),
                              induced_subgraph(g, top).agg(F.count(F.lit(1)).alias("edges"))])


#: Tolerance of the rank, and rounds of the SQL (those after the last push change nothing).
PPR_TOL = 0.01
PPR_SQL_ROUNDS = 24


def _residual_sql(tol: float, rounds: int) -> str:
    ctes = [_IG, "od AS (SELECT src, COUNT(*) AS n FROM ig GROUP BY src)",
            "srcv AS (SELECT src AS s FROM ig GROUP BY src ORDER BY COUNT(*) DESC, src ASC LIMIT 1)",
            "p0 AS (SELECT s AS id, 1.0::DOUBLE AS total, 1.0::DOUBLE AS res, CAST(0 AS BIGINT) AS pushes FROM srcv)"]
    for k in range(1, rounds + 1):
        ctes.append(f"""p{k} AS MATERIALIZED (
  SELECT id, SUM(total) AS total, SUM(res) AS res, MAX(pushes) AS pushes FROM (
    SELECT id, total, CASE WHEN round(res, 12) > {tol} THEN 0.0 ELSE res END AS res,
           CASE WHEN (SELECT MAX(round(res, 12)) FROM p{k - 1}) > {tol} THEN {k} ELSE pushes END AS pushes
    FROM p{k - 1}
    UNION ALL
    SELECT e.dst, 0.85 * p.res / od.n, 0.85 * p.res / od.n, 0
    FROM p{k - 1} p JOIN ig e ON e.src = p.id JOIN od ON od.src = p.id WHERE round(p.res, 12) > {tol})
  GROUP BY id)""")
    return "WITH " + ",\n".join(ctes)


# twelve decimals: at fewer, ranks such as 0.0032778125 lie on the edge of rounding
@query("personalized_pagerank_tolerance", sql=_residual_sql(PPR_TOL, PPR_SQL_ROUNDS) + f"""
SELECT id, round(0.15 * total, 12) AS rank, (SELECT MAX(pushes) FROM p{PPR_SQL_ROUNDS}) AS rounds,
       (SELECT round(MAX(res), 12) FROM p{PPR_SQL_ROUNDS}) AS residual
FROM p{PPR_SQL_ROUNDS} WHERE id <> (SELECT s FROM srcv)
ORDER BY round(0.15 * total, 12) DESC, id ASC LIMIT {PPR_TOP}
""")
def personalized_pagerank_tolerance(spark, sf_dir):
    """Rank personalised to the busiest vertex, residuals pushed until none
    is above 0.01; the top 20 others, the rounds and the largest residual left."""
    g = _stored(ds.item_graph(spark, sf_dir))
    s = _ppr_source(g)
    r = residual_pagerank(g, s, PPR_TOL)
    release(g)
    return (r.ranks.where(F.col("id") != F.lit(s)).select("id", F.round("rank", 12).alias("rank"))
            .orderBy(F.col("rank").desc(), F.col("id").asc()).limit(PPR_TOP)
            .select("id", "rank", F.lit(r.rounds).cast("long").alias("rounds"), F.round(F.lit(r.residual), 12).alias("residual")))


# ---- components and communities ----

_CC_SQL = f"""WITH RECURSIVE {_DG},
u AS (SELECT src AS a, dst AS b FROM dg UNION SELECT dst, src FROM dg),
r(v, c) AS (SELECT a, a FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.v WHERE r.c < u.b),
cc AS (SELECT v AS id, MIN(c) AS component FROM r GROUP BY v)"""


@query("connected_components", sql=_CC_SQL + "\nSELECT id, component FROM cc")
def connected_components_q(spark, sf_dir):
    """Component label (smallest id) of every vertex of the part
    graph taken as undirected."""
    return comp.connected_components(_stored(ds.dag_edges(spark, sf_dir)))


@query("largest_components", sql=_CC_SQL + """
SELECT component, COUNT(*) AS size, (SELECT COUNT(DISTINCT component) FROM cc) AS components
FROM cc GROUP BY component ORDER BY size DESC, component ASC LIMIT 20
""")
def largest_components(spark, sf_dir):
    """The 20 largest components and the number of components."""
    labels = comp.connected_components(_stored(ds.dag_edges(spark, sf_dir)))
    sizes = comp.component_sizes(labels)
    n = sizes.agg(F.count(F.lit(1)).alias("components"))
    top = sizes.orderBy(F.col("size").desc(), F.col("component").asc()).limit(20)
    # attach the one-row count to the 20 rows without a join: stack both and
    # spread the count with a window over these 21 rows
    stacked = top.unionByName(n, allowMissingColumns=True)
    return (stacked.withColumn("components", F.max("components").over(Window.partitionBy()))
            .where(F.col("component").isNotNull()))


@query("strong_components", sql=f"""WITH RECURSIVE {_CY},
vs AS (SELECT src AS v FROM cy UNION SELECT dst FROM cy),
r(s, v) AS (SELECT v, v FROM vs UNION SELECT r.s, e.dst FROM r JOIN cy e ON e.src = r.v)
SELECT a.s AS id, MIN(a.v) AS scc FROM r a JOIN r b ON a.s = b.v AND a.v = b.s GROUP BY a.s
""")
def strong_components(spark, sf_dir):
    """Strong component (smallest id) of every vertex of the part
    graph with order-closing back edges, run to convergence."""
    return comp.strongly_connected_components(_stored(ds.cyclic_edges(spark, sf_dir)))


@query("strong_components_in_rounds", sql=f"""WITH RECURSIVE {_CY},
vs AS (SELECT src AS v FROM cy UNION SELECT dst FROM cy),
r(s, v) AS (SELECT v, v FROM vs UNION SELECT r.s, e.dst FROM r JOIN cy e ON e.src = r.v),
f AS (SELECT a.s AS id, MIN(a.v) AS scc FROM r a JOIN r b ON a.s = b.v AND a.v = b.s GROUP BY a.s)
SELECT true AS labels_agree, COUNT(DISTINCT scc) AS components, COUNT(*) AS vertices FROM f
""")
def strong_components_in_rounds(spark, sf_dir):
    """The answer after three searches from pivots beside the full one: what
    it has is right; and the number of strong components."""
    g = _stored(ds.cyclic_edges(spark, sf_dir))
    full = comp.strongly_connected_components(g)
    part = comp.strongly_connected_components(g, rounds=3)
    both = full.join(part.withColumnRenamed("scc", "early"), "id", "left")
    return both.agg(F.bool_and(F.coalesce(F.col("early") == F.col("scc"), F.lit(True))).alias("labels_agree"),
                    F.count_distinct("scc").alias("components"), F.count(F.lit(1)).alias("vertices"))


def _lpa_sql(rounds: int) -> str:
    ctes = [_IG,
            "m AS (SELECT src AS frm, dst AS dst_ FROM ig UNION ALL SELECT dst, src FROM ig)",
            "l0 AS (SELECT id, id AS label FROM (SELECT src AS id FROM ig UNION SELECT dst FROM ig))"]
    for k in range(1, rounds + 1):
        ctes.append(f"""l{k} AS MATERIALIZED (
  SELECT l.id, COALESCE(p.label, l.label) AS label FROM l{k - 1} l LEFT JOIN (
    SELECT dst_ AS id, label FROM (
      SELECT m.dst_, x.label, COUNT(*) AS n,
             ROW_NUMBER() OVER (PARTITION BY m.dst_ ORDER BY COUNT(*) DESC, x.label ASC) AS rk
      FROM m JOIN l{k - 1} x ON x.id = m.frm GROUP BY m.dst_, x.label) WHERE rk = 1) p
  ON p.id = l.id)""")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, label FROM l{rounds}"


@query("label_propagation", sql=_lpa_sql(LPA_ROUNDS))
def label_propagation_q(spark, sf_dir):
    """Community label of every vertex of the item graph after up to
    50 synchronous rounds (ties: smallest label)."""
    return label_propagation(_stored(ds.item_graph(spark, sf_dir)), rounds=LPA_ROUNDS)


@query("community_sizes", sql=_lpa_sql(LPA_ROUNDS).replace(f"\nSELECT id, label FROM l{LPA_ROUNDS}", f"""
SELECT label, COUNT(*) AS size, (SELECT COUNT(DISTINCT label) FROM l{LPA_ROUNDS}) AS communities
FROM l{LPA_ROUNDS} GROUP BY label ORDER BY size DESC, label ASC LIMIT 1"""))
def community_sizes(spark, sf_dir):
    """The largest community of the item graph, and how many there are."""
    g = _stored(ds.item_graph(spark, sf_dir))
    sizes = comp.component_sizes(label_propagation(g, rounds=LPA_ROUNDS), "label")
    release(g)
    # the largest first (ties: smaller label) and the number in one aggregate
    best = sizes.agg(F.max(F.struct("size", (-F.col("label")).alias("neg"))).alias("b"), F.count(F.lit(1)).alias("communities"))
    return best.where("communities > 0").select((-F.col("b.neg")).alias("label"), "b.size", "communities")


# ---- DAG distances and a custom vertex program ----

_DAG_SQL = f"""WITH RECURSIVE {_LAYERED},
d(v, k) AS (SELECT id, 0 FROM (SELECT src AS id FROM lg UNION SELECT dst FROM lg)
            UNION SELECT e.dst, d.k + 1 FROM d JOIN lg e ON e.src = d.v)
SELECT v AS id, MAX(k) AS distance FROM d GROUP BY v"""


@query("dag_longest_distance", sql=_DAG_SQL + " ORDER BY distance DESC, id ASC LIMIT 20")
def dag_longest_distance(spark, sf_dir):
    """Longest distance from any root (Pregel form), top 20."""
    d = longest_distance(_stored(ds.layered_edges(spark, sf_dir)), pregel=True)
    return d.orderBy(F.col("distance").desc(), F.col("id").asc()).limit(20)


@query("dag_longest_distance_iter", sql=_DAG_SQL)
def dag_longest_distance_iter(spark, sf_dir):
    """The same by full neighbour aggregation every round until
    nothing changes; every vertex's distance."""
    return longest_distance(_stored(ds.layered_edges(spark, sf_dir)), pregel=False)


@query("propagate_custom", sql=f"""WITH RECURSIVE {_DG},
r(v, a) AS (SELECT id, id FROM (SELECT src AS id FROM dg UNION SELECT dst FROM dg)
            UNION SELECT e.dst, r.a FROM r JOIN dg e ON e.src = r.v)
SELECT v AS id, MIN(a) AS root FROM r GROUP BY v
""")
def propagate_custom(spark, sf_dir):
    """A user-defined vertex program -- the smallest id among each
    vertex's ancestors (itself included): message = source value, merge =
    min, update = least(old, message)."""
    e = _stored(ds.dag_edges(spark, sf_dir).select("src", "dst").distinct())
    state = vertices_of(e).select("id", F.col("id").alias("value"))
    out = propagate(e, state, message=lambda v, _e: v, merge="min",
                    update=lambda old, msg: F.least(old, msg), max_iter=None)
    return out.select("id", F.col("value").alias("root"))
