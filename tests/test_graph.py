"""Graph operators on literal graphs: drop-out PageRank, components,
strong components, label ties, DAG distances and motifs."""

from pyspark.sql import functions as F

from rill.operators.graph import components as comp
from rill.operators.graph.core import induced_subgraph, max_degree_vertex
from rill.operators.graph.labels import label_propagation
from rill.operators.graph.motif import find_motif
from rill.operators.graph.pagerank import pagerank, personalized_pagerank
from rill.operators.graph.paths import longest_distance


def edges(spark, pairs, extra=None):
    if extra is None:
        return spark.createDataFrame(pairs, "src long, dst long")
    return spark.createDataFrame(pairs, f"src long, dst long, {extra}")


def test_pagerank_drops_vertices_without_in_links(spark):
    # 1 has no in-link: it is ranked in round 0 only
    e = edges(spark, [(1, 2), (2, 3), (3, 2)])
    r = {x.id: x.rank for x in pagerank(e, rounds=1).collect()}
    assert set(r) == {2, 3}
    assert abs(r[2] - (0.15 + 0.85 * 2)) < 1e-12
    r2 = {x.id for x in pagerank(e, rounds=3).collect()}
    assert r2 == {2, 3}


def test_duplicate_edges_count(spark):
    e = edges(spark, [(1, 2), (1, 2), (1, 3), (2, 1), (3, 1)])
    r = {x.id: x.rank for x in pagerank(e, rounds=1).collect()}
    assert abs(r[2] - (0.15 + 0.85 * 2 / 3)) < 1e-12


def test_personalized_rank_resets_to_source(spark):
    e = edges(spark, [(1, 2), (2, 1), (2, 3)])
    r = {x.id: x.rank for x in personalized_pagerank(e, 1, rounds=1).collect()}
    assert r == {1: 0.15, 2: 0.85}


def test_connected_components_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101)]
    labels = {r.id: r.component for r in comp.connected_components(edges(spark, chain)).collect()}
    assert all(labels[i] == 1 for i in range(1, 41))
    assert labels[100] == labels[101] == labels[102] == 100


def test_strong_components(spark):
    e = edges(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (5, 6)])
    got = {r.id: r.scc for r in comp.strongly_connected_components(e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_label_tie_goes_to_smallest(spark):
    # 3 hears 1 and 2 once each in round one: takes 1
    e = edges(spark, [(1, 3), (2, 3)])
    got = {r.id: r.label for r in label_propagation(e, rounds=1).collect()}
    assert got[3] == 1


def test_dag_distance_two_rules_agree(spark):
    e = edges(spark, [(1, 2), (2, 3), (1, 3), (3, 4), (5, 4)])
    a = {r.id: r.distance for r in longest_distance(e, pregel=True).collect()}
    b = {r.id: r.distance for r in longest_distance(e, pregel=False).collect()}
    assert a == b == {1: 0, 2: 1, 3: 2, 4: 3, 5: 0}


def test_motif_time_order(spark):
    e = edges(spark, [(1, 9, 1.0), (2, 9, 2.0), (3, 9, 0.5)], "timestamp double")
    m = find_motif(e, [("a", "e1", "c"), ("b", "e2", "c")],
                   [({"a", "b"}, F.col("a") != F.col("b")),
                    ({"e1", "e2"}, F.col("e1_timestamp") < F.col("e2_timestamp"))])
    assert m.count() == 3


def test_degrees_and_subgraph(spark):
    e = edges(spark, [(1, 2), (1, 3), (2, 3), (4, 3)])
    got = {r.kind: (r.id, r.degree) for r in max_degree_vertex(e).collect()}
    assert got == {"in": (3, 3), "out": (1, 2)}
    keep = spark.createDataFrame([(1,), (3,)], "id long")
    assert [tuple(r) for r in induced_subgraph(e, keep).select("src", "dst").collect()] == [(1, 3)]


def test_motif_counts_without_enumeration(spark):
    from rill.operators.graph.motif import count_converging_pairs, count_two_hop_paths

    rows = [(1, 9, 1.0), (2, 9, 2.0), (3, 9, 2.0), (1, 9, 3.0), (1, 8, 1.0), (2, 8, 1.0), (9, 1, 5.0)]
    e = edges(spark, rows, "timestamp double")
    brute = sum(1 for a in rows for b in rows if a[1] == b[1] and a[0] != b[0] and a[2] < b[2])
    assert count_converging_pairs(e).first().cnt == brute
    hops = sum(1 for a in rows for b in rows if a[1] == b[0])
    assert count_two_hop_paths(e).first().cnt == hops
