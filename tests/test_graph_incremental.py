"""Residual rank, bucketed rank, kept votes and crossing intervals, against
plain computations on small graphs."""

import random
from collections import Counter
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from rill.operators.graph import crossing, labels, pagerank
from rill.operators.graph.core import split_hubs
from rill.session import release, store_bucketed


def graph(spark, seed=1, n=30, m=140):
    rng = random.Random(seed)
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(0, i) for i in range(n)]
    return pairs, spark.createDataFrame(pairs, "src long, dst long")


@pytest.fixture(params=[100_000, 3])
def hubs(request, monkeypatch):
    """With vertices in one part, and with nearly all in several."""
    for module in (pagerank, labels):
        monkeypatch.setattr(module, "split_hubs", partial(split_hubs, split=request.param))
    return request.param


# ---- rank to a tolerance ----

def settled(pairs, source, reset=0.15, rounds=400):
    out = Counter(a for a, _ in pairs)
    rank = {source: 1.0}
    for _ in range(rounds):
        new = {source: reset}
        for a, b in pairs:
            if a in rank:
                new[b] = new.get(b, 0) + (1 - reset) * rank[a] / out[a]
        rank = new
    return rank


@pytest.mark.parametrize("tol", [0.3, 0.01, 1e-5])
def test_residual_rank_is_below_the_settled_one_by_what_is_left(spark, hubs, tol):
    pairs, e = graph(spark)
    r = pagerank.residual_pagerank(e, 0, tol)
    assert 0 <= r.residual <= tol + 1e-12 and len(r.pushed) == r.rounds and all(r.pushed)
    want, got = settled(pairs, 0), {x.id: x["rank"] for x in r.ranks.collect()}
    vertices = {v for p in pairs for v in p}
    for v in got:
        assert got[v] <= want[v] + 1e-9
    # each vertex withholds tol at most
    assert sum(want.values()) - sum(got.values()) <= tol * len(vertices) * 1.0 + 1e-9


def test_residual_rounds_follow_the_tolerance(spark):
    """A ring: the mass goes round until it has worn off."""
    e = spark.createDataFrame([(i, (i + 1) % 5) for i in range(5)], "src long, dst long")
    r = pagerank.residual_pagerank(e, 0, 0.01)
    assert r.rounds == next(k for k in range(100) if 0.85 ** k <= 0.01) and r.pushed == [1] * r.rounds


def test_residual_of_a_vertex_without_edges(spark):
    e = spark.createDataFrame([(1, 2)], "src long, dst long")
    r = pagerank.residual_pagerank(e, 9)
    assert [tuple(x) for x in r.ranks.collect()] == [(9, 0.15)] and r.rounds == 1


# ---- buckets ----

@pytest.mark.parametrize("n", [3, 8, 10])
def test_bucketed_rank_equals_the_plain_one(spark, hubs, n):
    _, e = graph(spark, 2)
    plain = {r.id: r["rank"] for r in pagerank.pagerank(e, rounds=5).collect()}
    got = {r.id: r["rank"] for r in pagerank.pagerank(e, rounds=5, partitions=n).collect()}
    assert got.keys() == plain.keys() and all(abs(got[k] - plain[k]) < 1e-12 for k in got)


def test_buckets_are_joined_as_they_lie(spark):
    _, e = graph(spark, 3)
    table = store_bucketed(e, "src")
    sums = e.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n"))
    joined = table.hint("merge").join(sums.hint("merge"), F.col("src") == F.col("id"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert joined.count() > 0
    name = table._rill_table
    release(table)
    assert not spark.catalog.tableExists(name)


@pytest.mark.parametrize("run", ["rank", "program"])
def test_loops_keep_their_edges_in_buckets(spark, monkeypatch, run):
    from rill.operators.graph import propagate

    stored = []
    for module in (pagerank, propagate):
        monkeypatch.setattr(module, "split_hubs", partial(split_hubs, split=3))
        monkeypatch.setattr(module, "store_bucketed", lambda df, keys: stored.append(keys) or store_bucketed(df, keys), raising=False)
    pairs, e = graph(spark, 6)
    before = {t.name for t in spark.catalog.listTables()}
    if run == "rank":
        got = {r.id: r["rank"] for r in pagerank.personalized_pagerank(e, 0, rounds=7).collect()}
        want = settled(pairs, 0, rounds=7)
        assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)
    else:
        state = spark.createDataFrame([(v, v) for v in {v for p in pairs for v in p}], "id long, value long")
        out = propagate.propagate(e, state, lambda v, _e: v, "min", lambda old, msg: F.least(old, msg))
        reach = reachable(pairs)
        assert {r.id: r.value for r in out.collect()} == {v: min(w for w in reach if v in reach[w]) for v in reach}
    assert stored == [["src", "src_part"]] and {t.name for t in spark.catalog.listTables()} == before


# ---- votes ----

def plain_labels(pairs, rounds):
    vertices = {v for p in pairs for v in p}
    label = {v: v for v in vertices}
    for _ in range(rounds):
        votes = {v: Counter() for v in vertices}
        for a, b in pairs:
            votes[b][label[a]] += 1
            votes[a][label[b]] += 1
        label = {v: min(votes[v], key=lambda x: (-votes[v][x], x)) for v in vertices}
    return label


@pytest.mark.parametrize("rounds", [1, 2, 4, 30])
def test_kept_votes_give_the_labels_of_counted_ones(spark, hubs, rounds):
    rng = random.Random(5)
    pairs = [(rng.randrange(8) + 10 * c, rng.randrange(8) + 10 * c) for c in range(6) for _ in range(18)]
    pairs += [(3, 13), (13, 23), (1, 1), (1, 1), (2, 4), (2, 4)]
    heard = []
    got = labels.label_propagation(spark.createDataFrame(pairs, "src long, dst long"), rounds,
                                   told=lambda *x: heard.append(x))
    assert {r.id: r.label for r in got.collect()} == plain_labels(pairs, rounds)
    if rounds == 30 and heard[-1][1] == 0:
        assert heard[-1][2] == 0 and heard[0][2] == max(h[2] for h in heard)


@pytest.mark.parametrize("many", [0.0, 0.3, 1.0])
def test_votes_are_counted_anew_while_many_switch(spark, monkeypatch, many):
    monkeypatch.setattr(labels, "MANY", many, raising=False)
    stored = []
    monkeypatch.setattr(labels, "store_bucketed", lambda df, keys: stored.append(keys) or store_bucketed(df, keys))
    pairs, e = graph(spark, 7, 40, 70)
    heard = []
    got = labels.label_propagation(e, 6, told=lambda *x: heard.append(x))
    assert {r.id: r.label for r in got.collect()} == plain_labels(pairs, 6)
    few = any(0 < n <= many * 40 for _, n, _ in heard)
    assert ("id" in stored) == few and (few or not many)


def test_votes_leave_no_tables_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    _, e = graph(spark, 4)
    labels.label_propagation(e, 6).count()
    assert {t.name for t in spark.catalog.listTables()} == before


# ---- motifs ----

def test_crossing_pairs_of_intervals():
    rng = np.random.default_rng(1)
    for _ in range(150):
        m = int(rng.integers(0, 40))
        g, b = rng.integers(0, 3, m), rng.integers(0, 12, m).astype(float)
        e = b + rng.integers(1, 8, m)
        brute = sum(g[i] == g[j] and b[i] < b[j] < e[i] < e[j] for i in range(m) for j in range(m))
        assert crossing.count_crossings(g, b, e) == brute


@pytest.mark.parametrize(("part", "split"), [(1 << 18, 4000), (7, 5)])
def test_motifs_against_bindings(spark, part, split):
    rng = random.Random(8)
    rows = [(rng.randrange(5), 100 + rng.randrange(4), float(rng.randrange(25))) for _ in range(60)]
    square = fork = 0
    for e1 in rows:
        for e2 in (x for x in rows if x[2] > e1[2] and x[0] != e1[0]):
            for e3 in (x for x in rows if x[2] > e2[2] and x[0] == e1[0] and x[1] != e1[1]):
                for e4 in rows:
                    if e4[2] > e3[2] and e4[0] == e2[0]:
                        square += e4[1] == e1[1] and e2[1] == e3[1]
                        fork += e4[1] == e3[1] and e2[1] not in (e3[1], e1[1])
    e = spark.createDataFrame(rows, "src long, dst long, timestamp double")
    assert square > 50 and fork > 50
    assert crossing.count_square_motif(e, part=part, split=split).first().cnt == square
    assert crossing.count_fork_motif(e, part=part, split=split).first().cnt == fork


def test_ascending_pairs_of_permutations():
    rng = np.random.default_rng(2)
    for n in [0, 1, 2, 3, 8, *rng.integers(2, 70, 60)]:
        x = rng.permutation(int(n))
        assert crossing.count_ascents(x) == sum(
            x[i] < x[j] for j in range(len(x)) for i in range(j))


@pytest.mark.parametrize("part", [1 << 20, 100])
def test_slabs_of_a_large_group(spark, part):
    """One group of 3000 intervals in 60 slabs, many with equal times."""
    rng = np.random.default_rng(3)
    begin = np.minimum(rng.integers(0, 400, 3000), 300)
    end, kind = begin + rng.integers(1, 90, 3000), rng.integers(0, 5, 3000)
    rows = spark.createDataFrame([(1, *map(int, r)) for r in zip(kind, begin, end)], "g long, s long, begin long, end long")
    got = crossing.crossings(rows, ["g"], {"all": [], "same": ["s"]}, part).first()
    b, e = begin[:, None], end[:, None]
    pairs = (b < begin) & (begin < e) & (e < end)
    want = {"all": int(pairs.sum()), "same": int((pairs & (kind[:, None] == kind)).sum())}
    assert got.asDict() == want and want["same"] > 0


def test_motifs_of_an_empty_graph(spark):
    e = spark.createDataFrame([], "src long, dst long, timestamp double")
    assert crossing.count_square_motif(e).first().cnt == 0 and crossing.count_fork_motif(e).first().cnt == 0


# ---- strong components ----

def reachable(pairs):
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
        out.setdefault(b, set())
    reach = {}
    for v in out:
        seen, todo = {v}, [v]
        while todo:
            for w in out[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        reach[v] = seen
    return reach


def check_strong(spark, pairs, **more):
    from rill.operators.graph.components import strongly_connected_components

    e = spark.createDataFrame(pairs, "src long, dst long")
    got = {r.id: r.scc for r in strongly_connected_components(e, **more).collect()}
    reach = reachable(pairs)
    assert got == {v: min(w for w in reach[v] if v in reach[w]) for v in reach if "rounds" not in more or v in got}
    return got


def test_strong_components_of_random_graphs(spark):
    rng = random.Random(11)
    for n, m in ((12, 14), (40, 60), (60, 62)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        check_strong(spark, pairs + [(100, 100), (101, 102), (102, 101)])


def test_strong_components_with_more_than_63_pivots_worth(spark):
    """Many small components in a tree, none of them a chain."""
    pairs = []
    for c in range(80):
        v = [4 * c + k for k in range(4)]
        pairs += [(a, b) for a in v for b in v if a != b]
        pairs += [(v[k], 4 * d + k) for d in (2 * c + 1, 2 * c + 2) if d < 80 for k in range(2)]
    got = check_strong(spark, pairs)
    assert len(set(got.values())) == 80


def test_a_ring_takes_few_rounds(spark):
    from rill.operators.graph.components import strongly_connected_components

    steps = []
    ring = spark.range(10_000).select(F.col("id").alias("src"), ((F.col("id") + 1) % 10_000).alias("dst"))
    got = strongly_connected_components(ring, told=lambda *s: steps.append(s))
    assert got.agg(F.max("scc"), F.count("*")).first()[:] == (0, 10_000) and len(steps) < 60
