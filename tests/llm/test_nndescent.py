"""Nearest neighbours found by graph search against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID
from rill.llm import nndescent, queries


def brute(rows, k):
    """Of every row its nearest others: (place of the row, [(score, id)])."""
    valid = [(n, i, v) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, _, v in valid), default=0)
    x = np.array([v + [0.0] * (width - len(v)) for _, _, v in valid])
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    score = x @ x.T
    out = []
    for a, (_, i, _) in enumerate(valid):
        others = sorted((-round(score[a, b], 12), j is None, j or 0) for b, (_, j, _) in enumerate(valid) if b != a)
        out.append((i, [(None if none else j, -s) for s, none, j in others[:k]]))
    return out


def found(spark, rows, condition, k=5, **sizes):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, score int, v string")
    build = {n: sizes.pop(n) for n in ("near", "cell", "part", "passes", "block", "settled") if n in sizes}
    index = nndescent.build(docs.repartition(3), k + 1, **build)
    asked = nndescent.valid(docs, "vec_id", "embedding").filter(condition)
    got = {}
    for r in nndescent.search(index, asked, k, **sizes).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def odd_rows():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(250)]
    rows += [(1000 + i, [0.5, -1.0] * 3) for i in range(150)]             # a third of all rows alike
    rows += [(500, None), (501, [1.0, None]), (502, [math.nan] * 6), (503, [math.inf] * 6), (504, []), (505, [2.0, 0.1]),
             (506, [0.0] * 6), (None, [9.0] * 6), (600, [1.0] * 9), (700, [1e200] * 6), (750, [1e-200, 0.0])]
    return rows


def test_all_rows_as_queries(spark):
    """Within one cell the lists are exact, so all results are."""
    rows = odd_rows()
    got = found(spark, rows, F.col("id").isNotNull())
    want = {i: w for i, w in brute(rows, 5) if i is not None}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert [(r, j) for r, j, _ in got[i]] == [(r + 1, j) for r, (j, _) in enumerate(w)]
        assert all(abs(s - t) < 1e-9 for (_, _, s), (_, t) in zip(got[i], w, strict=True))


def test_recall_with_small_cells(spark):
    """Cells far smaller than the table, so lists must come from the rounds, and
    reverse neighbours of a node in several groups."""
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.normal(size=(1500, 8)))]
    got = found(spark, rows, F.col("id") % 20 == 0, near=10, cell=64, part=6, passes=2, block=100, settled=0.02, beam=60)
    want = {i: {j for j, _ in w} for i, w in brute(rows, 5) if i % 20 == 0}
    assert np.mean([len({j for _, j, _ in got[i]} & w) / 5 for i, w in want.items()]) >= 0.95
    assert all(len(got[i]) == 5 for i in want)


def test_few_rows_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 2.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = nndescent.build(docs, 6)
    got = nndescent.search(index, nndescent.valid(docs, "vec_id", "embedding").filter("id = 0"), 5).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 0, 1.0)] * 2 + [(0, 2, 50, 0.0)] * 2
    one = docs.filter("vec_id = 50")
    assert nndescent.search(nndescent.build(one, 6), nndescent.valid(one, "vec_id", "embedding"), 5).count() == 0
    none = docs.limit(0)
    assert nndescent.search(nndescent.build(none, 6), nndescent.valid(none, "vec_id", "embedding"), 5).count() == 0


def test_queries_outside_the_index(spark):
    rng = np.random.default_rng(9)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.normal(size=(300, 5)))]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(7, [0.3, -0.2, 0.9, 0.1, 0.0])], "id long, v array<double>")
    got = [r["vec_id"] for r in nndescent.search(nndescent.build(docs, 4), asked, 3).orderBy("rank").collect()]
    assert got == [j for j, _ in brute([(-1, asked.first()["v"]), *rows], 3)[0][1]]


def test_given_vectors(spark):
    vectors = [(r["vec_id"], list(map(float, r["embedding"]))) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    got = {}
    for r in queries.op11_nearest_neighbours(spark, SF_MID).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = {i: [j for j, _ in w] for i, w in brute(vectors, 5) if i % 50 == 0}
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[i].values()) & set(w)) / 5 for i, w in want.items()]) >= 0.99
