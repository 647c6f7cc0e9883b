"""Exact top-k against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from rill.llm import queries, topk
from tools.check_oracle import compare


def brute(rows, is_query, k=10, scale=1024):
    valid = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in valid:
        if i is not None and is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0)
                            for m, j, v in valid if m != n)
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def odd_vectors():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]                 # a third of all rows alike
    rows += [(500, None), (501, [1.0, None]), (502, [math.nan] * 6), (503, [math.inf] * 6), (504, []), (505, [2.0]),
             (None, [9.0] * 6), (600, [1.0] * 9), (0, [3.0] * 6), (600, [1.0] * 9)]
    return rows


@pytest.mark.parametrize(("cells", "asked"), [(64, 8), (4096, 1024)])
def test_odd_vectors(spark, monkeypatch, cells, asked):
    monkeypatch.setattr(topk, "CANDIDATES", cells)
    monkeypatch.setattr(topk, "QUERIES", asked)
    monkeypatch.setattr(topk, "STEP", 16)
    rows = odd_vectors()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = topk.search(docs.repartition(3), F.col("id") % 20 == 0).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, lambda i: i % 20 == 0)


def test_few_vectors(spark):
    docs = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(docs, F.col("id") % 20 == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.search(docs.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bounds_stop_early():
    """Close groups: most candidates are never evaluated, the result is exact."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-4000, 4000, (40, 16))
    x = (centre[:, None] + rng.integers(-9, 9, (40, 50, 16))).reshape(-1, 16)
    far = topk.distances(x, topk.far_apart(x[::7].astype("f8"), topk.PIVOTS))
    row = np.arange(len(x))
    for i, p, s in topk.best(x[:50], far[:50], row[:50], x, far, row, row, 5):
        all_ = x @ x[i]
        all_[i] = np.iinfo(np.int64).min + 1
        assert list(p) == list(np.lexsort((row, -all_))[:5]) and list(s) == list(all_[p])


def test_large_numbers_are_an_error():
    x = np.full((2, 4), 2 ** 40)
    with pytest.raises(ValueError, match="long"):
        list(topk.best(x, np.zeros((2, 0)), np.arange(2), x, np.zeros((2, 0)), np.arange(2), np.arange(2), 1))


def test_given_vectors(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_MID}/embeddings.parquet')")
    got = queries.op5_exact_top_k(spark, SF_MID).toPandas()
    assert compare(got, con.sql(queries.ORACLES["op5_exact_top_k"]).df()) == "ok"
