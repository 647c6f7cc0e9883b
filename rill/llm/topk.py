"""Exact top-k by inner product with pivot-table elimination.

Inner product and Euclidean distance are tied by the norms,
``<q,x> = (|q|^2 + |x|^2 - d(q,x)^2) / 2``, and by the triangle inequality a
pivot p gives ``d(q,x) >= |d(q,p) - d(x,p)|``.  Distances to ``PIVOTS`` pivots
are computed once per vector; the largest lower bound over the pivots bounds a
score from above.  Candidates are evaluated in order of their bounds, and a
query is done when the next bound is below its k-th score, so the result is
exact whatever the pivots.

Queries meet all vectors in blocks of bounded size: rows are dealt to
``CANDIDATES`` (``QUERIES``) at a time by a hash of a row number, which no value
in the data can make uneven.  Every pair of blocks yields k rows per query; a
ranking over these is the result.

Defined cases: vectors that are null or hold a null or non-finite component take
no part; a shorter vector counts as filled up with zeros; a row is no candidate
of itself, but rows that repeat (also with its id) are; ties go to the smaller
id, null ids last; scores that may not fit a long are an error; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rill.session import cut_lineage

PIVOTS, PIVOT_SAMPLE = 32, 512
CANDIDATES, QUERIES = 4096, 1024
#: Candidates of each query that are evaluated between two looks at the bound.
STEP = 256


def matrix(lists: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists as rows, short ones filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), max(width, int(size.max(initial=0)))), np.int64)
    column = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), column] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, v (whole numbers) and row (a number of its own) of valid vectors."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.filter(fine).select(F.col(id_col).alias("id"), whole.alias("v"),
                                       F.xxhash64(F.monotonically_increasing_id()).alias("row"))


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots that are far from each other, one after the other."""
    chosen = [0]
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(v.shape[1], pivots.shape[1])
    v, pivots = (np.pad(a, ((0, 0), (0, width - a.shape[1]))).astype("f8") for a in (v, pivots))
    return np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in pivots], 1) if len(v) else np.zeros((0, len(pivots)))


def best(q: np.ndarray, q_far: np.ndarray, q_row: np.ndarray, x: np.ndarray, x_far: np.ndarray, x_row: np.ndarray,
         x_rank: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its number, the places of its best candidates and their
    scores.  ``x_rank`` is the order in which ties are taken."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (q, x))
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(width, 1)
    if most >= 2 ** 63:
        raise ValueError("scores may not fit a long")
    exact = x.astype("f8") if most < 2 ** 53 else x     # sums of whole numbers below 2^53 are exact
    q_norm, x_norm = (a.astype("f8") ** 2 for a in (q, x))
    q_norm, x_norm = q_norm.sum(1), x_norm.sum(1)
    for i in range(len(q)):
        apart = np.abs(x_far - q_far[i]).max(1) if x_far.shape[1] else np.zeros(len(x))
        bound = (q_norm[i] + x_norm - apart * apart) / 2
        slack = 1 + 1e-9 * (q_norm[i] + x_norm.max(initial=0))     # rounding of the bound
        order = np.argsort(-bound)
        order = order[x_row[order] != q_row[i]]
        mine = q[i].astype(exact.dtype)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, len(order), STEP):
            if len(scores) >= k and bound[order[a]] + slack < scores[-1]:
                break
            new = order[a:a + STEP]
            places = np.append(places, new)
            scores = np.append(scores, (exact[new] @ mine).astype(np.int64))
            first = np.lexsort((x_rank[places], -scores))[:k]
            places, scores = places[first], scores[first]
        yield i, places, scores


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 1024) -> DataFrame:
    """query_id, rank, ``id_col`` and score of the k best of each query.
    ``is_query`` is a condition on the column ``id``."""
    rows = cut_lineage(scaled(vectors, id_col, vector_col, scale))
    kind = rows.schema["id"].dataType.simpleString()
    # a bounded sample; the result does not depend on it
    sample = [r["v"] for r in rows.orderBy("row").limit(PIVOT_SAMPLE).select("v").collect()]
    pivots = far_apart(matrix(pa.array(sample, pa.list_(pa.int64()))).astype("f8"), PIVOTS) if sample else np.zeros((0, 0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = distances(matrix(b.column("v")), pivots)
            at = pa.array(np.arange(len(b) + 1, dtype=np.int32) * far.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(at, pa.array(far.reshape(-1)))],
                                             [*b.schema.names, "far"])

    rows = cut_lineage(rows.mapInArrow(measure, f"id {kind}, v array<long>, row long, far array<double>"))
    asked = rows.filter(is_query)
    n, m = rows.count(), asked.count()
    blocks = lambda count, size: F.lit(max(1, -(-count // size)))
    n, m = blocks(n, CANDIDATES), blocks(m, QUERIES)
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    cells = rows.select("*", F.pmod("row", n).cast("int").alias("c"), every(m).alias("q")).groupBy("c", "q")
    asked = asked.select("*", F.pmod(F.xxhash64("row"), m).cast("int").alias("q"), every(n).alias("c")).groupBy("c", "q")
    schema = f"query_id {kind}, query_row long, id {kind}, score long"

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, q_ids = left["id"].combine_chunks(), right["id"].combine_chunks()
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        # equal ids are ties that any order may break
        x, q = matrix(left["v"]), matrix(right["v"])
        far = [np.asarray(t["far"].combine_chunks().flatten()).reshape(len(t), -1) if len(t) else np.zeros((0, len(pivots)))
               for t in (right, left)]
        owner, places, scores = [], [], []
        for i, p, s in best(q, far[0], right["row"].to_numpy(), x, far[1], left["row"].to_numpy(), place, k):
            owner.append(np.full(len(p), i))
            places.append(p)
            scores.append(s)
        owner, places, scores = (np.concatenate([np.zeros(0, np.int64), *a]) for a in (owner, places, scores))
        return pa.table([q_ids.take(pa.array(owner)), right["row"].combine_chunks().take(pa.array(owner)),
                         ids.take(pa.array(places)), pa.array(scores, pa.int64())],
                        names=["query_id", "query_row", "id", "score"])

    found = cells.cogroup(asked).applyInArrow(pair, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
