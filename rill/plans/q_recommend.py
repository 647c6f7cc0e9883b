"""Recommendation queries.  Factors are no SQL; the queries return what must hold
of any good model, and SQL states the same: ten different items with ranks 1 to 10
for every user, and a held-out error far below the spread of the ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from rill.operators.recommend import fit_als, grid_search, top_items
from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.session import cut_lineage

# A small grid whose outcome SQL can state (two ranks, two regularisations, one
# number of rounds, three folds).  ``grid_search`` defaults to the published 27
# points and five folds; README has what a run of it takes.
SMALL_GRID = {"ranks": (5, 10), "regs": (0.1, 0.01), "rounds": (8,), "folds": 3}


@query("als_top10", sql="""
SELECT DISTINCT o_custkey AS user_id, CAST(10 AS BIGINT) AS items, 1 AS first_rank, 10 AS last_rank,
       CAST(10 AS BIGINT) AS ranks
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def als_top10(spark, sf_dir):
    """ALS (rank 50, 10 rounds, reg 0.01) on every rating, then the
    ten best items of every user."""
    r = cut_lineage(ds.ratings(spark, sf_dir))      # read by the fit and the user list
    top = top_items(fit_als(r, rank=50, max_iter=10, reg=0.01), r, 10)
    return top.groupBy("user_id").agg(
        F.count_distinct("item_id").alias("items"), F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"), F.count_distinct("rank").alias("ranks"))


@query("als_grid_mse", sql="""
SELECT rank, reg, 8 AS rounds, true AS learned
FROM (VALUES (5), (10)) a(rank), (VALUES (CAST(0.1 AS DOUBLE)), (CAST(0.01 AS DOUBLE))) b(reg)
""")
def als_grid_mse(spark, sf_dir):
    """Cross-validated error per grid point; each must be below
    the ratings' variance."""
    # every fold split and fit re-reads the ratings: write them once
    r = cut_lineage(ds.ratings(spark, sf_dir))
    spread = r.agg(F.variance("rating")).first()[0]
    grid = grid_search(r, parallelism=4, **SMALL_GRID)
    return grid.select("rank", "reg", "rounds", (F.col("mse") < spread).alias("learned"))
