"""Similarity queries over user-item baskets: shared-item pairs, Jaccard
top-k, audit lists, overlap-ratio ranks, wide pivots and flag counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rill.operators.relational import pivot_ranks
from rill.operators.similarity import top_k_similar, top_pairs, unordered_pairs
from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.session import cut_lineage

# Oracle building blocks (DuckDB): baskets, per-user counts, shared counts.
_B = """b AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i
              FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""
_N = "n AS (SELECT u, COUNT(*) AS n FROM b GROUP BY u)"
_P = """p AS (SELECT b1.u AS u1, b2.u AS u2, COUNT(*) AS shared
              FROM b b1 JOIN b b2 ON b1.i = b2.i AND b1.u <> b2.u GROUP BY 1, 2)"""
_S = """s AS (SELECT p.u1, p.u2, p.shared, n1.n + n2.n - p.shared AS all_cnt,
                     p.shared / (n1.n + n2.n - p.shared) AS sim
              FROM p JOIN n n1 ON n1.u = p.u1 JOIN n n2 ON n2.u = p.u2)"""
_R = """r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY u1 ORDER BY sim DESC, u2 ASC) AS rk
              FROM s)"""


def _baskets(spark, sf_dir):
    """The basket table, written once: every similarity query reads it two
    to four times (block plan, users, pairs), and recomputing the
    orders-lineitem join each time would dominate at scale."""
    return cut_lineage(ds.baskets(spark, sf_dir), tidy=True)


def _ranked_lists(b, k):
    top = top_k_similar(b, k=k, stored=True)
    ordered = F.array_sort(F.collect_list(F.struct("sim_rank", "u2")))
    return top.groupBy("u1").agg(
        F.concat_ws(",", F.transform(ordered, lambda x: x["u2"].cast("string"))).alias("sim_users"),
        F.concat_ws(",", F.transform(ordered, lambda x: x["sim_rank"].cast("string"))).alias("sim_ranks"))


@query("top_pairs_shared_items", sql=f"""
WITH {_B}, {_P}
SELECT u1, u2, shared AS common_cnt FROM p ORDER BY shared DESC, u1, u2 LIMIT 10
""")
def top_pairs_shared_items(spark, sf_dir):
    """The ten ordered user pairs sharing the most items."""
    return top_pairs(_baskets(spark, sf_dir), k=10)


@query("top3_similar_users", sql=f"""
WITH {_B}, {_N}, {_P}, {_S}, {_R}
SELECT d.u AS user_id, string_agg(CAST(r.u2 AS VARCHAR), ',' ORDER BY r.rk) AS sim_users
FROM (SELECT DISTINCT u FROM b) d LEFT JOIN r ON r.u1 = d.u AND r.rk <= 3
GROUP BY d.u
""")
def top3_similar_users(spark, sf_dir):
    """Every user's three most similar users by
    Jaccard (ties: smaller id); users sharing nothing get a null list."""
    b = _baskets(spark, sf_dir)
    users = b.select("user_id").distinct()
    lists = _ranked_lists(b, 3)
    return (users.join(lists, users.user_id == lists.u1, "left")
            .select("user_id", "sim_users"))


@query("top3_similar_users_right_join", sql=f"""
WITH {_B}, {_N}, {_P}, {_S}, {_R},
best AS (SELECT u1, list(u2 ORDER BY rk) AS who, list(rk ORDER BY rk) AS place FROM r WHERE rk <= 3 GROUP BY u1)
SELECT n.u AS user_id, array_to_string(who, ',') AS sim_users_list, array_to_string(place, ',') AS sim_rank_list
FROM n LEFT JOIN best ON n.u = best.u1
""")
def top3_similar_users_right_join(spark, sf_dir):
    """The same lists (with their rank lists) right-joined to all users."""
    b = _baskets(spark, sf_dir)
    users = b.select(F.col("user_id").alias("uid")).distinct()
    lists = _ranked_lists(b, 3)
    return (lists.join(users, users.uid == lists.u1, "right")
            .select(F.col("uid").alias("user_id"), F.col("sim_users").alias("sim_users_list"),
                    F.col("sim_ranks").alias("sim_rank_list")))


@query("top15_similarity_audit", sql=f"""
WITH {_B}, {_N}, {_P}, {_S}, {_R}
SELECT u1 AS uid1, u2 AS uid2, shared AS cmn_cnt, all_cnt, sim, rk AS sim_rank
FROM r WHERE rk <= 15
""")
def top15_similarity_audit(spark, sf_dir):
    """Each user's top 15 with every part of the score kept."""
    top = top_k_similar(_baskets(spark, sf_dir), k=15, stored=True)
    return top.select(F.col("u1").alias("uid1"), F.col("u2").alias("uid2"),
                      F.col("shared").alias("cmn_cnt"), "all_cnt", "sim", "sim_rank")


@query("overlap_ratio_rank", sql=f"""
WITH {_B}, {_N}, {_P},
o AS (SELECT p.u1, p.u2, p.shared, n1.n * n2.n AS all_cnt, p.shared / (n1.n * n2.n) AS ratio
      FROM p JOIN n n1 ON n1.u = p.u1 JOIN n n2 ON n2.u = p.u2)
SELECT u1 AS uid1, u2 AS uid2, shared AS cmn_cnt, all_cnt, ratio, sim_rank
FROM (SELECT *, RANK() OVER (PARTITION BY u1 ORDER BY ratio DESC) AS sim_rank FROM o)
WHERE sim_rank <= 3
""")
def overlap_ratio_rank(spark, sf_dir):
    """``shared / (n1 * n2)`` per pair, ``RANK() <= 3`` (ties
    kept) over the pairs that share an item.  A deviation: under ``RANK() <= 3``
    a user with fewer than three neighbours would also get all users that it
    shares nothing with (ratio 0); these are left out, as listing them needs a
    users x users product."""
    top = top_k_similar(_baskets(spark, sf_dir), k=3, score="overlap", rank_fn="rank", stored=True)
    return top.select(F.col("u1").alias("uid1"), F.col("u2").alias("uid2"),
                      F.col("shared").alias("cmn_cnt"),
                      (F.col("n1") * F.col("n2")).alias("all_cnt"),
                      F.col("sim").alias("ratio"), "sim_rank")


@query("top3_users_wide", sql=f"""
WITH {_B}, {_N}, {_P}, {_S}, {_R}
SELECT u1 AS uid, MAX(u2) FILTER (WHERE rk = 1) AS first_similar, MAX(u2) FILTER (WHERE rk = 2) AS second_similar,
       MAX(u2) FILTER (WHERE rk = 3) AS third_similar
FROM r WHERE rk <= 3 GROUP BY u1 HAVING COUNT(*) = 3
""")
def top3_users_wide(spark, sf_dir):
    """Ranks 1-3 as one wide row per user; users with fewer than three
    similar users are dropped, as the three-way inner join does."""
    top = top_k_similar(_baskets(spark, sf_dir), k=3, stored=True)
    wide = pivot_ranks(top, "u1", "sim_rank", "u2", [1, 2, 3], prefix="v")
    return wide.withColumnsRenamed({"u1": "uid", "v1": "first_similar", "v2": "second_similar", "v3": "third_similar"})


@query("left_join_flags", sql=f"""
WITH {_B}, item_users AS (SELECT i, COUNT(*) AS users FROM b GROUP BY i)
SELECT b.u AS user_id, COUNT(*) AS self_rows, SUM(users - 1) AS pair_rows
FROM b JOIN item_users USING (i) GROUP BY b.u
""")
def left_join_flags(spark, sf_dir):
    """The flag sums of a self left join on item, per user: rows
    pairing the user with itself and rows pairing it with others.

    The join is never built: for user u the self rows are its item count
    and the other rows are the sum over its items of (item degree - 1), so
    one join with the per-item degree gives the same numbers without
    emitting deg(item)^2 rows.
    """
    b = _baskets(spark, sf_dir)
    deg = b.groupBy("item_id").agg(F.count(F.lit(1)).alias("deg"))
    return (b.join(deg, "item_id")
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("self_rows"),
                 F.sum(F.col("deg") - 1).alias("pair_rows")))


@query("nested_filter_count", sql=f"""
WITH {_B}, {_P}, u AS (SELECT DISTINCT u FROM b)
SELECT COALESCE(p.shared, 0) AS common_cnt, COUNT(*) AS pairs
FROM u a CROSS JOIN u c LEFT JOIN p ON p.u1 = a.u AND p.u2 = c.u
WHERE a.u <> c.u
GROUP BY 1
""")
def nested_filter_count(spark, sf_dir):
    """Over all ordered user pairs, how many pairs have each count of
    shared items (the nested FILTER + COUNT inside a pair group).

    Pairs sharing nothing are counted as ``U(U-1) - (pairs sharing
    something)`` from two aggregates, so no users x users product is built.
    """
    b = _baskets(spark, sf_dir)
    # every pair u1 < u2 stands for two ordered ones
    hist = cut_lineage(unordered_pairs(b).groupBy(F.col("shared").alias("common_cnt")).agg(
        (F.count(F.lit(1)) * 2).alias("pairs")))
    n_users = b.agg(F.count_distinct("user_id").alias("v")).select(F.lit("u").alias("kind"), "v")
    n_pairs = hist.agg(F.sum("pairs").alias("v")).select(F.lit("p").alias("kind"), "v")
    zero = (n_users.unionByName(n_pairs)
            .agg((F.max(F.when(F.col("kind") == "u", F.col("v")))
                  * (F.max(F.when(F.col("kind") == "u", F.col("v"))) - 1)
                  - F.coalesce(F.max(F.when(F.col("kind") == "p", F.col("v"))), F.lit(0)))
                 .alias("pairs"))
            .select(F.lit(0).cast("long").alias("common_cnt"), "pairs")
            .where(F.col("pairs") > 0))
    return hist.unionByName(zero)
