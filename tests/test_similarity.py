"""Co-occurrence against a brute-force self-join on small inputs,
including a hot item and a hot user."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rill.operators.similarity import co_occurrence, top_k_similar


def brute_pairs(rows):
    by_item = {}
    for u, i in set(rows):
        by_item.setdefault(i, set()).add(u)
    out = {}
    for users in by_item.values():
        for a in users:
            for b in users:
                if a != b:
                    out[(a, b)] = out.get((a, b), 0) + 1
    return out


def spark_pairs(spark, rows, **kw):
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    return {(r.u1, r.u2): r.shared for r in co_occurrence(df, **kw).collect()}


def skewed_rows(seed=7):
    rnd = random.Random(seed)
    rows = [(u, 0) for u in range(60)]                 # one item everybody has
    rows += [(1, i) for i in range(1, 80)]             # one user with many items
    rows += [(rnd.randrange(60), rnd.randrange(1, 40)) for _ in range(300)]
    return rows


def test_pairs_match_brute_force_whatever_the_split(spark):
    rows = skewed_rows()
    for split in (1, 7, 2_000):
        assert spark_pairs(spark, rows, split=split) == brute_pairs(rows)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 6)), min_size=1, max_size=60))
def test_symmetry_and_range(spark, rows):
    pairs = spark_pairs(spark, rows, split=2)
    assert pairs == brute_pairs(rows)
    for (a, b), c in pairs.items():
        assert pairs[(b, a)] == c and c >= 1


def test_top_k_ties_smaller_id(spark):
    # users 2 and 3 are equally similar to user 1; the smaller id ranks first
    rows = [(1, 10), (2, 10), (3, 10)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    top = top_k_similar(df, k=1, split=2).where(F.col("u1") == 1).collect()
    assert [(r.u2, r.sim) for r in top] == [(2, 1.0)]


def test_pairs_are_counted_and_ranked_after_one_exchange(spark):
    df = spark.createDataFrame(skewed_rows(), "user_id long, item_id long")
    plan = top_k_similar(df, k=3)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate explode")]        # what follows once lists are taken apart
    assert "Exchange" not in above and "Window" in above


def test_filter_on_user_reaches_the_lists_before_the_exchange(spark):
    df = spark.createDataFrame(skewed_rows(), "user_id long, item_id long")
    top = top_k_similar(df, k=3).where(F.col("u1").cast("string").like("%5"))
    below = top._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "EndsWith" in below
    assert {r.u1 % 10 for r in top.collect()} == {5}


def test_top_pairs_counts_once(spark):
    from rill.operators.similarity import top_pairs

    df = spark.createDataFrame(skewed_rows(), "user_id long, item_id long")
    top = top_pairs(df, k=4)
    assert top._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    best = sorted(((-n, a, b) for (a, b), n in brute_pairs(skewed_rows()).items()))[:4]
    assert [(-r.common_cnt, r.u1, r.u2) for r in top.collect()] == best


def test_list_elements_are_one_number_of_least_size(spark):
    from rill.operators.similarity import _lists, unordered_pairs

    for ids, kind in ((lambda u: u - 30, "int"), (lambda u: u * 10**9 - 5, "bigint"), (lambda u: (u - 30) * 3 * 10**17, "struct<"),
                      (lambda u: f"user {u}", "struct<")):
        rows = [(ids(u), i) for u, i in skewed_rows()]
        df = spark.createDataFrame(rows, f"user_id {'string' if isinstance(rows[0][0], str) else 'long'}, item_id long")
        assert dict(_lists(df, "user_id", "item_id", 7, True)[0].dtypes)["all"].startswith(f"array<{kind}")
        for split in (7, 2_000):
            got = co_occurrence(df, split=split).collect()
            assert {(r.u1, r.u2): r.shared for r in got} == brute_pairs(rows) and len(got) == len(brute_pairs(rows))
        half = unordered_pairs(df, split=7).collect()
        assert {(r.u1, r.u2): r.shared for r in half} == {p: n for p, n in brute_pairs(rows).items() if p[0] < p[1]}
        n = {u: len({i for v, i in rows if v == u}) for u, _ in rows}
        assert all((r.n1, r.n2) == (n[r.u1], n[r.u2]) for r in got)


def test_unordered_pairs_match_brute_force_whatever_the_split(spark):
    from rill.operators.similarity import unordered_pairs

    df = spark.createDataFrame([*skewed_rows(), (None, 0), (3, None), (3, 0)], "user_id int, item_id long")
    for split in (1, 7, 2_000):
        got = unordered_pairs(df, split=split).collect()
        want = {p: n for p, n in brute_pairs(skewed_rows()).items() if p[0] < p[1]}
        assert {(r.u1, r.u2): r.shared for r in got} == want and len(got) == len(want)


def test_stored_best_are_found_in_turns_that_leave_no_shuffle_files(spark, monkeypatch):
    from rill.operators import similarity

    df = spark.createDataFrame(skewed_rows(), "user_id long, item_id long")
    once = top_k_similar(df, k=3).collect()
    monkeypatch.setattr(similarity, "SLICE_PAIRS", 2_000)
    top = top_k_similar(df, k=3, stored=True)
    assert "RepartitionByExpression" not in top._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(top.collect()) == sorted(once)


def test_tidy_cut_deletes_its_shuffle_files(spark):
    from rill.session import _CLEANUP, cut_lineage

    known = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    ids = lambda: {*known.keySet().mkString(",").split(",")} - {""}
    before, setting = ids(), spark.conf.get(_CLEANUP, None)
    out = cut_lineage(spark.range(1000).repartition(5, "id"), tidy=True)
    assert ids() <= before and out.count() == 1000 and spark.conf.get(_CLEANUP, None) == setting
