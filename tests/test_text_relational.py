"""Tokenising, custom map/reduce and relational helpers on literal frames."""

from pyspark.sql import functions as F

from rill.functions.text import hashtags, integer_text, space_tokens, tokens
from rill.operators.custom import map_combine, tokenize_counts
from rill.operators.relational import (average_per_distinct, complete_row_counts, pivot_ranks,
                                       share_of_total, top_k_per_group, union_counts)


def _counts(df):
    return {r[0]: r[1] for r in df.collect()}


def test_tokens_sample(spark):
    df = spark.createDataFrame([("foo foo quux labs foo bar quux",)], "text string")
    got = _counts(df.select(F.explode(tokens("text")).alias("w")).groupBy("w").count())
    assert got == {"foo": 3, "quux": 2, "labs": 1, "bar": 1}


def test_whitespace_and_empty_tokens(spark):
    df = spark.createDataFrame([("  a\tb\n\nc  ",), ("",), (None,)], "text string")
    toks = [r[0] for r in df.select(F.explode(tokens("text"))).collect()]
    assert sorted(toks) == ["a", "b", "c"]
    single = [r[0] for r in df.select(F.explode(space_tokens("text"))).collect()]
    assert "" in single  # single-space split keeps empties (dropped by the query)


def test_integers_of_any_length(spark):
    texts = ["1", "-22", "+3", "1234567890123", "9" * 38, "9" * 39, "1.5", "x1", "", "٣", "7\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(integer_text("t")).collect()]
    assert [None if v is None else int(v) for v in got] == [1, -22, 3, 1234567890123, int("9" * 38)] + [None] * 7


def test_hashtags(spark):
    df = spark.createDataFrame([("#a b #c,2021-01-01 #late",)], "value string")
    assert [r[0] for r in df.select(F.explode(hashtags("value"))).collect()] == ["#a", "#c"]


def test_map_combine_equals_builtin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    custom = map_combine(docs, tokenize_counts, "word string, cnt long", "word", "cnt")
    builtin = docs.select(F.explode(tokens("text")).alias("word")).groupBy("word").count()
    assert custom.exceptAll(builtin.withColumnRenamed("count", "cnt")).count() == 0
    assert custom.count() == builtin.count()


def test_average_per_distinct_not_avg(spark):
    df = spark.createDataFrame([("x", 2000, 3.0), ("x", 2000, 5.0), ("x", 2001, 4.0)],
                               "k string, y int, c double")
    assert average_per_distinct(df, "k", "y", "c", "a").first()["a"] == 6.0


def test_share_and_topk(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "a", 2), (2, "b", 2)],
                               "y int, k string, n long")
    shares = {(r.y, r.k): r.share for r in share_of_total(df, "y", "n").collect()}
    assert shares[(1, "a")] == 0.75 and shares[(2, "b")] == 0.5
    top = top_k_per_group(df, "y", [F.col("n").desc(), F.col("k")], 1).collect()
    assert sorted((r.y, r.k) for r in top) == [(1, "a"), (2, "a")]
    ranked = top_k_per_group(df, "y", [F.col("n").desc()], 1, rank_fn="rank").collect()
    assert len(ranked) == 3  # the tie in year 2 is kept


def test_null_counts_and_pivot(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, b string")
    r = complete_row_counts(df).first()
    assert (r.total_rows, r.complete_rows) == (3, 1)
    ranks = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 1, 20)],
                                  "u int, rank int, v int")
    wide = pivot_ranks(ranks, "u", "rank", "v", [1, 2, 3]).collect()
    assert [(r.u, r.v1, r.v2, r.v3) for r in wide] == [(1, 10, 11, 12)]


def test_union_counts(spark):
    a = spark.range(5)
    b = spark.range(7)
    got = {r.part: r.rows for r in union_counts({"a": a, "b": b}, whole=spark.range(14)).collect()}
    assert got == {"a": 5, "b": 7, "all": 12, "table": 14}


def test_next_in_group_matches_lead_with_hot_group(spark):
    from pyspark.sql import Window

    from rill.operators.relational import next_in_group

    rows = ([(1, i) for i in range(300)] + [(g, g * 10 + j) for g in range(2, 40) for j in range(3)]
            + [(None, 5), (None, 7), (None, 6)])
    df = spark.createDataFrame(rows, "o long, p long")
    want = {(r.o, r.p): r.nxt for r in df.withColumn(
        "nxt", F.lead("p").over(Window.partitionBy("o").orderBy("p"))).collect()}
    got = next_in_group(df.repartition(5), "o", ["p"], "p")
    assert {(r.o, r.p): r.nxt for r in got.collect()} == want


def test_id_suffix_filter_equals_like(spark):
    from rill.operators.relational import id_ends_with

    df = spark.range(0, 500).withColumnRenamed("id", "uid")
    a = {r.uid for r in df.where(id_ends_with("uid", "35")).collect()}
    b = {r.uid for r in df.where(F.expr("CAST(uid AS STRING) LIKE CONCAT('%', '35')")).collect()}
    assert a == b == {35, 135, 235, 335, 435}


def test_reduce_groups_runs_reducer_per_key(spark):
    import pandas as pd

    from rill.operators.custom import reduce_groups

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "word string, cnt long")

    def reducer(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"word": [pdf.word.iloc[0]], "cnt": [int(pdf.cnt.sum())]})

    got = {r.word: r.cnt for r in reduce_groups(df, "word", reducer, "word string, cnt long").collect()}
    assert got == {"a": 3, "b": 5}


def test_sums_beyond_38_digits(spark):
    from rill.functions.text import exact_sum, integer_text

    big = 10 ** 38 - 1
    cases = {"a": [big, big, 1], "b": [-big, -big], "c": [big, -big], "d": [10 ** 20, -1], "e": [-(10 ** 20), 1], "f": [5, -7],
             "g": [10 ** 19] * 11, "h": [-3, -(10 ** 25), 10 ** 21 + 4], "i": ["x", "1" * 39], "j": [0, "-0"], "k": [big, "x", -1]}
    rows = [(k, str(v)) for k, vs in cases.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, t string").select("k", integer_text("t").alias("v"))
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    want = {k: sum(int(v) for v in vs if str(v).lstrip("-").isdigit() and len(str(v).lstrip("-")) < 39) for k, vs in cases.items()}
    assert got == {k: None if k == "i" else str(v) for k, v in want.items()}


def test_average_per_distinct_by_masks(spark):
    from rill.operators.relational import average_per_distinct

    rows = [(k, y, float(k * y % 7)) for k in range(5) for y in list(range(-70, 400, 3 + k)) * 2] + [(1, None, 4.0), (9, None, 1.0)]
    for width in (1, 50):                       # 50: years too far apart for masks
        df = spark.createDataFrame([(k, None if y is None else y * width, v) for k, y, v in rows], "k int, y int, v double")
        want = df.groupBy("k").agg((F.sum("v") / F.nullif(F.count_distinct("y"), F.lit(0))).alias("avg_value"))
        got = average_per_distinct(df.where("y is not null or k = 1"), "k", "y", "v")
        assert {r.k: r.avg_value for r in got.collect()} == {r.k: r.avg_value for r in want.collect() if r.k != 9}
    plan = average_per_distinct(spark.createDataFrame(rows, "k int, y int, v double"), "k", "y", "v")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_average_per_distinct_of_an_empty_table(spark):
    from rill.operators.relational import average_per_distinct

    df = spark.createDataFrame([], "k int, y int, v double")
    assert average_per_distinct(df, "k", "y", "v").count() == 0


def test_mapper_sees_bounded_text(spark):
    import pandas as pd

    from rill.operators.custom import STEP_CHARS, steps

    texts = ["ab " * (STEP_CHARS // 6), None, "x" * (3 * STEP_CHARS), "", "cd " * (STEP_CHARS // 6), "e", "f g"]
    got = list(steps(pd.DataFrame({"text": texts})))
    assert [t for s in got for t in s.text] == texts
    assert all(len(s) == 1 or s.text.fillna("").str.len().sum() <= STEP_CHARS for s in got)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {r.word: r.cnt for r in map_combine(df, tokenize_counts, "word string, cnt long", "word", "cnt").collect()}
    assert counts == {"ab": STEP_CHARS // 6, "x" * (3 * STEP_CHARS): 1, "cd": STEP_CHARS // 6, "e": 1, "f": 1, "g": 1}
