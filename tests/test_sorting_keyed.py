"""Sort validation, row numbering and keyed-table round trips."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rill.operators import keyed as kt
from rill.operators.sorting import add_row_index, global_sort, validate_sorted


def test_validator_accepts_sorted_and_rejects_unsorted(spark):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(200)], "key string")
    good = validate_sorted(global_sort(df.orderBy(F.rand(3)), "key", 4), "key").first()
    assert good.rows == 200 and good.partitions_ordered and good.boundaries_ordered
    bad = validate_sorted(df.repartition(4), "key").first()
    assert not (bad.partitions_ordered and bad.boundaries_ordered)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80))
def test_row_index_is_dense_and_ordered(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = add_row_index(df, ["v"], partitions=3).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(len(values)))
    assert [r.v for r in got] == sorted(values)


def test_key_regions_byte_order(spark):
    df = spark.createDataFrame([(k,) for k in ["0", "19", "2", "20", "39", "5", "60", "7", "99"]],
                               "row_key string")
    got = {r.row_key: r.region for r in df.select("row_key", kt.key_region("row_key").alias("region")).collect()}
    assert got == {"0": 0, "19": 0, "2": 0, "20": 1, "39": 1, "5": 2, "60": 3, "7": 3, "99": 3}


def test_upsert_get_delete_round_trip(spark):
    base = spark.createDataFrame([("1", "a", 10), ("2", "b", 20)], "row_key string, w string, n int")
    puts = spark.createDataFrame([("2", 21), ("3", 30)], "row_key string, n int")
    up = {r.row_key: (r.w, r.n) for r in kt.upsert(base, puts).collect()}
    assert up == {"1": ("a", 10), "2": ("b", 21), "3": (None, 30)}
    table = kt.upsert(base, puts)
    assert kt.get(table, "2").first().n == 21
    gone = kt.delete_keys(table, spark.createDataFrame([("2",), ("9",)], "row_key string"))
    assert sorted(r.row_key for r in gone.collect()) == ["1", "3"]
    assert kt.get(gone, "2").count() == 0


def test_puts_of_one_cell_do_not_depend_on_row_order(spark):
    base = spark.createDataFrame([("1", "a", 10)], "row_key string, w string, n int")
    rows = [("1", "x", 11, 2), ("1", "y", 12, 1), ("1", "z", None, 0), ("2", "p", 5, 7), ("2", "q", 6, 7)]
    for order in (rows, rows[::-1]):
        puts = spark.createDataFrame(order, "row_key string, w string, n int, v long").coalesce(1)
        got = {r.row_key: (r.w, r.n) for r in kt.upsert(base, puts, version="v").collect()}
        assert got == {"1": ("x", 11), "2": ("q", 6)}


def test_load_layout_spreads_a_region(spark):
    df = spark.range(8000).select(F.concat(F.lit("7"), F.col("id").cast("string")).alias("row_key"))
    parts = [len(p) for p in kt.bulk_load_layout(df, "row_key").rdd.glom().collect()]
    assert sum(parts) == 8000 and sum(n > 0 for n in parts) >= 4


def test_region_table_rewrites_touched_regions_only(spark, tmp_dir):
    from rill.operators.keyed import RegionTable

    t = RegionTable(spark, f"{tmp_dir}/t", splits=("20", "40", "60"))
    rows = [(f"{i:02d}", i, "v") for i in range(100)]
    t.load(spark.createDataFrame(rows, "row_key string, n int, s string"))
    files = lambda: {(r.region, r.file, r.modified) for r in t.files().collect()}
    before = files()
    assert {r[0] for r in before} == {0, 1, 2, 3}
    # two puts of one cell, a new key, and columns that a put does not name
    puts = spark.createDataFrame([("21", 7, 1), ("21", 8, 2), ("2x", 9, 1)], "row_key string, n int, v int")
    assert t.put(puts, version="v") == [1]
    changed = {r[0] for r in before ^ files()}
    assert changed == {1}
    got = {r.row_key: (r.n, r.s) for r in t.read().collect()}
    assert got["21"] == (8, "v") and got["2x"] == (9, None) and got["22"] == (22, "v") and len(got) == 101
    assert [tuple(r) for r in t.get("21").collect()] == [("21", 8, "v")] and t.get("zz").count() == 0
    # a region that loses all its rows, and puts into it afterwards
    assert t.delete(t.read().where("region = 3")) == [3]
    assert t.read().where("region = 3").count() == 0 and t.read().count() == 61
    assert t.put(spark.createDataFrame([("99", 1)], "row_key string, n int")) == [3] and t.get("99").count() == 1
    assert t.put(puts.limit(0)) == [] and t.delete(puts.limit(0)) == []


def test_keyed_table_follows_its_source(spark, tmp_dir):
    """Another table under the same path, and a cleared checkpoint folder."""
    from conftest import SF_SMALL
    from rill.plans import datasets as ds
    from rill.session import release

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    li.limit(40).coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    first = ds.keyed_table(spark, tmp_dir)
    assert first.count() == 40 and ds.keyed_table(spark, tmp_dir) is first
    li.limit(25).coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/lineitem.parquet")
    second = ds.keyed_table(spark, tmp_dir)
    assert second.count() == 25
    gone, path = second, second._rill_cut
    release(second)
    gone._rill_cut = path                       # files gone behind the cache's back
    assert ds.keyed_table(spark, tmp_dir).count() == 25


def test_upsert_shuffles_plain_base_rows(spark):
    """Explicit empty cells, repeated and empty keys; base rows carry no versions through the shuffle."""
    base = spark.createDataFrame([("a", 1, 9), ("a", 2, None), (None, 3, 3), (None, 4, 1), ("b", 5, 5)], "row_key string, w int, n int")
    puts = spark.createDataFrame([("a", None, 1), ("b", 7, 1), ("b", None, 2), ("c", 8, 1), (None, 6, 0)], "row_key string, n int, v int")
    up = kt.upsert(base, puts, version="v")
    assert {(r.row_key, r.w, r.n) for r in up.collect()} == {("a", 2, None), (None, 4, 6), ("b", 5, None), ("c", None, 8)}
    assert {tuple(r) for r in kt.upsert(base, puts.select("row_key").where("v = 2")).collect()} == {
        ("a", 2, 9), (None, 4, 3), ("b", 5, 5)}
    assert "REPARTITION_BY_COL" in up._jdf.queryExecution().executedPlan().toString()


def test_row_index_broadcasts_its_offsets(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("k"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")         # as if nothing were known to be small
    try:
        got = add_row_index(df, "k", keep=["v"])
        assert sorted(map(tuple, got.collect())) == sorted((i, i * 7 % 50) for i in range(50))
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
