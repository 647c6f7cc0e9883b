"""File sources and sinks round-trip small files with bad fields,
headers, comments and gzip."""

import gzip
import os

from rill.sources import files, sinks


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)
    return path


def test_delimited_bad_field_is_null_and_gzip(spark, tmp_dir):
    p = _write(f"{tmp_dir}/a/x.tsv", "ab\t1999\t5\t3\ncd\tnope\t7\t1\n")
    g = _write(f"{tmp_dir}/b/y.tsv.gz", "ef\t2000\t2\t2\n", gz=True)
    schema = "bigram string, year int, match_count int, volume_count int"
    rows = files.read_delimited(spark, [p, g], schema).orderBy("bigram").collect()
    assert [(r.bigram, r.year) for r in rows] == [("ab", 1999), ("cd", None), ("ef", 2000)]


def test_csv_header_and_typed_ratings(spark, tmp_dir):
    p = _write(f"{tmp_dir}/r.csv", "userId,movieId,rating,timestamp\n1,2,4.5,99\n3,4,1.0,98\n")
    assert files.read_csv_header(spark, p).schema["rating"].dataType.simpleString() == "string"
    r = files.read_ratings(spark, p)
    assert r.columns == ["userId", "movieId", "rating"] and r.count() == 2


def test_csv_files_with_different_headers(spark, tmp_dir):
    a = _write(f"{tmp_dir}/y1.csv", "CCN,OFFENSE\n1,x\n")
    b = _write(f"{tmp_dir}/y2.csv", "CCN,OFFENSE,METHOD\n2,y,GUN\n")
    df = files.read_csv_files(spark, [a, b])
    assert sorted(df.columns) == ["CCN", "METHOD", "OFFENSE"] and df.count() == 2


def test_edge_lists(spark, tmp_dir):
    t = _write(f"{tmp_dir}/e.tsv", "# comment\n1\t2\n2\t3\n")
    assert [tuple(r) for r in files.read_edge_tsv(spark, t).collect()] == [(1, 2), (2, 3)]
    w = _write(f"{tmp_dir}/e.txt", "# c\n1 2\n\n3   4\n")
    assert [tuple(r) for r in files.read_edge_list(spark, w).collect()] == [(1, 2), (3, 4)]
    for read, sep in ((files.read_edge_tsv, "\t"), (files.read_edge_list, " ")):
        bad = _write(f"{tmp_dir}/bad{len(sep)}{ord(sep)}.txt",
                     f"1{sep}2\n7\nx{sep}3\n  # c\n4{sep}99999999999999999999\n5{sep}6\n")
        edges = read(spark, bad)
        assert len(edges.collect()) == edges.count() == 5
        assert sorted(map(tuple, files.complete_edges(edges).collect())) == [(1, 2), (5, 6)]
        assert files.bad_edges(edges).first()["bad"] == 3
    h = _write(f"{tmp_dir}/m.tsv", "USERID\tTARGETID\tTIMESTAMP\n1\t9\t10.5\n")
    assert files.read_tsv_renamed(spark, h, {"USERID": "src", "TARGETID": "dst"}).columns[:2] == ["src", "dst"]


def test_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n long").repartition(2)
    sinks.write_delimited(df, f"{tmp_dir}/k1")
    back = files.read_delimited(spark, f"{tmp_dir}/k1", "w string, n long")
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2)]
    sinks.write_report_csv(df, f"{tmp_dir}/k3")
    parts = [f for f in os.listdir(f"{tmp_dir}/k3") if f.startswith("part-")]
    assert len(parts) == 1
    sinks.write_text(df, f"{tmp_dir}/k2")
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/k2").collect()) == ["a\t1", "b\t2"]
    assert len(sinks.show_rows(df, 1)) == 1


def test_managed_table_truncate_and_append(spark):
    sinks.create_table(spark, "gbook", "bigram STRING, year INT", database="rill_test")
    sinks.truncate_table(spark, "rill_test.gbook")
    a = spark.createDataFrame([("x", 1999)], "bigram string, year int")
    b = spark.createDataFrame([("y", 2001)], "bigram string, year int")
    sinks.load_into(a, "rill_test.gbook", overwrite=True)
    sinks.load_into(b, "rill_test.gbook")
    assert spark.table("rill_test.gbook").count() == 2
    sinks.load_into(b, "rill_test.gbook", overwrite=True)
    assert spark.table("rill_test.gbook").count() == 1
