"""Sources, sinks and managed tables: a given table is written in the format,
read back by the reader and aggregated; the SQL answers from the table itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.operators import keyed as kt
from rill.operators.custom import map_combine, reduce_groups, tokenize_counts
from rill.operators.graph.pagerank import pagerank
from rill.operators.relational import count_by, id_ends_with
from rill.operators.similarity import top_k_similar
from rill.operators.sorting import global_sort
from rill.plans import datasets as ds
from rill.plans.q_graph import _pr_sql
from rill.plans.q_similarity import _B, _N, _P, _R, _S
from rill.plans.registry import query
from rill.session import cut_lineage
from rill.sources import files, sinks
from rill.sources.tables import table
from rill.streaming.trends import scratch_path

NGRAM_SCHEMA = "bigram long, year int, match_count int"


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum("match_count").cast("long").alias("total"),
                  F.count_distinct("bigram").alias("bigrams"))


_NGRAM_SQL = """SELECT COUNT(*) AS rows, CAST(SUM(l_quantity) AS BIGINT) AS total, COUNT(DISTINCT l_partkey) AS bigrams
FROM lineitem"""


@query("tsv_round_trip", sql=_NGRAM_SQL)
def tsv_round_trip(spark, sf_dir):
    """Tab-separated text with a declared schema."""
    path = scratch_path(spark, "tsv")
    sinks.write_delimited(ds.ngrams(spark, sf_dir).withColumn("match_count", F.col("match_count").cast("int")), path)
    return _rows(files.read_delimited(spark, path, NGRAM_SCHEMA))


@query("gzip_round_trip", sql=_NGRAM_SQL)
def gzip_round_trip(spark, sf_dir):
    """Compressed text files, one task per file."""
    path = scratch_path(spark, "gz")
    rows = ds.ngrams(spark, sf_dir).withColumn("match_count", F.col("match_count").cast("int"))
    rows.write.option("sep", "\t").option("compression", "gzip").csv(path)
    return _rows(files.read_delimited(spark, path, NGRAM_SCHEMA))


@query("bad_fields_are_null", sql="""
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE l_linenumber <> 3) AS good_years FROM lineitem
""")
def bad_fields_are_null(spark, sf_dir):
    """A field that does not parse is null; its row stays."""
    path = scratch_path(spark, "bad")
    year = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.year("l_shipdate").cast("string"))
    sinks.write_delimited(table(spark, sf_dir, "lineitem").select("l_partkey", year.alias("year"), "l_linenumber"), path)
    back = files.read_delimited(spark, path, NGRAM_SCHEMA)
    return back.agg(F.count(F.lit(1)).alias("rows"), F.count("year").alias("good_years"))


@query("yearly_csv_folder", sql="""
SELECT CAST(year(o_orderdate) AS INT) AS year, COUNT(*) AS cnt,
       COUNT(*) FILTER (WHERE year(o_orderdate) >= 1998) AS with_status
FROM orders GROUP BY 1
""")
def yearly_csv_folder(spark, sf_dir):
    """CSV files with header lines, some with a column more, read by
    name as one table; all columns are strings and are cast by the query."""
    path = scratch_path(spark, "years")
    rows = ds.incidents(spark, sf_dir).select("ccn", "report_dat", "shift")
    late = F.substring("report_dat", 1, 4) >= "1998"
    rows.where(~late).drop("shift").write.option("header", True).csv(f"{path}/early")
    rows.where(late).write.option("header", True).csv(f"{path}/late")
    back = files.read_csv_files(spark, [f"{path}/early", f"{path}/late"])
    year = F.year(F.expr("try_to_date(substring_index(report_dat, ' ', 1), 'yyyy/MM/dd')")).alias("year")
    return back.groupBy(year).agg(F.count(F.lit(1)).alias("cnt"), F.count("shift").alias("with_status"))


@query("ratings_csv", sql="""
SELECT COUNT(*) AS rows, CAST(SUM(l_linenumber) AS DOUBLE) AS total FROM lineitem
""")
def ratings_csv(spark, sf_dir):
    """A typed CSV with header; the trailing time is dropped."""
    path = scratch_path(spark, "ratings")
    li = table(spark, sf_dir, "lineitem")
    li.select(F.col("l_orderkey").alias("userId"), F.col("l_partkey").alias("movieId"),
              F.col("l_linenumber").cast("double").alias("rating"), F.lit(99).alias("timestamp")
              ).write.option("header", True).csv(path)
    r = files.read_ratings(spark, path)
    assert r.columns == ["userId", "movieId", "rating"]
    return r.agg(F.count(F.lit(1)).alias("rows"), F.sum("rating").alias("total"))


@query("renamed_tsv", sql="""
SELECT l_linenumber % 2 = 0 AS even, COUNT(*) AS edges, MAX(l_partkey) AS max_dst FROM lineitem GROUP BY 1
""")
def renamed_tsv(spark, sf_dir):
    """A TSV with header whose columns are renamed to those of a graph."""
    path = scratch_path(spark, "renamed")
    li = table(spark, sf_dir, "lineitem")
    li.select(F.col("l_linenumber").alias("USERID"), F.col("l_partkey").alias("TARGETID")
              ).write.option("sep", "\t").option("header", True).csv(path)
    e = files.read_tsv_renamed(spark, path, {"USERID": "src", "TARGETID": "dst"}, "USERID long, TARGETID long")
    return e.groupBy((F.col("src") % 2 == 0).alias("even")).agg(
        F.count(F.lit(1)).alias("edges"), F.max("dst").alias("max_dst"))


@query("edge_lists", sql="""
SELECT kind, COUNT(*) FILTER (WHERE l_linenumber NOT IN (2, 4)) AS edges,
       COUNT(*) FILTER (WHERE l_linenumber = 4) AS bad,
       CAST(SUM(l_orderkey) FILTER (WHERE l_linenumber NOT IN (2, 4)) AS BIGINT) AS src_sum
FROM lineitem, (VALUES ('space'), ('tab')) k(kind) GROUP BY kind
""")
def edge_lists(spark, sf_dir):
    """Edge lists by tab or white space, with comment lines and
    lines that lack a field; the latter are counted, not lost."""
    li = table(spark, sf_dir, "lineitem")
    out = None
    for kind, sep, read in (("tab", "\t", files.read_edge_tsv), ("space", "  ", files.read_edge_list)):
        path = scratch_path(spark, "edges")
        line = F.when(F.col("l_linenumber") == 2, F.concat(F.lit(" # "), "l_orderkey")).when(
            F.col("l_linenumber") == 4, F.col("l_orderkey").cast("string")).otherwise(
            F.concat_ws(sep, "l_orderkey", "l_partkey"))
        sinks.write_text(li.select(line.alias("value")), path)
        e = read(spark, path)
        whole = F.col("src").isNotNull() & F.col("dst").isNotNull()
        one = e.agg(F.lit(kind).alias("kind"), F.count_if(whole).alias("edges"), F.count_if(~whole).alias("bad"),
                    F.sum(F.when(whole, F.col("src"))).alias("src_sum"))
        out = one if out is None else out.unionByName(one)
    return out


@query("text_lines", sql="""
SELECT COUNT(*) AS lines, CAST(SUM(length(line)) AS BIGINT) AS chars
FROM (SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents WHERE text <> '')
""")
def text_lines(spark, sf_dir):
    """Plain text lines, read by a pattern over the part files."""
    path = scratch_path(spark, "lines")
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    sinks.write_text(docs.select(F.regexp_replace("text", "\r", "").alias("text")), path)
    lines = files.read_lines(spark, f"{path}/part-*")
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).cast("long").alias("chars"))


@query("table_load_path", sql="""
SELECT 'first' AS step, COUNT(*) AS rows FROM lineitem WHERE year(l_shipdate) < 1998
UNION ALL SELECT 'appended', COUNT(*) FROM lineitem
UNION ALL SELECT 'truncated', 0
UNION ALL SELECT 'overwritten', COUNT(*) FROM lineitem WHERE year(l_shipdate) >= 1998
""")
def table_load_path(spark, sf_dir):
    """Create if it does not exist, load, append, truncate, overwrite."""
    name = f"rill_load_{uuid.uuid4().hex}"
    ng = ds.ngrams(spark, sf_dir).select("bigram", "year", F.col("match_count").cast("int").alias("match_count"))
    early, late = ng.where("year < 1998"), ng.where("year >= 1998")
    steps = []

    def note(step: str) -> None:
        steps.append((step, spark.table(name).count()))

    sinks.create_table(spark, name, "bigram LONG, year INT, match_count INT")
    sinks.create_table(spark, name, "bigram LONG, year INT, match_count INT")
    sinks.load_into(early, name, overwrite=True)
    note("first")
    sinks.load_into(late, name)
    note("appended")
    sinks.truncate_table(spark, name)
    note("truncated")
    sinks.load_into(early, name)
    sinks.load_into(late, name, overwrite=True)
    note("overwritten")
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(steps, "step string, rows long")


@query("keyed_import", sql="""
SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderpriority) AS priorities, MIN(CAST(o_orderkey AS VARCHAR)) AS first_key,
       MAX(CAST(o_orderkey AS VARCHAR)) AS last_key
FROM orders
""")
def keyed_import(spark, sf_dir):
    """A keyed TSV (first field the row key, string cells) imported into
    the range layout and described by its columns."""
    path = scratch_path(spark, "keyed")
    sinks.write_delimited(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), path)
    t = kt.bulk_load_layout(files.read_keyed_tsv(spark, path, ["priority", "status"]), "row_key")
    assert kt.describe(t) == [("row_key", "string"), ("priority", "string"), ("status", "string")]
    return t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("priority").alias("priorities"),
                 F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"))


@query("report_csv", sql="""
SELECT o_orderpriority AS offense, COUNT(*) AS cnt FROM orders GROUP BY 1
""")
def report_csv(spark, sf_dir):
    """K3/K4/K5: a small report written as one CSV file and read back."""
    path = scratch_path(spark, "report")
    sinks.write_report_csv(count_by(ds.incidents(spark, sf_dir), "offense"), path)
    return files.read_csv_header(spark, path, "offense string, cnt long")


@query("similar_users_by_suffix", sql=f"""
WITH {_B}, {_N}, {_P}, {_S}, {_R}
SELECT u1 AS user_id, u2 AS similar_id, rk AS sim_rank FROM r
WHERE rk <= 3 AND CAST(u1 AS VARCHAR) LIKE '%35'
""")
def similar_users_by_suffix(spark, sf_dir):
    """The report of users whose id ends in 35, as a suffix test and
    as a LIKE on a concatenated pattern."""
    top = top_k_similar(cut_lineage(ds.baskets(spark, sf_dir)), k=3)
    top = top.where(id_ends_with("u1", "35") & F.expr("CAST(u1 AS STRING) LIKE CONCAT('%', '35')"))
    return top.select(F.col("u1").alias("user_id"), F.col("u2").alias("similar_id"), "sim_rank")


@query("mapper_word_count", sql=r"""
SELECT word, COUNT(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '[\t\n\x0B\f\r ]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def mapper_word_count(spark, sf_dir):
    """A mapper over batches with a combiner inside the task."""
    return map_combine(table(spark, sf_dir, "documents").select("text"), tokenize_counts, "word string, cnt long",
                       "word", "cnt")


@query("reducer_by_priority", sql="""
SELECT o_orderpriority AS priority, COUNT(*) AS days, MAX(orders) AS most
FROM (SELECT o_orderpriority, o_orderdate, COUNT(*) AS orders FROM orders GROUP BY ALL) GROUP BY 1
""")
def reducer_by_priority(spark, sf_dir):
    """A reducer over pre-combined groups (one row per day at most)."""
    def reducer(pdf):
        import pandas as pd

        return pd.DataFrame({"priority": [pdf.priority.iloc[0]], "days": [len(pdf)], "most": [int(pdf.orders.max())]})

    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), "o_orderdate").agg(
        F.count(F.lit(1)).alias("orders"))
    return reduce_groups(days.select("priority", "orders"), "priority", reducer, "priority string, days long, most long")


@query("pagerank_sorted_file", sql=_pr_sql(10))
def pagerank_sorted_file(spark, sf_dir):
    """The ranks sorted over all partitions, saved, and read from the file."""
    path = scratch_path(spark, "ranks")
    r = pagerank(cut_lineage(ds.item_graph(spark, sf_dir)), rounds=10).select("id", F.round("rank", 6).alias("rank"))
    global_sort(r, [F.col("rank").desc(), F.col("id").asc()]).write.parquet(path)
    return spark.read.parquet(path)
