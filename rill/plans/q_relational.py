"""Text and relational queries: word counts, yearly averages, unions,
category counts and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from rill.functions.text import exact_sum, integer_text, space_tokens, tokens
from rill.operators.relational import (argmax, average_per_distinct, complete_row_counts,
                                       count_by, share_of_total, top_n, union_counts)
from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.sources.tables import table

# Oracle regex: the same ASCII whitespace class as rill.functions.text.WHITESPACE
_WS = r"[\t\n\x0B\f\r ]+"


@query("word_count", sql=rf"""
SELECT word, COUNT(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '{_WS}')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    words = docs.select(F.explode(tokens("text")).alias("word"))
    return count_by(words, "word")


@query("word_count_single_space", sql=r"""
SELECT word, COUNT(*) AS cnt
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def word_count_single_space(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    words = docs.select(F.explode(space_tokens("text")).alias("word")).where(F.col("word") != "")
    return count_by(words, "word")


@query("word_count_skip_malformed", sql=rf"""
SELECT lang, CAST(SUM(TRY_CAST(tok AS DECIMAL(38, 0))) FILTER (WHERE ok) AS VARCHAR) AS total,
       COUNT(*) FILTER (WHERE ok AND TRY_CAST(tok AS DECIMAL(38, 0)) IS NOT NULL) AS records,
       COUNT(*) FILTER (WHERE ok AND TRY_CAST(tok AS DECIMAL(38, 0)) IS NULL) AS too_large,
       COUNT(*) FILTER (WHERE NOT ok) AS skipped
FROM (SELECT lang, tok, regexp_full_match(tok, '[+-]?[0-9]+') AS ok
      FROM (SELECT lang, unnest(regexp_split_to_array(text, '{_WS}')) AS tok FROM documents)
      WHERE tok <> '')
GROUP BY lang
""")
def word_count_skip_malformed(spark, sf_dir):
    """Every token is read as a count record keyed by the document's
    language; integers of any length count (beyond 38 digits they have a
    column of their own), other tokens are skipped and counted as skipped."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    recs = docs.select("lang", F.explode(tokens("text")).alias("tok"))
    recs = recs.select("lang", F.col("tok").rlike(r"^[+-]?[0-9]+\z").alias("ok"), integer_text("tok").alias("v"))
    return (recs.groupBy("lang")
            .agg(exact_sum(F.when(F.col("ok"), F.col("v"))).alias("total"),
                 F.count_if(F.col("ok") & F.col("v").isNotNull()).alias("records"),
                 F.count_if(F.col("ok") & F.col("v").isNull()).alias("too_large"),
                 F.count_if(~F.col("ok")).alias("skipped")))


_YEARLY_AVG_SQL = """
SELECT l_partkey AS bigram,
       CAST(SUM(l_quantity) AS DOUBLE) / COUNT(DISTINCT year(l_shipdate)) AS avg_match_count
FROM lineitem GROUP BY l_partkey
"""


def _yearly_average(spark, sf_dir):
    return average_per_distinct(ds.ngrams(spark, sf_dir), "bigram", "year", "match_count",
                                "avg_match_count")


@query("yearly_average_top20",
       sql=_YEARLY_AVG_SQL + " ORDER BY avg_match_count DESC, bigram ASC LIMIT 20")
def yearly_average_top20(spark, sf_dir):
    return top_n(_yearly_average(spark, sf_dir), 20,
                 F.col("avg_match_count").desc(), F.col("bigram").asc())


@query("yearly_average_all", sql=_YEARLY_AVG_SQL)
def yearly_average_all(spark, sf_dir):
    return _yearly_average(spark, sf_dir)


@query("union_all_counts", sql="""
SELECT 'a' AS part, COUNT(*) AS rows FROM lineitem WHERE year(l_shipdate) < 1998
UNION ALL
SELECT 'b' AS part, COUNT(*) AS rows FROM lineitem WHERE year(l_shipdate) >= 1998
UNION ALL
SELECT 'all' AS part, COUNT(*) AS rows FROM lineitem WHERE l_shipdate IS NOT NULL
UNION ALL
SELECT 'table' AS part, COUNT(*) AS rows FROM lineitem
""")
def union_all_counts(spark, sf_dir):
    """Two loads (years before / from 1998) and their union-all."""
    ng = ds.ngrams(spark, sf_dir)
    return union_counts({"a": ng.where(F.col("year") < 1998),
                         "b": ng.where(F.col("year") >= 1998)}, whole=ng)


@query("table_reload_counts", sql="""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE year(l_shipdate) > 2000) AS rows_after_2000,
       COUNT(DISTINCT l_partkey) AS bigrams
FROM lineitem
""")
def table_reload_counts(spark, sf_dir):
    """First load, appended second load, then SQL over
    the temp view (the file-backed table path is covered in pytest)."""
    ng = ds.ngrams(spark, sf_dir)
    first, second = ng.where(F.col("year") < 1998), ng.where(F.col("year") >= 1998)
    first.unionByName(second).createOrReplaceTempView("all_counts")
    return spark.sql("""
        SELECT COUNT(*) AS total_rows,
               COUNT_IF(year > 2000) AS rows_after_2000,
               COUNT(DISTINCT bigram) AS bigrams
        FROM all_counts""")


@query("distinct_users", sql="""
SELECT DISTINCT o_custkey AS user_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def distinct_users(spark, sf_dir):
    return ds.baskets(spark, sf_dir).select("user_id").distinct()


@query("column_subset_complete_rows", sql="""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE NULLIF(o_orderstatus, 'P') IS NOT NULL
                          AND NULLIF(o_orderpriority, '5-LOW') IS NOT NULL) AS complete_rows
FROM orders
""")
def column_subset_complete_rows(spark, sf_dir):
    """Project a column subset (with nulls made by ``nullif``) and
    count all rows and rows without any null."""
    inc = ds.incidents(spark, sf_dir).select(
        "ccn", "report_dat",
        F.expr("nullif(offense, '5-LOW')").alias("offense"),
        F.expr("nullif(shift, 'P')").alias("shift"),
        "district")
    return complete_row_counts(inc)


@query("category_counts", sql="""
SELECT o_orderpriority AS offense, COUNT(*) AS cnt FROM orders GROUP BY o_orderpriority
""")
def category_counts(spark, sf_dir):
    return count_by(ds.incidents(spark, sf_dir), "offense")


@query("busiest_category", sql="""
SELECT o_orderpriority AS offense, COUNT(*) AS cnt FROM orders GROUP BY o_orderpriority
ORDER BY cnt DESC, offense ASC LIMIT 1
""")
def busiest_category(spark, sf_dir):
    return argmax(category_counts(spark, sf_dir), "cnt", F.col("offense").asc())


@query("yearly_share_of_category", sql="""
WITH c AS (
  SELECT year(try_strptime(split_part(date_format, ' ', 1), '%Y/%m/%d')) AS year,
         o_orderpriority AS offense, COUNT(*) AS cnt
  FROM (SELECT strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS date_format, o_orderpriority
        FROM orders)
  GROUP BY ALL
)
SELECT CAST(year AS BIGINT) AS year, offense, cnt,
       cnt / SUM(cnt) OVER (PARTITION BY year) AS share
FROM c QUALIFY offense = '1-URGENT'
""")
def yearly_share_of_category(spark, sf_dir):
    """Share of one category in each year's
    total; the category filter stays after the window (not its key)."""
    inc = ds.incidents(spark, sf_dir)
    day = F.expr("try_to_date(substring_index(report_dat, ' ', 1), 'yyyy/MM/dd')")
    counted = count_by(inc.select(F.year(day).cast("bigint").alias("year"), "offense"),
                       ["year", "offense"])
    shared = share_of_total(counted, "year", "cnt")
    return shared.where(F.col("offense") == "1-URGENT")
