"""Sort benchmark, row numbering and keyed-table queries."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from rill.operators import keyed as kt
from rill.operators.relational import merge_single_rows
from rill.operators.sorting import (add_row_index, checksum, global_sort, synthetic_records,
                                    validate_sorted)
from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.session import cut_lineage
from rill.sources.tables import table
from rill.streaming.trends import scratch_path

_REC_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
# records: body = h1 || md5(h1) || md5(md5(h1)); key and payload are cut from it
_REC_SQL = """recs AS (
  SELECT substr(body, 1, 10) AS key, substr(body, 11, 90) AS payload
  FROM (SELECT h1 || md5(h1) || md5(md5(h1)) AS body
        FROM (SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS h1
              FROM lineitem)))"""
_CHK = "SUM(CAST(('0x' || substr(md5(concat_ws('|', key, payload)), 1, 8)) AS BIGINT))"


@query("global_sort_check", sql=f"""
WITH {_REC_SQL}
SELECT COUNT(*) AS rows, true AS partitions_ordered, true AS boundaries_ordered,
       {_CHK} AS checksum_in, {_CHK} AS checksum_out, MIN(key) AS min_key, MAX(key) AS max_key
FROM recs
""")
def global_sort_check(spark, sf_dir):
    """Generate 100-byte records from every line, sort them
    globally (range partitions + local sort), then validate the output:
    order inside each partition, order across partition boundaries, row
    count and an order-free checksum equal to the input's."""
    recs = synthetic_records(table(spark, sf_dir, "lineitem"), _REC_IDS)
    # the records are derived once, while they are written, and their checksum is
    # observed on the way; the sort samples and reads what was written
    seen = Observation()
    recs = cut_lineage(recs.observe(seen, checksum(recs, ["key", "payload"], "checksum_in")))
    check = validate_sorted(global_sort(recs, "key"), "key", ["key", "payload"])
    return check.select("rows", "partitions_ordered", "boundaries_ordered",
                        F.lit(seen.get["checksum_in"]).cast("long").alias("checksum_in"),
                        F.col("checksum").alias("checksum_out"), "min_key", "max_key")


_ORDER_SQL = ", ".join(ds.LINEITEM_ORDER)


@query("row_index", sql=f"""
SELECT row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS row_index, {_ORDER_SQL} FROM lineitem
""")
def row_index(spark, sf_dir):
    """Dense 0-based row numbers over a sort on every column,
    computed from per-partition counts and offsets (no global window)."""
    li = table(spark, sf_dir, "lineitem").select(*ds.LINEITEM_ORDER)
    return add_row_index(li, list(ds.LINEITEM_ORDER))


_KT = f"""kt AS (
  SELECT CAST(row_number() OVER (ORDER BY {_ORDER_SQL}) - 1 AS VARCHAR) AS row_key,
         CAST(l_partkey AS VARCHAR) AS bigram, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(floor(l_extendedprice / 100) AS INTEGER) AS match_count,
         l_linenumber AS volume_count
  FROM lineitem)"""


@query("key_ranges", sql=f"""
WITH {_KT}
SELECT CASE WHEN row_key < '20' THEN 0 WHEN row_key < '40' THEN 1
            WHEN row_key < '60' THEN 2 ELSE 3 END AS region,
       COUNT(*) AS cnt, MIN(row_key) AS first_key, MAX(row_key) AS last_key
FROM kt GROUP BY 1
""")
def key_ranges(spark, sf_dir):
    """Rows per pre-split region (split points 20/40/60 in byte
    order, so keys starting 7-9 land in the last region)."""
    t = kt.bulk_load_layout(ds.keyed_table(spark, sf_dir), "row_key")
    return (t.groupBy(kt.key_region("row_key").alias("region"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.min("row_key").alias("first_key"),
                 F.max("row_key").alias("last_key")))


def _changes(t):
    """Puts: bump one cell of the 1998 first lines; insert ``x``-prefixed
    copies of the 2001 seventh lines without a volume cell."""
    bump = (t.where((F.col("year") == 1998) & (F.col("volume_count") == 1))
            .select("row_key", (F.col("match_count") + 1).alias("match_count")))
    new = (t.where((F.col("year") == 2001) & (F.col("volume_count") == 7))
           .select(F.concat(F.lit("x"), F.col("row_key")).alias("row_key"), "bigram", "year",
                   (F.col("match_count") * 2).alias("match_count")))
    return bump, new


@query("keyed_upsert", sql=f"""
WITH {_KT}
SELECT row_key, bigram, year,
       CASE WHEN year = 1998 AND volume_count = 1 THEN match_count + 1 ELSE match_count END
         AS match_count, volume_count
FROM kt
UNION ALL
SELECT 'x' || row_key, bigram, year, match_count * 2, CAST(NULL AS INTEGER) FROM kt
WHERE year = 2001 AND volume_count = 7
""")
def keyed_upsert(spark, sf_dir):
    """Two batches of puts: overwrite one cell of existing rows, and
    insert new rows naming only some cells (the others stay empty)."""
    t = ds.keyed_table(spark, sf_dir)
    bump, new = _changes(t)
    return kt.upsert(kt.upsert(t, bump), new)


@query("keyed_region_put", sql=f"""
WITH {_KT},
r AS (SELECT *, CASE WHEN row_key < '20' THEN 0 WHEN row_key < '40' THEN 1
                     WHEN row_key < '60' THEN 2 ELSE 3 END AS region FROM kt)
SELECT region, COUNT(*) FILTER (WHERE NOT gone) AS rows,
       CAST(SUM(CASE WHEN region = 1 THEN match_count + 1 ELSE match_count END) FILTER (WHERE NOT gone) AS BIGINT) AS matches,
       region IN (1, 3) AS rewritten
FROM (SELECT *, region = 3 AND year = 1998 AS gone FROM r) GROUP BY region
""")
def keyed_region_put(spark, sf_dir):
    """Y3/Y6 on a table partitioned by region: a put into every key of the second
    region, a delete in the last one.  Rows and sum per region afterwards, and
    whether its files are others than before: only those two."""
    table_ = kt.RegionTable(spark, scratch_path(spark, "regions"))
    table_.load(ds.keyed_rows(spark, sf_dir))
    before = cut_lineage(table_.files())
    rows = table_.read()
    table_.put(rows.where("region = 1").select("row_key", (F.col("match_count") + 1).alias("match_count")))
    table_.delete(table_.read().where("region = 3 AND year = 1998"))
    new = table_.files().join(before, ["region", "file", "modified"], "left_anti").select("region").distinct()
    now = table_.read().groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.sum("match_count").alias("matches"))
    return now.join(new.withColumn("rewritten", F.lit(True)), "region", "left").withColumn(
        "rewritten", F.coalesce("rewritten", F.lit(False)))


@query("keyed_get", sql=f"""
WITH {_KT} SELECT * FROM kt WHERE row_key = '1000'
""")
def keyed_get(spark, sf_dir):
    """One row by key."""
    return kt.get(ds.keyed_table(spark, sf_dir), "1000")


def _scan_regex(t):
    return t.where((F.col("year") == 1998)
                   & F.col("match_count").cast("string").rlike("^[1-9][0-9]{2,}"))


@query("keyed_scan_regex", sql=f"""
WITH {_KT}
SELECT * FROM kt
WHERE year = 1998 AND regexp_matches(CAST(match_count AS VARCHAR), '^[1-9][0-9]{{2,}}')
""")
def keyed_scan_regex(spark, sf_dir):
    """Year equality and a regex on the count's text
    (``^[1-9][0-9]{2,}``: a count of at least 100)."""
    return _scan_regex(ds.keyed_table(spark, sf_dir))


@query("keyed_scan_typed", sql=f"""
WITH {_KT} SELECT * FROM kt WHERE year = 1998 AND match_count > 100
""")
def keyed_scan_typed(spark, sf_dir):
    """The typed filter -- strictly more than 100."""
    t = ds.keyed_table(spark, sf_dir)
    return t.where((F.col("year") == 1998) & (F.col("match_count") > 100))


@query("keyed_delete", sql=f"""
WITH {_KT},
hit AS (SELECT row_key FROM kt
        WHERE year = 1998 AND regexp_matches(CAST(match_count AS VARCHAR), '^[1-9][0-9]{{2,}}'))
SELECT (SELECT COUNT(*) FROM kt) AS rows_before, (SELECT COUNT(*) FROM hit) AS deleted,
       (SELECT COUNT(*) FROM kt WHERE row_key NOT IN (SELECT row_key FROM hit)) AS rows_after,
       CAST(0 AS BIGINT) AS rescan_rows
""")
def keyed_delete(spark, sf_dir):
    """Delete every row the regex scan finds (one anti join),
    then scan again -- nothing is found."""
    t = ds.keyed_table(spark, sf_dir)
    hit = _scan_regex(t).select("row_key")
    after = kt.delete_keys(t, hit)
    return merge_single_rows([
        t.agg(F.count(F.lit(1)).alias("rows_before")),
        hit.agg(F.count(F.lit(1)).alias("deleted")),
        after.agg(F.count(F.lit(1)).alias("rows_after")),
        _scan_regex(after).agg(F.count(F.lit(1)).alias("rescan_rows")),
    ])

