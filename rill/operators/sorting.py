"""Distributed sort, sort validation and dense row numbering.

* ``global_sort``: range partitioning on the key (sampled bounds) followed
  by a sort inside each partition -- the TeraSort shape, so no partition
  ever holds more than its key range.
* ``validate_sorted``: every partition is checked in place (one pass, no
  shuffle); only one summary row per partition is combined afterwards.
* ``add_row_index``: dense 0..n-1 numbers in a total order without a
  single-partition window: per-partition counts, prefix offsets over the
  (partition-count sized) summary, then a local position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rill.session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id(): partition id << 33 | position


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def synthetic_records(source: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """100-byte sort records derived from the rows of ``source``.

    ``key`` is 10 hex characters of the md5 of the row's id columns,
    ``payload`` the remaining 90 characters (md5 chains), so keys are
    uniformly spread like the benchmark's generator, yet reproducible.
    """
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])
    h1 = F.md5(ident)
    h2 = F.md5(h1)
    h3 = F.md5(h2)
    body = F.concat(h1, h2, h3)            # 96 hex characters
    return source.select(F.substring(body, 1, 10).alias("key"),
                         F.substring(body, 11, 90).alias("payload"))


def global_sort(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """Total order across partitions (range partitioned + local sort)."""
    keys = _cols(keys)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def _row_hash(cols: Sequence[str]) -> Column:
    """First 8 hex digits of the row's md5, as a number (order-free sums)."""
    h = F.md5(F.concat_ws("|", *[F.col(c) for c in cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def _ordered_batches(key: str):
    """Per partition of rows in file order: whether they ascend, first and last key."""
    def look(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        ordered, first, last, rows = True, None, None, 0
        for b in batches:
            if not len(b):
                continue
            k = b.column(key)
            # column against column, without Python objects
            ordered = ordered and not pc.any(pc.less(k[1:], k[:-1])).as_py() and (last is None or last <= k[0].as_py())
            first = k[0].as_py() if first is None else first
            last, rows = k[len(b) - 1].as_py(), rows + len(b)
        if rows:
            kinds = pa.schema([("pid", pa.int32()), ("rows", pa.int64()), ("ordered", pa.bool_()),
                               ("min_key", pa.string()), ("max_key", pa.string())])
            yield pa.RecordBatch.from_pylist([{"pid": TaskContext.get().partitionId(), "rows": rows, "ordered": bool(ordered),
                                               "min_key": first, "max_key": last}], kinds)
    return look


def validate_sorted(df: DataFrame, key: str = "key", checksum_cols: Sequence[str] | None = None) -> DataFrame:
    """Is ``df`` globally sorted on ``key`` in partition order?

    One pass over ``df``: each partition reports its order, first and last key
    and count, and the checksum is observed on the way; then the partitions'
    ranges must not overlap in partition order.  Returns one row ``rows,
    partitions, partitions_ordered, boundaries_ordered, checksum, min_key,
    max_key`` (``checksum`` over ``checksum_cols``, default all columns).
    """
    cols = list(checksum_cols or df.columns)
    seen = Observation()
    spied = df.observe(seen, checksum(df, cols, "checksum"))
    parts = spied.select(key).mapInArrow(
        _ordered_batches(key), "pid int, rows long, ordered boolean, min_key string, max_key string")
    parts = cut_lineage(parts)                      # one row per partition
    w = Window.orderBy("pid")
    bounds = parts.withColumn("prev_max", F.lag("max_key").over(w))
    return bounds.agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("partitions"),
        F.bool_and("ordered").alias("partitions_ordered"),
        F.bool_and(F.coalesce(F.col("prev_max") <= F.col("min_key"), F.lit(True)))
        .alias("boundaries_ordered"),
        F.lit(seen.get["checksum"]).cast("long").alias("checksum"),
        F.min("min_key").alias("min_key"),
        F.max("max_key").alias("max_key"))


def checksum(df: DataFrame, cols: Sequence[str], name: str = "checksum") -> Column:
    """Order-free checksum: sum of the first 8 hex digits of each row's md5."""
    return F.sum(_row_hash(cols)).alias(name)


def add_row_index(df: DataFrame, order, name: str = "row_index",
                  partitions: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Dense row numbers 0..n-1 following ``order`` (which must be a
    total order for a reproducible answer), computed in two passes.

    The range-sorted rows are checkpointed, so both passes read the same
    partitions; the offset table has one row per partition, so it is broadcast:
    its size is not known when the join is planned, and the rows would be shuffled.
    ``keep`` names the columns to return, if not all: only these are stored.
    """
    order = _cols(order)
    mono = "__mono"
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = global_sort(df, order, n_parts).withColumn(mono, F.monotonically_increasing_id())
    ranked = cut_lineage(ranked.select(*keep, mono) if keep is not None else ranked)
    pid = F.shiftright(F.col(mono), _POS_BITS)
    counts = ranked.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    local = F.col(mono).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    off = offsets.select("__pid", "__off")
    return (ranked.join(F.broadcast(off), pid == F.col("__pid"))
            .withColumn(name, F.col("__off") + local)
            .drop(mono, "__pid", "__off"))
